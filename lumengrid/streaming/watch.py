"""Our extension: watch a folder of manifests as a stream, and keep the offset checks up to date.

Robust scores need whole scenes and cameras, so each micro-batch appends its offsets to a table, and the checks read
that table; a query restarted from its checkpoint writes each batch once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import media
from ..model import LIMITS, SCHEMAS, Limits


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """scene, camera_id, offset_ms of every manifest that arrives."""
    doc = spark.readStream.schema("value string").option("wholetext", True).text(folder).select(F.from_json("value", SCHEMAS["manifest"]).alias("doc"))
    videos = doc.select(F.explode("doc").alias("video", "v")).select("video", F.explode("v.offsets").alias("camera_id", "o"))
    return videos.select(media.scene_id(F.col("video")).alias("scene"), "camera_id", F.col("o.offset_ms").try_cast("double").alias("offset_ms"))


def absolute_alerts(offsets: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Offsets beyond the absolute limits: stateless, so they go out at once."""
    level = media.offset_class(F.col("offset_ms"), limits.abs_warn_ms, limits.abs_fail_ms)
    return offsets.withColumn("level", level).where("level is not null")


def keep_table(offsets: DataFrame, table: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append arriving offsets to a Parquet table; the sink's log makes each batch count once."""
    out = offsets.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(availableNow=True) if available_now else out).start()


def event_rates(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per event type in tumbling windows of event time, with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"))
