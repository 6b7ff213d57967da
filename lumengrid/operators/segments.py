"""Time segments, export tasks and frames in segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import media
from ..model import cameras

_PAIR, _LIST = "array<double>", "array<array<double>>"


def parse_segments(raw: DataFrame, validate: bool = True) -> DataFrame:
    """(scene, value) with value "del", [s, e] or [[s, e], ...] to (scene, segment_index, segment_count, start, end). With validate, a pair without two numbers in rising order fails the query."""
    value = F.trim("value")
    deleted = (value == '"del"') | (value == "del") | value.isNull()
    listed = F.when(value.rlike(r"^\[\s*\["), F.from_json(value, _LIST)).otherwise(F.array(F.from_json(value, _PAIR)))
    rows = raw.where(~deleted).withColumn("_all", listed)
    rows = rows.select("scene", F.size("_all").alias("segment_count"), F.posexplode("_all").alias("segment_index", "_p"))
    if validate:
        ok = (F.size("_p") == 2) & (F.col("_p")[1] > F.col("_p")[0])
        rows = rows.withColumn("_p", F.when(ok, F.col("_p")).otherwise(F.raise_error(F.concat(F.lit("bad time segment in scene "), F.col("scene"))).cast(_PAIR)))
    return rows.select("scene", "segment_index", "segment_count", F.try_element_at("_p", F.lit(1)).alias("start"), F.try_element_at("_p", F.lit(2)).alias("end"))


def scene_segments(scenes: DataFrame, segments: DataFrame) -> DataFrame:
    """Scenes with their segments, and the name of each exported scene; scenes without a segment drop out."""
    return scenes.join(segments, "scene").withColumn("export_scene", media.segment_scene(F.col("scene"), F.col("segment_index"), F.col("segment_count")))


def export_tasks(segments: DataFrame) -> DataFrame:
    """A task for each exported scene and camera; the grid's 25 rows are broadcast."""
    grid = F.broadcast(cameras(segments.sparkSession).select("camera_id", "view_index"))
    return segments.join(grid, F.lit(True)).withColumn("view_id", media.view_id(F.col("camera_id")))


def unmatched_tasks(tasks: DataFrame, videos: DataFrame) -> DataFrame:
    """Tasks whose source video isn't there; must be empty before an export."""
    return tasks.join(videos, ["scene", "camera_id"], "left_anti")


def with_phases(tasks: DataFrame, offsets: DataFrame, strict: bool = True) -> DataFrame:
    """Tasks with phase_offset_ms. A task without one fails the query; if not strict, it stays with the status missing_phase_offset."""
    phases = offsets.select("scene", "camera_id", F.col("offset_ms").alias("phase_offset_ms"))
    rows = tasks.join(phases, ["scene", "camera_id"], "left")
    lost = F.col("phase_offset_ms").isNull() | F.isnan("phase_offset_ms")
    if not strict:
        return rows.withColumn("phase_status", F.when(lost, "missing_phase_offset").otherwise("ok"))
    told = F.concat(F.lit("no phase offset for "), F.col("camera_id"), F.lit(" in scene "), F.col("scene"))
    return rows.withColumn("phase_offset_ms", F.when(lost, F.raise_error(told).cast("double")).otherwise(F.col("phase_offset_ms")))


#: Seconds of a time bucket.
BUCKET = 60.0


def frames_in_segments(frames: DataFrame, segments: DataFrame, bucket: float = BUCKET) -> DataFrame:
    """Frames with start <= t <= end of a segment of their scene; output frames count from 1, by time.

    Scene and time bucket are the hash keys: a segment has a row for each bucket that it reaches into, within the times
    that its scene has frames of, and a frame lies in one bucket, so a long scene is dealt out and no pair occurs twice.
    Frames are numbered within their buckets; what earlier buckets hold is added from counts, so no task orders a segment.
    """
    keys, place = ["scene", "segment_index", "camera_id"], F.floor(F.col("t") / bucket).cast("long")
    seen = frames.where("t is not null and not isnan(t)").groupBy("scene").agg(F.min("t").alias("_least"), F.max("t").alias("_most"))
    clipped = segments.join(seen, "scene").where("start <= _most and end >= _least")
    first, last = F.floor(F.greatest("start", "_least") / bucket).cast("long"), F.floor(F.least("end", "_most") / bucket).cast("long")
    s = clipped.where("start <= end").withColumn("_bucket", F.explode(F.sequence(first, last))).drop("_least", "_most").withColumnRenamed("scene", "_scene").withColumnRenamed("_bucket", "_b")
    timed = frames.withColumn("_bucket", place)
    hit = timed.join(s, (F.col("scene") == F.col("_scene")) & (F.col("_bucket") == F.col("_b")) & F.col("t").between(F.col("start"), F.col("end"))).drop("_scene", "_b")
    held = hit.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.select(*keys, "_bucket", before.alias("_before"))
    own = hit.withColumn("_own", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy("t", "frame_index")))
    return own.join(held, [*keys, "_bucket"]).withColumn("out_frame", (F.col("_own") + F.col("_before")).cast("int")).select(*frames.columns, *[c for c in segments.columns if c != "scene"], "out_frame")


def keep_incomplete(tasks: DataFrame, inventory: DataFrame, scenes: DataFrame) -> DataFrame:
    """Tasks of scenes that aren't complete yet, with the state of what is there (partial or empty); a partial scene should be cleared before it is exported again."""
    from .export_qa import completion

    state = completion(inventory, scenes).select("scene", F.col("state").alias("export_state"))
    return tasks.join(state, "scene", "left").withColumn("export_state", F.coalesce("export_state", F.lit("empty"))).where("export_state <> 'complete'")
