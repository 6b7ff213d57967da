"""JSON documents as DataFrames, read with fixed schemas and flattened; and the sinks that write them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import SCHEMAS
from ..operators.segments import parse_segments


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row `doc` per file. The documents are small; the text is read whole and parsed by schema."""
    return spark.read.text(path, wholetext=True).select(F.from_json(F.regexp_replace("value", "^﻿", ""), schema).alias("doc"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """scene, video, camera_id, master_clap_time, offset_text, offset_ms (null if it is no number), frame_shift."""
    videos = _document(spark, path, SCHEMAS["manifest"]).select(F.explode("doc").alias("video", "v"))
    rows = videos.select("video", F.col("v.master_clap_time").alias("master_clap_time"), F.explode_outer("v.offsets").alias("camera_id", "o"))
    return rows.select(F.regexp_replace("video", r"(?<=.)\.[^.]*$", "").alias("scene"), "video", "camera_id", "master_clap_time", F.col("o.offset_ms").alias("offset_text"), F.col("o.offset_ms").try_cast("double").alias("offset_ms"), F.col("o.frame_shift").alias("frame_shift")).where("camera_id is not null")


def time_segments(spark: SparkSession, path: str, key: str, validate: bool = True) -> DataFrame:
    """The segments of one batch; deleted scenes drop out. An unknown key gives no rows."""
    raw = _document(spark, path, SCHEMAS["segments"]).select(F.explode(F.try_element_at("doc", F.lit(key))).alias("scene", "value"))
    return parse_segments(raw, validate)


def calibration(spark: SparkSession, path: str) -> DataFrame:
    """camera_id, K, D (flat), R_rel, T_rel."""
    return _document(spark, path, SCHEMAS["calibration"]).select(F.explode("doc").alias("camera_id", "c")).select("camera_id", "c.K", F.flatten("c.D").alias("D"), "c.R_rel", "c.T_rel")


def rectification(spark: SparkSession, path: str) -> DataFrame:
    """The metadata's cameras: master_camera, image_size, asset_version, camera_id, map_file, new_K. A document without a `cameras` field is of the first version: a bare map of cameras."""
    text = spark.read.text(path, wholetext=True)
    new = F.from_json("value", SCHEMAS["rectify_meta"])
    old = F.from_json("value", "map<string, " + SCHEMAS["rectify_meta"].split("cameras:map<string, ", 1)[1][:-2] + ">")
    doc = text.select(new.alias("n"), F.when(F.get_json_object("value", "$.cameras").isNull(), old).alias("o"))
    cams = doc.select("n", F.col("o").isNotNull().alias("legacy"), F.explode(F.coalesce("n.cameras", "o")).alias("camera_id", "c"))
    return cams.select(
        F.when(F.col("legacy"), "rectification_meta_v1_legacy").otherwise(F.coalesce("n.schema_version", F.lit("rectification_meta_v2"))).alias("schema_version"),
        F.coalesce("n.master_camera", F.lit("CAM_C3")).alias("master_camera"), F.coalesce("n.image_size", "c.image_size").alias("image_size"),
        F.coalesce("n.rectification_asset_version", "c.rectification_asset_version").alias("asset_version"), "camera_id", F.col("c.map_file").alias("map_file"), F.col("c.new_K").alias("new_K"),
    )


def with_image_size(meta: DataFrame, maps: DataFrame) -> DataFrame:
    """Rectification rows whose document doesn't tell the image's size take that of the first camera's map, and a version signed anew if they have none."""
    first = maps.agg(F.min_by(F.array("w", "h"), "camera_id").alias("_size"))
    rows = meta.join(F.broadcast(first), F.lit(True))
    text = F.concat_ws("|", "schema_version", "master_camera", F.concat_ws(",", F.transform(F.coalesce("image_size", "_size"), lambda x: x.cast("string"))))
    return rows.withColumns({"image_size": F.coalesce("image_size", "_size"), "asset_version": F.coalesce("asset_version", F.substring(F.sha2(text, 256), 1, 16))}).drop("_size")


def region(spark: SparkSession, path: str) -> DataFrame:
    """Release regions with the defaults of older versions filled in; an unknown version fails the query."""
    d = _document(spark, path, SCHEMAS["roi"]).select("doc.*")
    version = F.coalesce("schema_version", F.lit("release_roi_metadata_v1"))
    ok = version.isin("release_roi_metadata_v1", "release_roi_metadata_v2")
    zero = F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"))
    return d.withColumns({
        "schema_version": F.when(ok, version).otherwise(F.raise_error(F.concat(F.lit("unsupported region schema: "), version)).cast("string")),
        "roi_policy_version": F.coalesce("roi_policy_version", F.lit("roi_policy_v1")), "roi_policy": F.coalesce("roi_policy", F.lit("common_valid_roi_from_rectification_maps")),
        "validity_margin_px": F.coalesce("validity_margin_px", zero), "safe_rect_roi": F.coalesce("safe_rect_roi", "common_valid_roi"), "common_valid_roi": F.coalesce("common_valid_roi", "safe_rect_roi"),
        "common_valid_mask_bbox": F.coalesce("common_valid_mask_bbox", "common_valid_roi"), "crop_policy_version": F.coalesce("crop_policy_version", F.lit("crop_policy_v2")), "roi_validation_status": F.coalesce("roi_validation_status", F.lit("unknown")),
    })


#: Columns of the offset report, in order: fixed values.
REPORT = ["scene", "camera", "offset_ms", "frame_shift", "abs_offset_ms", "scene_median_ms", "scene_robust_z", "camera_median_ms", "camera_robust_z", "flags"]


def offset_report(scored: DataFrame) -> DataFrame:
    """Scored offsets in the report's columns; flags joined by ;."""
    names = {"camera_id": "camera", "scene_median": "scene_median_ms", "scene_z": "scene_robust_z", "camera_median": "camera_median_ms", "camera_z": "camera_robust_z"}
    out = scored if "frame_shift" in scored.columns else scored.withColumn("frame_shift", F.lit(None).cast("int"))
    return out.withColumnsRenamed(names).withColumn("flags", F.array_join("flags", ";")).select(*REPORT)


def write_report(scored: DataFrame, path: str) -> None:
    """CSV files, each of which begins with a byte order mark."""
    offset_report(scored).withColumnRenamed(REPORT[0], "\ufeff" + REPORT[0]).write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="")


def write_documents(rows: DataFrame, path: str, by: list[str]) -> None:
    """JSON documents, partitioned; an overwrite replaces only the partitions that it writes."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def manifest_document(offsets: DataFrame) -> DataFrame:
    """(video, master_clap_time, camera_id, offset_ms, frame_shift) to one JSON value per video."""
    entry = F.struct("camera_id", F.struct("offset_ms", "frame_shift").alias("o"))
    made = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["camera_id"], e["o"]))
    return offsets.groupBy("video").agg(F.to_json(F.struct(F.first("master_clap_time").alias("master_clap_time"), F.map_from_entries(made).alias("offsets"))).alias("value"))
