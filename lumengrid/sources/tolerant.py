"""Documents that may have faults: rows of what can be read, and a row for each leaf that can't.

Texts become VARIANT values. Entities (a camera's offset, a scene's segment, a camera's matrices) are exploded from them,
and their leaves are taken by path and type; a leaf that is absent, of another type, or of a wrong shape becomes null and a
fault row (file, path, reason, found), as does a document that isn't JSON or whose version isn't known. Nothing else of
the document is lost. The strict readers of documents.py fail or leave gaps where these tell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import MATRIX, RECT

FAULT = "file string, path string, reason string, found string"
_MAP = "map<string, variant>"


@dataclass(frozen=True)
class Leaf:
    """name: column; path: in the entity, keys joined by dots; kind: Spark's type; shape: rows and columns of a matrix, or its length."""

    name: str
    path: str
    kind: str
    required: bool = True
    shape: tuple[int, ...] = ()


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc VARIANT: null if it isn't JSON, text) of each document, without a byte order mark."""
    text = F.regexp_replace("value", "^﻿", "")
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json(text).alias("doc"), text.alias("text"))


def _key(at: Column, name: Column) -> Column:
    return F.concat(at, F.lit('["'), name, F.lit('"]'))


def _kind(v: Column) -> Column:
    """What a VARIANT is: object, array, or a leaf's type."""
    return F.lower(F.regexp_extract(F.schema_of_variant(v), r"^\w+", 0))


def _shown(v: Column) -> Column:
    return F.substring(F.to_json(v), 1, 100)


def _fault(path: Column, reason: Column | str, found: Column) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(path.alias("path"), reason.alias("reason"), found.cast("string").alias("found"))


def entries(rows: DataFrame, name: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Objects (file, at, v) to their entries (file, at, v, the key as column `name`), and faults of those that are no objects."""
    own = rows.withColumn("_m", F.when(_kind(F.col("v")) == "object", F.try_variant_get("v", "$", _MAP)))
    found = own.where("_m is not null").select("file", "at", *keep, F.explode("_m").alias(name, "v")).withColumn("at", _key(F.col("at"), F.col(name)))
    bad = own.where("_m is null").select("file", _fault(F.col("at"), "not an object", _shown(F.col("v"))).alias("f")).select("file", "f.*")
    return found, bad


def _shaped(value: Column, shape: tuple[int, ...]) -> Column:
    ok = F.size(value) == shape[0]
    return ok & F.forall(value, lambda r: F.size(r) == shape[1]) if len(shape) > 1 else ok


def leaves(rows: DataFrame, wanted: list[Leaf], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Entities (file, at, v) to keep... and a column for each leaf, and the faults."""
    made, faults = [], []
    for leaf in wanted:
        path = "$." + leaf.path
        raw = F.try_variant_get("v", path, "variant")
        value = F.try_variant_get("v", path, leaf.kind)
        absent = raw.isNull() | F.is_variant_null(raw)
        number = leaf.kind in ("double", "float")
        reasons = F.when(absent, F.lit("missing") if leaf.required else F.lit(None)).when(value.isNull(), F.lit(f"not {leaf.kind}"))
        if number:
            reasons = reasons.when(F.isnan(value) | (F.abs(value) == float("inf")), F.lit("not finite"))
        if leaf.kind.startswith("struct<"):
            fields = [f.split(":")[0] for f in leaf.kind[7:-1].split(",")]
            lost = value[fields[0]].isNull()
            for f in fields[1:]:
                lost = lost | value[f].isNull()
            reasons = reasons.when(lost, F.lit("not complete"))
        if leaf.shape:
            reasons = reasons.when(~F.coalesce(_shaped(value, leaf.shape), F.lit(False)), F.lit("not " + " x ".join(map(str, leaf.shape))))
        made.append(F.when(reasons.isNull(), value).alias(leaf.name))
        where = F.concat(F.col("at"), *[F.lit(f'["{p}"]') for p in leaf.path.split(".")])
        faults.append(F.when(reasons.isNotNull(), _fault(where, reasons, F.when(~absent, _shown(raw)))))
    told = rows.select("file", F.explode(F.array_compact(F.array(*faults))).alias("f")).select("file", "f.*")
    return rows.select("file", *keep, *made), told


def _documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(file, at, v) of the documents that are JSON, and the faults of the others."""
    docs = texts(spark, path)
    bad = docs.where("doc is null").select("file", _fault(F.lit("$"), "not JSON", F.substring("text", 1, 100)).alias("f")).select("file", "f.*")
    return docs.where("doc is not null").select("file", F.lit("$").alias("at"), F.col("doc").alias("v")), bad


def _together(*faults: DataFrame) -> DataFrame:
    out = faults[0]
    for f in faults[1:]:
        out = out.unionByName(f)
    return out


def manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """file, video, camera_id, master_clap_time, offset_ms, frame_shift of each camera of each video; faults."""
    docs, bad = _documents(spark, path)
    videos, no_object = entries(docs, "video", [])
    heads, clap = leaves(videos.withColumn("_v", F.col("v")).withColumn("_at", F.col("at")), [Leaf("master_clap_time", "master_clap_time", "double")], ["video", "_v", "_at"])
    offsets = heads.select("file", F.concat("_at", F.lit('["offsets"]')).alias("at"), F.try_variant_get("_v", "$.offsets", "variant").alias("v"), "video", "master_clap_time")
    cameras, no_offsets = entries(offsets, "camera_id", ["video", "master_clap_time"])
    rows, wrong = leaves(cameras, [Leaf("offset_ms", "offset_ms", "double"), Leaf("frame_shift", "frame_shift", "int", False)], ["video", "camera_id", "master_clap_time"])
    return rows, _together(bad, no_object, clap, no_offsets, wrong)


def time_segments(spark: SparkSession, path: str, key: str) -> tuple[DataFrame, DataFrame]:
    """file, scene, segment_index, segment_count, start, end of one batch's segments; those of which an end isn't later than its start, or no number, are faults and no rows, but count."""
    docs, bad = _documents(spark, path)
    batch = docs.select("file", F.concat("at", F.lit(f'["{key}"]')).alias("at"), F.try_element_at(F.try_variant_get("v", "$", _MAP), F.lit(key)).alias("v")).where("v is not null")
    scenes, no_object = entries(batch, "scene", [])
    text = F.try_variant_get("v", "$", "string")
    odd = scenes.where((_kind(F.col("v")) != "array") & (F.coalesce(F.trim(text), F.lit("")) != "del")).select("file", _fault(F.col("at"), "not a list of segments", _shown(F.col("v"))).alias("f")).select("file", "f.*")
    every = F.try_variant_get("v", "$", "array<variant>")
    listed = scenes.where(_kind(F.col("v")) == "array").select("file", "at", "scene", "v", every.alias("_all"))
    listed = listed.withColumn("_all", F.when(F.exists("_all", lambda p: _kind(p) == "array") | (F.size("_all") == 0), F.col("_all")).otherwise(F.array("v")))  # a pair alone, or pairs
    own = listed.select("file", "at", "scene", F.size("_all").alias("segment_count"), F.posexplode("_all").alias("segment_index", "_p"))
    number = lambda i: F.when(F.size(F.try_variant_get("_p", "$", "array<variant>")) == 2, F.try_variant_get("_p", f"$[{i}]", "double"))
    own = own.select("file", "at", "scene", "segment_index", "segment_count", number(0).alias("start"), number(1).alias("end"))
    ok = F.coalesce((F.col("end") > F.col("start")) & (F.col("start") >= 0), F.lit(False))
    wrong = own.where(~ok).select("file", _fault(F.concat("at", F.lit("["), F.col("segment_index").cast("string"), F.lit("]")), "not a rising pair", F.concat_ws(",", F.col("start").cast("string"), F.col("end").cast("string"))).alias("f")).select("file", "f.*")
    return own.where(ok).drop("at"), _together(bad, no_object, odd, wrong)


def calibration(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """file, camera_id, K, D (flat), R_rel, T_rel; faults, wrong shapes among them."""
    docs, bad = _documents(spark, path)
    cameras, no_object = entries(docs, "camera_id", [])
    rows, wrong = leaves(cameras, [Leaf("K", "K", MATRIX, shape=(3, 3)), Leaf("D", "D", MATRIX, False), Leaf("R_rel", "R_rel", MATRIX, shape=(3, 3)), Leaf("T_rel", "T_rel", "array<double>", shape=(3,))], ["camera_id"])
    return rows.withColumn("D", F.flatten("D")), _together(bad, no_object, wrong)


def rectification(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """file, schema_version, camera_id, map_file, new_K, image_size, asset_version. A document with `cameras` is of version 2; one without is of version 1, a bare map of cameras."""
    docs, bad = _documents(spark, path)
    has = F.try_variant_get("v", "$.cameras", "variant").isNotNull()
    head = [Leaf("image_size", "image_size", "array<int>", False, (2,)), Leaf("asset_version", "rectification_asset_version", "string", False)]
    new, wrong_head = leaves(docs.where(has).withColumn("_v", F.col("v")), [*head, Leaf("schema_version", "schema_version", "string", False)], ["_v"])
    new = new.select("file", F.lit('$["cameras"]').alias("at"), F.try_variant_get("_v", "$.cameras", "variant").alias("v"), F.coalesce("schema_version", F.lit("rectification_meta_v2")).alias("schema_version"), F.col("image_size").alias("_size"), F.col("asset_version").alias("_version"))
    old = docs.where(~has).select("file", "at", "v", F.lit("rectification_meta_v1_legacy").alias("schema_version"), F.lit(None).cast("array<int>").alias("_size"), F.lit(None).cast("string").alias("_version"))
    cameras, no_object = entries(new.unionByName(old), "camera_id", ["schema_version", "_size", "_version"])
    rows, wrong = leaves(cameras, [Leaf("map_file", "map_file", "string"), Leaf("new_K", "new_K", MATRIX, shape=(3, 3)), *head], ["schema_version", "camera_id", "_size", "_version"])
    rows = rows.withColumns({"image_size": F.coalesce("_size", "image_size"), "asset_version": F.coalesce("_version", "asset_version")}).drop("_size", "_version")
    return rows, _together(bad, wrong_head, no_object, wrong)


#: Versions of a region's document (fixed values).
REGIONS = ("release_roi_metadata_v1", "release_roi_metadata_v2")


def region(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """file, schema_version, asset_version, common_valid_roi, safe_rect_roi, final_release_crop_16_9; a document without a version is of the first. In version 1 one rectangle may stand for the other; version 2 needs both, its margin, and its own version."""
    docs, bad = _documents(spark, path)
    version = F.coalesce(F.try_variant_get("v", "$.schema_version", "string"), F.lit(REGIONS[0]))
    docs = docs.withColumn("schema_version", version)
    unknown = docs.where(~F.col("schema_version").isin(*REGIONS)).select("file", _fault(F.lit('$["schema_version"]'), "unknown version", F.col("schema_version")).alias("f")).select("file", "f.*")
    parts = []
    for name in REGIONS:
        second = name == REGIONS[1]
        parts.append(leaves(docs.where(F.col("schema_version") == name), [Leaf("rectification_asset_version", "rectification_asset_version", "string"), Leaf("common_valid_roi", "common_valid_roi", RECT, second), Leaf("safe_rect_roi", "safe_rect_roi", RECT, second), Leaf("final_release_crop_16_9", "final_release_crop_16_9", RECT), Leaf("roi_asset_version", "roi_asset_version", "string", second), Leaf("validity_margin_px", "validity_margin_px", "struct<x:int,y:int>", second)], ["schema_version"]))
    rows = parts[0][0].unionByName(parts[1][0])
    rows = rows.withColumns({"common_valid_roi": F.coalesce("common_valid_roi", "safe_rect_roi"), "safe_rect_roi": F.coalesce("safe_rect_roi", "common_valid_roi")})
    return rows, _together(bad, unknown, parts[0][1], parts[1][1])
