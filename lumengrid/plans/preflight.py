"""Checks before a stage runs: (level, message) rows from set comparisons in Spark, and from the configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import CAMERAS, REFERENCE, cameras
from ..operators import sync
from ..sources import files
from .config import Batch, lookup

#: What each stage reads (fixed values): names of configured paths.
NEEDS = {
    "sync-qa": ["sync_manifest"],
    "sync-clip": ["sync_manifest", "clips"],
    "calibrate": ["detections", "calibration_json"],
    "calibration-qa": ["detections", "calibration_json"],
    "rectify": ["calibration_json", "rectification_dir"],
    "roi": ["rectification_dir", "roi_metadata"],
    "roi-qa": ["rectification_dir", "roi_metadata", "time_segments", "frames"],
    "export": ["sync_manifest", "rectification_dir", "roi_metadata", "time_segments", "frames", "output_root"],
    "export-qa": ["output_root"],
}
#: Paths that a stage writes; all others must be there before it runs.
MADE = {"calibrate": {"calibration_json"}, "rectify": {"rectification_dir"}, "roi": {"roi_metadata"}, "export": {"output_root"}}


def file_errors(spark: SparkSession, batch: Batch, stage: str) -> list[str]:
    """Inputs that are configured but not there."""
    names = [n for n in NEEDS.get(stage, []) if n not in MADE.get(stage, ()) and batch.path(n)]
    return [f"no such input: {n} ({batch.path(n)})" for n in names if not files.exists(spark, batch.path(n))]


def config_errors(batch: Batch, stage: str) -> list[str]:
    """What the configuration alone tells."""
    if stage not in NEEDS:
        return [f"unknown stage {stage}"]
    out = []
    if sorted(batch.cameras) != CAMERAS:
        out.append("the camera layout must be the 5 x 5 grid CAM_A1 to CAM_E5")
    if lookup(batch.raw, "camera", "reference") != REFERENCE:
        out.append(f"the reference camera must be {REFERENCE}")
    return out + [f"missing path: {name}" for name in NEEDS[stage] if not batch.path(name)]


def set_errors(found: DataFrame, label: str) -> DataFrame:
    """Cameras of the grid that are absent, and others that aren't of the grid."""
    grid = cameras(found.sparkSession).select("camera_id")
    have = found.select("camera_id").distinct()
    text = lambda what: F.concat(F.lit(f"{label}: {what} "), "camera_id").alias("message")
    return grid.exceptAll(have).select(F.lit("error").alias("level"), text("missing")).unionByName(have.exceptAll(grid).select(F.lit("error").alias("level"), text("unknown")))


def manifest_errors(offsets: DataFrame, scene: str | None = None) -> DataFrame:
    """Scenes with missing or invalid cameras, or with a reference offset other than 0; a requested scene that is absent."""
    bad = sync.missing(offsets).select("scene").unionByName(sync.reference_violations(offsets).select("scene")).distinct()
    out = bad.select(F.lit("error").alias("level"), F.concat(F.lit("sync manifest: check scene "), "scene").alias("message"))
    if scene is not None:
        one = offsets.sparkSession.createDataFrame([(scene,)], "scene string").join(offsets.select("scene").distinct(), "scene", "left_anti")
        out = out.unionByName(one.select(F.lit("error").alias("level"), F.concat(F.lit("not in the sync manifest: "), "scene").alias("message")))
    return out


def requested(scenes: list[str], segments: DataFrame) -> DataFrame:
    """The segments of the requested scenes; `*` stands for all. Fails if none is left."""
    rows = segments if "*" in scenes else segments.where(F.col("scene").isin(scenes))
    if rows.isEmpty():
        raise ValueError(f"no requested scene has a time segment: {', '.join(scenes)}")
    return rows


def report(spark: SparkSession, batch: Batch, stage: str, scene: str | None = None, offsets: DataFrame | None = None, calibration: DataFrame | None = None) -> DataFrame:
    out = spark.createDataFrame([("error", m) for m in config_errors(batch, stage)], "level string, message string")
    if offsets is not None and "sync_manifest" in NEEDS.get(stage, []):
        out = out.unionByName(manifest_errors(offsets, scene))
    if calibration is not None and "calibration_json" in NEEDS.get(stage, []):
        out = out.unionByName(set_errors(calibration, "calibration"))
    return out
