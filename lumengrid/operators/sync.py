"""Synchronisation: offset quality, review lists, peaks and clip times.

Offsets arrive flat: scene, camera_id, offset_ms (null if it was no number), frame_shift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import media, stats
from ..model import CAMERAS, LIMITS, REFERENCE, Limits, cameras


def expected(offsets: DataFrame) -> DataFrame:
    """Every scene with every camera of the grid. The 25 cameras are broadcast, so no scene is shuffled to make the product."""
    grid = F.broadcast(cameras(offsets.sparkSession).select("camera_id", "view_index"))
    return offsets.select("scene").distinct().join(grid, F.lit(True))


def scored(offsets: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Valid offsets with robust z scores within their scene and camera, and flags in a fixed order."""
    rows = offsets.where(F.col("offset_ms").isNotNull() & ~F.isnan("offset_ms") & F.col("camera_id").isin(CAMERAS))
    rows = stats.with_robust_z(stats.with_robust_z(rows, "offset_ms", "scene", "scene"), "offset_ms", "camera_id", "camera")
    flags = F.array_compact(F.array(
        F.when(F.col("scene_z") >= limits.scene_mad_k, F.lit("scene_outlier")),
        F.when(F.col("camera_z") >= limits.camera_mad_k, F.lit("camera_unstable_outlier")),
        media.offset_class(F.col("offset_ms"), limits.abs_warn_ms, limits.abs_fail_ms),
    ))
    return rows.withColumn("abs_offset_ms", F.abs("offset_ms")).withColumn("flags", flags)


def flagged(offsets: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Offsets with a flag, sorted: absolute failures first, then by size; ties by scene and grid order. The sort is by ranges, so no task holds all rows."""
    rows = scored(offsets, limits).where(F.size("flags") > 0)
    return rows.orderBy(~F.array_contains("flags", "abs_fail"), F.desc("abs_offset_ms"), "scene", media.view_index(F.col("camera_id")))


def missing(offsets: DataFrame) -> DataFrame:
    """(scene, camera_id, reason): cameras without an offset, offsets that are no numbers, and references that aren't 0."""
    own = offsets.select("scene", "camera_id", "offset_ms", F.lit(True).alias("_there"))
    left = expected(offsets).join(own, ["scene", "camera_id"], "left")
    reason = F.when(F.col("_there").isNull(), "missing_camera_offset").when(F.col("offset_ms").isNull() | F.isnan("offset_ms"), "invalid_offset_ms")
    reason = reason.when((F.col("camera_id") == REFERENCE) & (F.abs("offset_ms") > 1e-6), F.lit("reference_offset_not_zero"))
    return left.withColumn("reason", reason).where("reason is not null").select("scene", "camera_id", "reason")


def reference_violations(offsets: DataFrame) -> DataFrame:
    """Scenes whose reference camera has no offset of exactly 0."""
    ref = offsets.where(F.col("camera_id") == REFERENCE).select("scene", "offset_ms")
    return offsets.select("scene").distinct().join(ref, "scene", "left").where("offset_ms is null or offset_ms <> 0.0D").select("scene", "offset_ms")


def camera_stats(offsets: DataFrame) -> DataFrame:
    return stats.spread(offsets.where("offset_ms is not null"), "offset_ms", "camera_id")


def top_offsets(offsets: DataFrame, n: int = 40) -> DataFrame:
    return offsets.withColumn("abs_offset_ms", F.abs("offset_ms")).where("abs_offset_ms is not null").orderBy(F.desc("abs_offset_ms"), "scene", "camera_id").limit(n)


def review_map(offsets: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Per scene, the cameras to review: absolute and camera flags, and offsets that are no numbers."""
    bad = offsets.where("offset_ms is null").select("scene", "camera_id")
    good = stats.with_robust_z(offsets.where("offset_ms is not null"), "offset_ms", "camera_id", "camera")
    good = good.where((F.abs("offset_ms") >= limits.abs_warn_ms) | (F.col("camera_z") >= limits.camera_mad_k)).select("scene", "camera_id")
    return good.unionByName(bad).groupBy("scene").agg(F.array_sort(F.collect_set("camera_id")).alias("cameras"))


def complete_scenes(offsets: DataFrame) -> DataFrame:
    """Scenes in which all 25 cameras have an offset."""
    return offsets.where("offset_ms is not null").groupBy("scene").agg(F.countDistinct("camera_id").alias("n_cameras")).where("n_cameras = 25")


def camera_status(state: DataFrame) -> DataFrame:
    """Status of each camera by precedence: missing, audio_failed, manual, review, aligned, unaligned. Flags are columns of these names."""
    status = F.when(F.col("missing"), "missing").when(F.col("audio_failed"), "audio_failed").when(F.col("manual"), "manual").when(F.col("review"), "review").when(F.col("aligned"), "aligned").otherwise("unaligned")
    return state.withColumn("status", status)


def manifest_keys(names: DataFrame, keys: DataFrame) -> DataFrame:
    """For each name: the equal key, else the smallest key equal but for case, else the name itself."""
    exact = keys.select(F.col("key").alias("exact")).distinct()
    loose = keys.groupBy(F.lower("key").alias("low")).agg(F.min("key").alias("loose"))
    joined = names.join(exact, F.col("name") == F.col("exact"), "left").join(loose, F.lower("name") == F.col("low"), "left")
    return joined.select("name", F.coalesce("exact", "loose", "name").alias("key"))


def offsets_from_peaks(peaks: DataFrame, rate: int = 48_000, fps: float = 59.94) -> DataFrame:
    """(scene, camera_id, peak) to offsets against the reference camera, which gets exactly 0."""
    ref = peaks.where(F.col("camera_id") == REFERENCE).select("scene", F.col("peak").alias("_ref"))
    lag = F.when(F.col("camera_id") == REFERENCE, F.lit(0)).otherwise(F.col("peak") - F.col("_ref"))
    rows = peaks.join(ref, "scene").withColumn("lag", lag)
    return rows.select("scene", "camera_id", media.lag_to_ms(F.col("lag"), rate).alias("offset_ms"), media.lag_to_frames(F.col("lag"), rate, fps).alias("frame_shift"))


def clip_starts(clips: DataFrame, delay: float = 1.5, fps: float = 59.94) -> DataFrame:
    """clips (video, camera_id, clap, offset_ms) with frame, cut and phase_error_ms."""
    clap, off, d, f = F.col("clap"), F.col("offset_ms"), F.lit(delay), F.lit(fps)
    return clips.withColumn("frame", media.clip_frame(clap, off, d, f)).withColumn("cut", media.clip_start(F.col("frame"), f)).withColumn("phase_error_ms", media.phase_error_ms(F.col("cut"), clap, off, d))


def common_durations(clips: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Per video, the longest clip that every present camera can give: the least remainder less a margin; shorter than a second doesn't count."""
    rest = clips.where("duration > 0").withColumn("_rest", F.col("duration") - F.col("start")).where("_rest > 0")
    return rest.groupBy("video").agg((F.min("_rest") - limits.clip_margin_s).alias("common_duration")).where(F.col("common_duration") >= limits.least_clip_s)
