"""Quality checks of exported frames: structure, borders, sampling, classes, summaries and resuming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import media, stats
from ..model import LIMITS, NEIGHBOURS, REFERENCE, WIDE_BASELINE, Limits, cameras

# Inventory of exported views: scene, camera_id, dir_exists, in_progress, has_view_metadata, frame_files, width, height.


def view_state() -> Column:
    """The first thing wrong with a view; a view with a marker may be complete otherwise."""
    return F.when(~F.col("dir_exists"), "missing_view_dir").when(~F.col("has_view_metadata"), "missing_view_metadata").when(F.col("frame_files") <= 0, "empty_view").otherwise("ok")


def structure(inventory: DataFrame) -> DataFrame:
    """Per scene: the cameras with each fault, whether resolutions and frame counts agree, and the number of faults."""
    rows = inventory.withColumn("state", view_state())
    listed = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("camera_id")))), ",")
    ok = F.col("state") == "ok"
    out = rows.groupBy("scene").agg(
        listed(F.col("state") == "missing_view_dir").alias("missing_view_dirs"),
        listed(F.col("in_progress") & F.col("dir_exists")).alias("in_progress_markers"),
        listed(F.col("state") == "missing_view_metadata").alias("missing_view_metadata"),
        listed(F.col("state") == "empty_view").alias("empty_views"),
        (F.countDistinct(F.when(ok, F.struct("width", "height"))) <= 1).alias("resolution_consistent"),
        (F.countDistinct(F.when(ok, F.col("frame_files"))) <= 1).alias("frame_count_consistent"),
    )
    faults = sum(((F.col(c) != "").cast("int") for c in ("missing_view_dirs", "in_progress_markers", "missing_view_metadata", "empty_views")), F.lit(0))
    return out.withColumn("n_errors", faults + (~F.col("resolution_consistent")).cast("int") + (~F.col("frame_count_consistent")).cast("int"))


def completion(inventory: DataFrame, scenes: DataFrame) -> DataFrame:
    """Per scene: complete (the scene's metadata, which is written last, is there, and each of the 25 views has metadata and frames and no marker, and frame counts agree), partial (anything is there), or empty. scenes: scene, has_metadata."""
    whole = F.col("dir_exists") & ~F.col("in_progress") & F.col("has_view_metadata") & (F.col("frame_files") > 0)
    some = F.col("in_progress") | F.col("has_view_metadata") | (F.col("frame_files") > 0)
    rows = full_inventory(inventory).groupBy("scene").agg(F.bool_and(whole).alias("_whole"), F.bool_or(some).alias("_some"), F.countDistinct(F.when(F.col("dir_exists"), F.col("camera_id"))).alias("n_views"), F.countDistinct("frame_files").alias("_counts"))
    told = scenes.groupBy("scene").agg(F.bool_or("has_metadata").alias("_told"))
    rows = rows.join(told, "scene", "full").fillna({"_whole": False, "_some": False, "n_views": 0, "_told": False})
    state = F.when(F.col("_told") & F.col("_whole") & (F.col("_counts") == 1), "complete").when(F.col("_told") | F.col("_some"), "partial").otherwise("empty")
    return rows.select("scene", "n_views", state.alias("state"))


def verified(views: DataFrame) -> DataFrame:
    """Per scene to be committed (export_scene, ok): all 25 views are there, of one size and one number of frames."""
    return views.groupBy("export_scene").agg(((F.countDistinct("camera_id") == 25) & (F.countDistinct("output_resolution") == 1) & (F.countDistinct("frame_count") == 1)).alias("ok"))


def edge_ratios(pixels: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Border pixels (key columns..., edge, b, g, r) to the share of black and near-black ones per key and edge. A pixel is black if all its channels are."""
    dark = lambda t: ((F.col("b") <= t) & (F.col("g") <= t) & (F.col("r") <= t)).cast("int")
    keys = [c for c in pixels.columns if c not in ("b", "g", "r")]
    return pixels.groupBy(*keys).agg((F.sum(dark(limits.black)) / F.count(F.lit(1))).alias("black_ratio"), (F.sum(dark(limits.near_black)) / F.count(F.lit(1))).alias("near_ratio"))


def overall_ratios(edges: DataFrame, keys: list[str]) -> DataFrame:
    """The plain mean over the four edges, so corners count twice."""
    by = lambda e, c: F.max(F.when(F.col("edge") == e, F.col(c)))
    four = ("top", "bottom", "left", "right")
    mean = lambda c: sum((by(e, c) for e in four[1:]), by(four[0], c)) / 4
    return edges.groupBy(*keys).agg(mean("black_ratio").alias("black_ratio"), mean("near_ratio").alias("near_ratio"))


def strip_stats(lines: DataFrame, keys: list[str], limits: Limits = LIMITS) -> DataFrame:
    """Lines of an edge strip (keys..., line, ratio) to the number of full lines, the longest run of them, and the highest ratio. A strip has a few lines, so they fit an array."""
    full = lines.withColumn("full", F.col("ratio") >= limits.full_line)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line", "full"))), lambda s: s["full"])
    return full.groupBy(*keys).agg(F.max("ratio").alias("max_line_ratio"), F.count_if("full").alias("full_lines"), stats.longest_run(ordered).cast("long").alias("longest_run"))


def border_flags(samples: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Samples with black_run and near_run (longest over edges) get blocking and near_warning."""
    return samples.withColumns({"blocking": F.col("black_run") >= limits.run_px, "near_warning": F.col("near_run") >= limits.run_px})


def border_reasons(samples: DataFrame, edges: DataFrame, keys: list[str], limits: Limits = LIMITS) -> DataFrame:
    """(keys..., reason): one per suspicious sample by precedence, and one per edge with a long black run."""
    flags = border_flags(samples, limits)
    own = F.when(F.col("blocking"), "black_border").when(F.col("near_warning"), "near_black_border").when(F.col("near_ratio") > limits.near_ratio, "near_black_ratio")
    first = flags.withColumn("reason", own).where("reason is not null").select(*keys, "reason")
    second = edges.where(F.col("black_run") >= limits.run_px).select(*keys, F.concat(F.lit("black_edge:"), F.col("edge")).alias("reason"))
    return first.unionByName(second)


def capped_reasons(reasons: DataFrame, limit: int = 20) -> DataFrame:
    """Reasons per scene in camera order; the list ends with the camera at which it reaches `limit`, so it may exceed it."""
    n = reasons.groupBy("scene", "camera_id").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("scene").orderBy(media.view_index(F.col("camera_id"))).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = n.withColumn("before", before).where(F.col("before") < limit).select("scene", "camera_id")
    return reasons.join(kept, ["scene", "camera_id"], "left_semi")


def classify(scenes: DataFrame, samples: DataFrame, warnings: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Status per scene (scene, n_errors): structural faults and blocking borders fail; other signals warn; else pass."""
    per = border_flags(samples, limits).groupBy("scene").agg(F.bool_or("blocking").alias("_block"), F.bool_or(F.col("near_warning") | (F.col("near_ratio") > limits.near_ratio)).alias("_near"))
    odd = warnings.select("scene").distinct().withColumn("_odd", F.lit(True))
    rows = scenes.join(per, "scene", "left").join(odd, "scene", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    status = F.when(F.col("n_errors") > 0, "fail").when(yes("_block"), "fail").when(yes("_near") | yes("_odd"), "warning").otherwise("pass")
    return rows.select("scene", status.alias("status"))


def sampling_plan(views: DataFrame, k: int) -> DataFrame:
    """views (scene, camera_id, frame_files) with a row for each sampled frame index."""
    return views.withColumn("frame_index", F.explode(media.even_samples(F.col("frame_files"), F.lit(k))))


def adaptive(samples: DataFrame, plan_first: DataFrame, plan_more: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The samples of the first plan, replaced by those of the larger plan in scenes where the first one is suspicious. `samples` holds every frame's border figures: scene, camera_id, frame_index, black_run, near_run, near_ratio."""
    keys = ["scene", "camera_id", "frame_index"]
    first = samples.join(plan_first.select(*keys), keys, "left_semi")
    odd = border_flags(first, limits).where(F.col("blocking") | F.col("near_warning") | (F.col("near_ratio") > limits.near_ratio)).select("scene").distinct()
    again = samples.join(plan_more.select(*keys), keys, "left_semi").join(odd, "scene", "left_semi")
    return first.join(odd, "scene", "left_anti").withColumn("upgraded", F.lit(False)).unionByName(again.withColumn("upgraded", F.lit(True)))


def adaptive_in_phases(read: Callable[[DataFrame], DataFrame], views: DataFrame, keep: Callable[[DataFrame, str], DataFrame], limits: Limits = LIMITS) -> tuple[DataFrame, DataFrame]:
    """The samples that adaptive() takes, where frames are read on demand, and the frames (scene, camera_id, frame_index) that were asked for and not got.

    read: a plan to the border figures of its frames; keep: writes a table, so that the first phase is over before the
    second begins. The second phase asks only for what its scenes lack: frames of the larger plan that the first phase
    didn't read, of scenes that it found suspicious.
    """
    keys = ["scene", "camera_id", "frame_index"]
    early = sampling_plan(views, limits.samples).select(*views.columns, "frame_index")
    first = keep(read(early), "samples-first")
    odd = keep(border_flags(first, limits).where(F.col("blocking") | F.col("near_warning") | (F.col("near_ratio") > limits.near_ratio)).select("scene").distinct(), "samples-odd")
    full = sampling_plan(views.join(odd, "scene", "left_semi"), limits.upgraded_samples).select(*views.columns, "frame_index")
    late = full.join(first.select(*keys), keys, "left_anti").join(early.select(*keys), keys, "left_anti")
    second = keep(read(late), "samples-second")
    again = first.join(full.select(*keys), keys, "left_semi").unionByName(second)
    taken = first.join(odd, "scene", "left_anti").withColumn("upgraded", F.lit(False)).unionByName(again.withColumn("upgraded", F.lit(True)))
    lost = early.select(*keys).unionByName(late.select(*keys)).join(first.select(*keys).unionByName(second.select(*keys)), keys, "left_anti")
    return taken, lost


def worst_samples(samples: DataFrame, n: int = 10, limits: Limits = LIMITS) -> DataFrame:
    """The n worst samples of each scene: blocking, near warning, black and near ratio, all falling; ties by camera and frame. Window top-k prunes rows before the shuffle."""
    w = Window.partitionBy("scene").orderBy(F.desc("blocking"), F.desc("near_warning"), F.desc("black_ratio"), F.desc("near_ratio"), "camera_id", "frame_index")
    return border_flags(samples, limits).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def worst_of_batch(worst: DataFrame, n: int = 20) -> DataFrame:
    """The n worst of the scenes' worst, by ratios alone."""
    return worst.orderBy(F.desc("black_ratio"), F.desc("near_ratio"), "scene", "camera_id", "frame_index").limit(n)


#: What a scene's status rests on, by the first of these that holds.
SUMMARIES = ("structural faults, not sampled", "black borders", "suspicious borders after more samples", "suspicious borders", "epipolar warnings only", "sound")


def scene_reports(whole: DataFrame, scenes: DataFrame, taken: DataFrame, warnings: DataFrame, status: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """A report per scene: status, summary, scene_errors, sampling_plan, suspicious_reasons, epipolar_warnings, views with their samples, and the worst cameras. A scene has 25 views and a few samples of each, so a report's size is bounded.

    whole: the full inventory; scenes: structure(); taken: samples, with edge_runs (edge to longest black run) if edges
    are to be told; warnings: epipolar_warnings(); status: classify().
    """
    keys = ["scene", "camera_id", "frame_index"]
    flagged = border_flags(taken, limits)
    edges = taken.select(*keys, F.explode("edge_runs").alias("edge", "black_run")) if "edge_runs" in taken.columns else taken.select(*keys, F.lit("").alias("edge"), F.lit(0).cast("long").alias("black_run")).where("false")
    reasons = capped_reasons(border_reasons(taken, edges, keys, limits))
    listed = lambda *cols: F.array_sort(F.collect_list(F.struct(*cols)))
    told = reasons.groupBy("scene").agg(listed(media.view_index(F.col("camera_id")).alias("_v"), "camera_id", "frame_index", "reason").alias("r")).select("scene", F.transform("r", lambda x: F.struct(x["camera_id"].alias("camera_id"), x["frame_index"].alias("frame_index"), x["reason"].alias("reason"))).alias("suspicious_reasons"))
    odd = warnings.groupBy("scene").agg(listed("rank", "camera_id", "frame_index", "mean").alias("epipolar_warnings")) if "rank" in warnings.columns else None
    plan = taken.groupBy("scene").agg(F.array_sort(F.collect_set("frame_index")).alias("sample_frame_indices"), F.bool_or("upgraded").alias("upgraded"))
    plan = plan.select("scene", F.struct(F.lit(limits.samples).alias("initial_sample_count"), F.size("sample_frame_indices").alias("final_sample_count"), "upgraded", "sample_frame_indices").alias("sampling_plan"), "upgraded")
    per_view = flagged.groupBy("scene", "camera_id").agg(listed("frame_index", "black_ratio", "near_ratio", "black_run", "near_run", "blocking").alias("border_samples"))
    views = whole.select("scene", "camera_id", "frame_files", "width", "height").join(per_view, ["scene", "camera_id"], "left")
    views = views.groupBy("scene").agg(F.map_from_entries(listed("camera_id", F.struct(F.col("frame_files").alias("frame_count"), F.array("width", "height").alias("output_resolution"), F.coalesce("border_samples", F.array()).alias("border_samples")).alias("v"))).alias("views"))
    worst = worst_samples(taken, 10, limits).groupBy("scene").agg(listed("rank", "camera_id", "frame_index", "black_ratio", "near_ratio").alias("border_worst_cameras"))
    faults = F.array_compact(F.array(*[F.when(F.col(c) != "", F.concat(F.lit(c + ": "), F.col(c))) for c in ("missing_view_dirs", "in_progress_markers", "missing_view_metadata", "empty_views")], F.when(~F.col("resolution_consistent"), F.lit("resolutions differ")), F.when(~F.col("frame_count_consistent"), F.lit("frame counts differ"))))
    if "other_faults" in scenes.columns:
        faults = F.concat(faults, F.filter(F.split("other_faults", ","), lambda x: x != ""))
    rows = scenes.select("scene", "n_errors", "resolution_consistent", "frame_count_consistent", faults.alias("scene_errors")).join(status, "scene")
    for part in (plan, told, views, worst, flagged.groupBy("scene").agg(F.bool_or("blocking").alias("_block"))):
        rows = rows.join(part, "scene", "left")
    none = "array<struct<rank:int,camera_id:string,frame_index:int,mean:double>>"
    rows = rows.withColumn("epipolar_warnings", F.array().cast(none)) if odd is None else rows.join(odd, "scene", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    some = F.size(F.coalesce("suspicious_reasons", F.array())) > 0
    summary = F.when(F.col("n_errors") > 0, SUMMARIES[0]).when(yes("_block"), SUMMARIES[1]).when(some & yes("upgraded"), SUMMARIES[2]).when(some, SUMMARIES[3]).when(F.col("status") == "warning", SUMMARIES[4]).otherwise(SUMMARIES[5])
    return rows.select("scene", "status", summary.alias("summary"), "scene_errors", "sampling_plan", F.coalesce("suspicious_reasons", F.array()).alias("suspicious_reasons"), F.coalesce("epipolar_warnings", F.array()).alias("epipolar_warnings"), "views", F.coalesce("border_worst_cameras", F.array()).alias("border_worst_cameras"), "resolution_consistent", "frame_count_consistent")


def batch_summary(status: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: scenes and scenes of each status, those to review (warning or fail) in order, and those whose sampling was upgraded. Scenes are names of one batch."""
    up = samples.where("upgraded").select("scene").distinct().withColumn("_up", F.lit(True))
    rows = status.join(up, "scene", "left")
    n = lambda name: F.count_if(F.col("status") == name).alias(f"n_{name}")
    return rows.agg(F.count(F.lit(1)).alias("n_scenes"), n("pass"), n("warning"), n("fail"), F.array_sort(F.collect_list(F.when(F.col("status") != "pass", F.col("scene")))).alias("review"), F.array_sort(F.collect_list(F.when(F.col("_up"), F.col("scene")))).alias("upgraded"))


def status_counts(scenes: DataFrame) -> DataFrame:
    """The number of scenes of each status; those without any appear with 0."""
    names = scenes.sparkSession.createDataFrame([("pass",), ("warning",), ("fail",)], "status string")
    return names.join(scenes.groupBy("status").agg(F.count(F.lit(1)).alias("n")), "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n_scenes"))


def with_reference_frames(frames: DataFrame, value: str) -> DataFrame:
    """Frames of the neighbours and far cameras beside the reference camera's frame at the same place of its sequence."""
    place = Window.partitionBy("scene", "camera_id").orderBy("frame_index")
    rows = frames.where(F.col("camera_id").isin([REFERENCE, *NEIGHBOURS, *WIDE_BASELINE])).withColumn("place", F.row_number().over(place))
    ref = rows.where(F.col("camera_id") == REFERENCE).select("scene", "place", F.col(value).alias("ref_value"))
    return rows.where(F.col("camera_id") != REFERENCE).join(ref, ["scene", "place"]).select("scene", "camera_id", "place", F.col(value).alias("value"), "ref_value")


def residual_stats(points: DataFrame, keys: list[str], least: int = 10) -> DataFrame:
    """Tracked points (keys..., residual) to count and mean, p95, max; null with fewer than `least` points. A group may hold any number of points."""
    n = F.count("residual")
    given = lambda c: F.when(n >= least, c)
    own = points.groupBy(*keys).agg(n.alias("n"), given(F.avg("residual")).alias("mean"), given(F.max("residual")).alias("max"))
    return own.join(stats.quantiles(points, "residual", keys, {"p95": 0.95}), keys, "left").select(*keys, "n", "mean", F.when(F.col("n") >= least, F.col("p95")).alias("p95"), "max")


def epipolar_warnings(metrics: DataFrame, limit: int = 20, limits: Limits = LIMITS) -> DataFrame:
    """The first `limit` warnings of each scene (scene, camera_id, frame_index, mean), neighbours before far cameras."""
    order = {c: i for i, c in enumerate([*NEIGHBOURS, *WIDE_BASELINE])}
    place = F.coalesce(*[F.when(F.col("camera_id") == c, F.lit(i)) for c, i in order.items()])
    w = Window.partitionBy("scene").orderBy(place, "frame_index")
    return metrics.where(place.isNotNull() & (F.col("mean") > limits.epipolar)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def full_inventory(found: DataFrame) -> DataFrame:
    """found with a row for each camera of each scene; absent ones have no directory. Rows of `found` have one, unless its own dir_exists says otherwise."""
    grid = F.broadcast(cameras(found.sparkSession).select("camera_id"))
    every = found.select("scene").distinct().join(grid, F.lit(True)).join(found if "dir_exists" in found.columns else found.withColumn("dir_exists", F.lit(True)), ["scene", "camera_id"], "left")
    return every.fillna({"dir_exists": False, "in_progress": False, "has_view_metadata": False, "frame_files": 0})
