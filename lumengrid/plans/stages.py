"""One entry for the nine batch stages: checks first, then the stage. Run as python -m lumengrid.plans.stages."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import export_qa, frames, sync
from ..sources import documents, exports, files
from . import build, preflight
from .config import Batch, load


def sync_qa(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> dict[str, DataFrame]:
    offsets = documents.manifest(spark, batch.required_path("sync_manifest"))
    return {"flagged": sync.flagged(offsets), "missing": sync.missing(offsets), "cameras": sync.camera_stats(offsets), "scores": documents.offset_report(sync.scored(offsets))}


def border_figures(images: DataFrame, limits, keep=lambda df, name: df) -> DataFrame:
    """The border figures of each frame: mean dark shares of its edges, longest runs of dark lines. Pixels are looked at once, where `keep` writes the lines' shares."""
    keys = ["scene", "camera_id", "frame_index"]
    lines = keep(frames.border_lines(images, limits.black, limits.near_black, limits.band_px), "border-lines")
    strip = lambda c, name: export_qa.strip_stats(lines.withColumn("ratio", F.col(c)), [*keys, "edge"], limits).groupBy(*keys).agg(F.max("longest_run").alias(name))
    rim = lines.where(F.when(F.col("edge").isin("top", "left"), F.col("line") == 0).otherwise(F.col("line") == limits.band_px - 1))
    black = export_qa.strip_stats(lines.withColumn("ratio", F.col("black_ratio")), [*keys, "edge"], limits)
    black = black.groupBy(*keys).agg(F.max("longest_run").alias("black_run"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("edge", "longest_run")))).alias("edge_runs"))  # four edges
    return export_qa.overall_ratios(rim, keys).join(black, keys).join(strip("near_ratio", "near_run"), keys)


def export_check(inventory: DataFrame, images: DataFrame, batch: Batch, points: DataFrame | None = None, faults: DataFrame | None = None) -> dict[str, DataFrame]:
    """Structure, sampled borders and status of exported scenes, from their inventory and a table of their frames. Further arguments as in checked()."""
    limits = batch.limits
    whole = export_qa.full_inventory(inventory)
    views = whole.where("frame_files > 0").select("scene", "camera_id", "frame_files")
    taken = export_qa.adaptive(border_figures(images, limits), export_qa.sampling_plan(views, limits.samples), export_qa.sampling_plan(views, limits.upgraded_samples), limits)
    return checked(whole, scene_faults(whole, faults), taken, batch, points)


def scene_faults(whole: DataFrame, faults: DataFrame | None = None) -> DataFrame:
    """Structure of each scene, with further faults (scene, fault)."""
    scenes = export_qa.structure(whole)
    if faults is None:
        return scenes
    more = faults.groupBy("scene").agg(F.array_join(F.array_sort(F.collect_set("fault")), ",").alias("other_faults"), F.countDistinct("fault").cast("int").alias("_n"))
    return scenes.join(more, "scene", "left").fillna({"other_faults": "", "_n": 0}).withColumn("n_errors", F.col("n_errors") + F.col("_n")).drop("_n")


def checked(whole: DataFrame, scenes: DataFrame, taken: DataFrame, batch: Batch, points: DataFrame | None = None) -> dict[str, DataFrame]:
    """Status, reports and summaries of scenes from their inventory, their structure and the samples taken; with tracked points (scene, camera_id, frame_index, residual) also epipolar warnings."""
    limits, keys = batch.limits, ["scene", "camera_id", "frame_index"]
    if points is None:
        odd = scenes.where("false")
    else:
        means = export_qa.residual_stats(points.join(taken.select(*keys), keys, "left_semi"), keys).where("mean is not null")
        odd = export_qa.epipolar_warnings(means.select(*keys, "mean"), limits=limits)
    status = export_qa.classify(scenes, taken, odd, limits)
    reports = export_qa.scene_reports(whole, scenes, taken, odd, status, limits)
    return {"reports": reports, "scenes": reports.select("scene", "status", "summary", "sampling_plan.upgraded", "sampling_plan.final_sample_count"), "summary": export_qa.batch_summary(status, taken), "structure": scenes, "samples": taken, **({} if points is None else {"epipolar": odd}), "status": status, "counts": export_qa.status_counts(status), "worst": export_qa.worst_of_batch(export_qa.worst_samples(taken, limits=limits))}


def export_qa_stage(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> dict[str, DataFrame]:
    """Checks of all scenes of a profile's folder, in two phases: few frames of each view are opened, more only in scenes that these make suspicious; scenes with a structural fault aren't sampled. Frames that were asked for and can't be read are a fault; tracked points come from paths.tracked_points (Parquet), if configured."""
    name = batch.profile(profile).name
    root, own = batch.output_root(name)
    root, limits, keys = root if own else f"{root}/{name}", batch.limits, ["scene", "camera_id", "frame_index"]
    listed = files.written(exports.listing(spark, root, scene), "listing")
    whole, lacking = exports.inventory(listed), exports.lacking(listed)
    sound = scene_faults(whole, lacking).where("n_errors = 0").select("scene")
    views = files.written(whole.where("frame_files > 0").join(sound, "scene", "left_semi").select("scene", "camera_id", "frame_files"), "views")
    names = exports.frame_names(listed)

    def read(plan: DataFrame) -> DataFrame:
        images = exports.opened(spark, root, plan.join(names, keys)).where("reason is null")
        return border_figures(images, limits, files.written)

    taken, lost = export_qa.adaptive_in_phases(read, views, files.written, limits)
    lost = lost.select("scene", F.lit("unreadable_frames").alias("fault")).distinct()
    given = batch.path("tracked_points")
    out = checked(whole, scene_faults(whole, lacking.unionByName(lost)), taken, batch, spark.read.parquet(given) if given else None)
    if batch.path("checks_root"):  # a document for each scene, as this stage's files
        told = out["reports"].select("scene", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("text"))
        out["report_files"] = files.written(files.write_files(told, batch.path("checks_root"), lambda r: (f"{r['scene']}/check_report.json", r["text"].encode()), ["scene"]), "reports")
    return out


RUN = {"sync-qa": sync_qa, "sync-clip": build.sync_clip, "calibrate": build.calibrate, "calibration-qa": build.calibration_qa, "rectify": build.rectify, "roi": build.release_region, "roi-qa": build.roi_qa, "export": build.export, "export-qa": export_qa_stage}


#: Stages that write their files while they run.
WRITING = {"sync-clip", "calibrate", "rectify", "roi", "export"}


def main(args: list[str] | None = None) -> int:
    """Exit code 2 if the checks before a stage find an error, 1 if an exported scene fails, the region's verdict is fail, or the calibration's risks include one."""
    p = argparse.ArgumentParser(description="Checks and plans of a capture batch.")
    p.add_argument("--config", required=True)
    p.add_argument("--stage", required=True, choices=sorted(preflight.NEEDS))
    p.add_argument("--scene")
    p.add_argument("--profile", choices=["benchmark", "fidelity"])
    p.add_argument("--output", help="folder for the result tables; shown if absent")
    p.add_argument("--preflight-only", action="store_true")
    p.add_argument("--dry-run", action="store_true", help="explain the plans instead of running them")
    a = p.parse_args(args)
    batch = load(a.config)
    batch.profile(a.profile)
    spark = SparkSession.builder.getOrCreate()
    errors = preflight.config_errors(batch, a.stage) + preflight.file_errors(spark, batch, a.stage)
    if not errors:
        given = lambda name, read: read(spark, batch.required_path(name)) if name in preflight.NEEDS[a.stage] else None
        offsets = given("sync_manifest", documents.manifest)
        calibration = given("calibration_json", documents.calibration) if a.stage == "rectify" else None
        errors = [r.message for r in preflight.report(spark, batch, a.stage, a.scene, offsets, calibration).where("level = 'error'").orderBy("message").toLocalIterator()]
    for message in errors:
        print(f"[ERROR] {message}")
    print(f"errors={len(errors)}")
    if errors:
        return 2
    if a.preflight_only:
        return 0
    if a.dry_run and a.stage in WRITING:
        print(f"stage {a.stage} writes files; its inputs are fine")
        return 0
    if a.stage == "export-qa" and not batch.path("tracked_points"):
        print("[WARNING] no tracked points are configured: epipolar warnings aren't checked")
    tables = RUN[a.stage](spark, batch, a.scene, a.profile)
    try:
        return finish(spark, a, batch, tables)
    finally:
        files.clear(spark)


def finish(spark: SparkSession, a: argparse.Namespace, batch: Batch, tables: dict[str, DataFrame]) -> int:
    """Write, show or explain a stage's tables; its exit code."""
    for name, df in tables.items():
        if a.dry_run:
            df.explain("formatted")
        elif a.output:
            df.write.mode("overwrite").parquet(f"{a.output}/{name}")
        else:
            print(name)
            df.show(40, truncate=False)
    if a.stage == "export-qa" and not a.dry_run:
        status = spark.read.parquet(f"{a.output}/status") if a.output else tables["status"]
        if status.isEmpty():
            print("[ERROR] no exported scene was found")
        return int(status.isEmpty() or not status.where("status = 'fail'").isEmpty())
    bad = {"roi-qa": ("verdict", "status = 'fail'"), "calibration-qa": ("risks", "level = 'fail'")}.get(a.stage)
    return int(bad is not None and not a.dry_run and not tables[bad[0]].where(bad[1]).isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())
