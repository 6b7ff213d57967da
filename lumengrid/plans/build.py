"""The stages that make something: clip lists, calibration, maps, release regions, and exported frames.

Video decoding and encoding and corner detection need libraries that are not here; the tables named by paths.clips
(video, camera_id, duration), paths.detections (camera_id, frame_index, board, corners) and paths.frames (the schema
"frame") stand for their results.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import replace
from datetime import datetime, timezone

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media
from ..model import REFERENCE, SCHEMAS, Profile
from ..operators import calibration, export_qa, frames, provenance, roi, segments, solvers, sync
from ..sources import documents, exports, files
from ..sources import media as sources
from .config import Batch, lookup

Tables = dict[str, DataFrame]


def sync_clip(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> Tables:
    """The clips to cut, and their sidecar documents, which are written to paths.synced_root if that is configured. A clip whose duration isn't known has duration 0, and drops out; so does a video without a second in common."""
    offsets = documents.manifest(spark, batch.required_path("sync_manifest"))
    if scene:
        offsets = offsets.where(F.col("scene") == scene)
    have = spark.read.parquet(batch.required_path("clips")).select("video", "camera_id", F.coalesce("duration", F.lit(0.0)).alias("duration"))
    rows = offsets.where("offset_ms is not null").select("video", "camera_id", F.col("master_clap_time").alias("clap"), "offset_ms").join(have, ["video", "camera_id"])
    fps, delay = batch.fps, float(lookup(batch.raw, "sync", "start_delay_seconds", default=1.5))
    clips = sync.clip_starts(rows, delay, fps)
    common = sync.common_durations(clips.withColumn("start", F.col("cut")), batch.limits)
    clips = clips.join(common, "video").withColumn("name", F.concat("camera_id", F.lit("/"), media.scene_id(F.col("video"))))
    # field names of the sidecar document: fixed values
    sidecars = clips.select("name", F.col("video").alias("source_video"), F.col("camera_id").alias("camera"), F.lit(fps).alias("fps"), F.struct(F.col("clap").alias("master_clap_time"), "offset_ms", "phase_error_ms").alias("sync_info"), F.struct(F.col("cut").alias("start_time"), F.col("common_duration").alias("duration")).alias("clip_info"))
    out = {"clips": clips.select("video", "camera_id", "frame", "cut", "phase_error_ms", "common_duration"), "sidecars": sidecars}
    if batch.path("synced_root"):
        encode = lambda r: (r["name"] + ".json", json.dumps({k: v for k, v in r.items() if k != "name"}, indent=4, ensure_ascii=False).encode())
        out["sidecar_files"] = files.written(files.write_files(sidecars, batch.path("synced_root"), encode, ["camera"]), "sidecars")  # all are written now, whatever is shown of them
    return out


def _size(batch: Batch) -> tuple[int, int]:
    w, h = lookup(batch.raw, "camera", "resolution", default=[3840, 2160])
    return int(w), int(h)


def calibrate(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> Tables:
    """Intrinsics, board poses and the poses of all cameras against the reference; the document goes to paths.calibration_json. Cameras that can't be solved are in the status table, not in the document."""
    found = spark.read.parquet(batch.required_path("detections"))
    width, height = _size(batch)
    solved = solvers.solve_cameras(found, width, height).cache()
    boards = solvers.poses(found, solved)
    pairs = solvers.stereo(found, boards, solved).cache()
    document = {}
    relative = {r.camera_id: r for r in pairs.where("status = 'ok'").collect()}  # at most 25 rows
    for r in solved.where("status = 'ok'").orderBy("camera_id").collect():
        own = relative.get(r.camera_id)
        if r.camera_id != REFERENCE and own is None:
            continue
        turn = np.eye(3) if own is None else np.reshape(own.R_rel, (3, 3))
        document[r.camera_id] = {"K": [[r.fx, 0.0, r.cx], [0.0, r.fy, r.cy], [0.0, 0.0, 1.0]], "D": [[0.0] * 5], "R_rel": turn.tolist(), "T_rel": [0.0] * 3 if own is None else list(own.T_rel)}
    files.write_json(spark, batch.required_path("calibration_json"), document)
    return {"cameras": solved, "pairs": pairs}


def calibration_qa(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> Tables:
    """Detections, reprojection errors, rectified residuals for both rotation modes, distortion and risks."""
    found = spark.read.parquet(batch.required_path("detections"))
    told = documents.calibration(spark, batch.required_path("calibration_json"))
    summary = calibration.detection_summary(calibration.described(found), told)  # the calibration's cameras are expected, so an absent one is a risk
    solved = told.select("camera_id", F.col("K")[0][0].alias("fx"), F.col("K")[1][1].alias("fy"), F.col("K")[0][2].alias("cx"), F.col("K")[1][2].alias("cy"), F.lit("ok").alias("status"))
    boards = solvers.poses(found.where(F.size("corners") > 0), solved).cache()
    mono = calibration.mono_summary(boards)
    pairs = solvers.stereo(found, boards, solved).cache()
    residuals = solvers.rectified_residuals(found, told)
    modes = calibration.residual_summary(residuals)
    recommended = calibration.recommend(modes)
    stereo = pairs.select("camera_id", F.col("error").alias("stereo_error"))
    return {"detections": summary, "mono": mono, "worst_frames": calibration.worst_frames(boards), "pairs": pairs, "residuals": modes, "rotation": recommended, "distortion": calibration.distortion(told.select("camera_id", F.col("D").alias("d"))), "risks": calibration.risks(summary, mono, stereo, recommended, batch.limits)}


def rectify(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> Tables:
    """A map file for each camera, made and written by tasks, and rectify_meta.json, in paths.rectification_dir. Distortion is zero, so the optimal matrix is K and every pixel of a view is valid, whatever the crop's alpha."""
    width, height = _size(batch)
    alpha = float(lookup(batch.raw, "rectification", "crop_alpha", default=0.0))
    told = {r.camera_id: r for r in documents.calibration(spark, batch.required_path("calibration_json")).collect()}  # 25 rows
    master = np.array(told[REFERENCE].K)
    views = spark.createDataFrame([(c, *calibration.optimal_matrix(r.K, width, height, alpha)[1]) for c, r in told.items()], "camera_id string, x int, y int, w int, h int")
    common = roi.intersection(views).first()
    region = media.rect(*[F.lit(common[k]) for k in ("x", "y", "width", "height")])
    m = spark.range(1).select(calibration.virtual_matrix(F.lit(float(master[0][0])), F.lit(float(master[1][1])), F.lit(float(master[0][2])), F.lit(float(master[1][2])), region, width, height).alias("m")).first().m
    p = [[m.fx, 0.0, m.cx], [0.0, m.fy, m.cy], [0.0, 0.0, 1.0]]
    names = {c: f"{c}_rect_map.npz" for c in told}
    # field names and versions of the rectification document: fixed values
    cameras = {c: {"map_file": names[c], "new_K": p, "applied_scale": m.scale, "image_size": [width, height]} for c in sorted(told)}
    head = {"schema_version": "rectification_meta_v2", "master_camera": REFERENCE, "image_size": [width, height], "crop_alpha": alpha}
    version = provenance.signature({**head, "calibration": {c: {"K": r.K, "R_rel": r.R_rel} for c, r in sorted(told.items())}})
    folder = batch.required_path("rectification_dir")
    rows = spark.createDataFrame([(c, r.K, r.R_rel) for c, r in told.items()], "camera_id string, K array<array<double>>, R_rel array<array<double>>").repartitionByRange(len(told), "camera_id")

    def encode(r: dict) -> tuple[str, bytes]:
        return names[r["camera_id"]], files.npz(*frames.rectification_map(np.array(r["K"]), np.linalg.inv(np.array(r["R_rel"])), np.array(p), width, height))

    made = spark.createDataFrame(files.write_files(rows, folder, encode, ["camera_id"]).collect(), "camera_id string, name string, bytes long")  # 25 rows; the document comes after the maps
    files.write_json(spark, f"{folder}/rectify_meta.json", {**head, "rectification_asset_version": version, "cameras": {c: {**v, "rectification_asset_version": version} for c, v in cameras.items()}})
    return {"maps": made, "region": spark.createDataFrame([tuple(common)], "x int, y int, width int, height int")}


def _rect(r) -> dict:
    return {k: int(r[k]) for k in ("x", "y", "width", "height")}


def release_region(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> Tables:
    """The largest rectangle valid in every view, its 16:9 crop and the crop's margins; the signed document goes to paths.roi_metadata. Each camera's mask is made where its map lies, as words of bits; words are combined by camera, and bands of rows are searched in parallel."""
    folder = batch.required_path("rectification_dir")
    meta = documents.rectification(spark, f"{folder}/rectify_meta.json")
    told = documents.with_image_size(meta, sources.rect_maps(spark, folder)).first()
    width, height = told.image_size
    margin = int(lookup(batch.raw, "roi", "margin_px", default=4))
    maps = sources.rect_maps(spark, folder)
    masks = files.written(frames.mask_words(maps, width, height, margin), "masks")
    blind = [r.camera_id for r in roi.blind_cameras(masks).orderBy("camera_id").collect()]  # at most 25
    if blind:
        raise ValueError(f"no valid pixel in {', '.join(blind)}")
    both = files.written(roi.common_words(masks), "common-mask")
    box, safe = roi.bounding_box(both).first(), roi.largest_rectangle(both).first()
    if safe is None or safe.x is None:
        raise ValueError("no pixel is valid in every view")
    box, safe = _rect(box), _rect(safe)
    safe_column = media.rect(*[F.lit(safe[k]) for k in safe])
    got = spark.range(1).select(media.crop_16_9(safe_column).alias("crop")).select("crop", media.inside(F.col("crop"), safe_column).alias("inside"), media.is_16_9(F.col("crop")).alias("exact")).first()
    if got.crop is None or not (got.inside and got.exact):
        raise ValueError(f"no 16:9 crop fits into {safe}")
    crop = _rect(got.crop)
    edges = roi.margins(frames.rim_pixels(maps, crop), crop, width, height).cache()
    least = {r.camera_id: float(r.min_margin) for r in edges.where("camera_id is not null and edge is null").collect()}
    total = edges.where("camera_id is null").first()
    # field names, versions and policy names of the region's document: fixed values
    checks = {"status": "pass", "common_valid_mask_bbox": box, "safe_rect_contains_only_valid_pixels": True, "final_crop_inside_safe_rect": True, "final_crop_is_exact_16_9": True}
    document = {
        "schema_version": "release_roi_metadata_v2", "rectification_asset_version": told.asset_version, "image_size": [width, height], "roi_policy_version": "roi_policy_v2", "roi_policy": "largest_rectangle_valid_in_all_views", "roi_generation_method": "mask_intersection_with_margin_and_largest_safe_rectangle",
        "validity_margin_px": {"x": margin, "y": margin}, "common_valid_mask_bbox": box, "common_valid_roi": safe, "safe_rect_roi": safe, "final_release_crop_16_9": crop, "crop_policy_version": "crop_policy_v2", "roi_validation_status": "static_pass",
        "roi_validation_summary": {"static_validation": checks, "global_min_crop_margin_px": float(total.min_margin) if total else 0.0, "camera_crop_margin_summary": least},
    }
    document["roi_asset_version"] = provenance.signature(document)
    files.write_json(spark, batch.required_path("roi_metadata"), document)
    return {"margins": edges}


def _assets(spark: SparkSession, batch: Batch):
    """Maps, and the region's document, once they fit together."""
    folder = batch.required_path("rectification_dir")
    region = provenance.required_region(documents.region(spark, batch.required_path("roi_metadata")))
    fits = provenance.compatible(region, documents.with_image_size(documents.rectification(spark, f"{folder}/rectify_meta.json"), sources.rect_maps(spark, folder))).first()
    return sources.rect_maps(spark, folder), documents.rectification(spark, f"{folder}/rectify_meta.json"), fits


def roi_qa(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> Tables:
    """Borders of the final crop in sampled frames of the validation scenes, and a verdict."""
    from .preflight import requested

    maps, _, region = _assets(spark, batch)
    own = documents.time_segments(spark, batch.required_path("time_segments"), batch.time_key, validate=False)
    own = requested([scene] if scene else list(lookup(batch.raw, "roi", "validation_scenes", default=["*"])), own)
    places = F.explode(F.array(*[F.lit(x) for x in lookup(batch.raw, "roi", "validation_frame_positions", default=["start", "middle", "end"])])).alias("position")
    times = own.select("scene", "segment_index", "start", "end", places).withColumn("t", media.position_time(F.col("start"), F.col("end"), F.col("position")))
    shown = frames.at_times(spark.read.parquet(batch.required_path("frames")), times.select("scene", "segment_index", "position", "t"))
    raw = Profile("fidelity", "png", None, 8, color_standardised=False)
    cut = frames.export(shown, maps, _rect(region.common_valid_roi), _rect(region.final_release_crop_16_9), raw)
    keys = ["scene", "camera_id", "frame_index"]
    samples = export_qa.overall_ratios(frames.rim_ratios(cut, batch.limits.black, batch.limits.near_black), keys)
    black = float(lookup(batch.raw, "roi", "black_border_threshold", default=0.01))
    near = float(lookup(batch.raw, "roi", "near_black_threshold", default=0.03))
    return {"samples": samples, "worst": export_qa.worst_of_batch(samples, 10), "verdict": roi.verdict(samples, black, near)}


def export(spark: SparkSession, batch: Batch, scene: str | None = None, profile: str | None = None) -> Tables:
    """Frames of all segments through the maps to files, then the views' documents, and, once every view is verified, the scenes' documents: a scene with metadata.json is complete. Frames go through the sink of two phases, so a job that fails leaves no scene; what an earlier one left half published is undone first. Complete scenes are left alone; another partial one is an error. Profiles of JPEG need another encoder, so frames are written, and described, as PNG of the profile's depth."""
    own = batch.profile(profile)
    own = replace(own, image_format="png", jpeg_quality=None, png_compression=own.png_compression or 1)  # what is written, and what the documents tell
    lut_path = batch.path("lut")
    if own.color_standardised and not (lut_path and files.exists(spark, lut_path)):
        raise ValueError(f"profile {own.name} needs a colour table; there is none at {lut_path}")
    maps, rectification, region = _assets(spark, batch)
    cut, common = _rect(region.final_release_crop_16_9), _rect(region.common_valid_roi)
    table, lut = None, None
    if own.color_standardised:
        text = spark.read.text(lut_path, wholetext=True).first()[0]
        table = frames.parse_cube(text)
        checksum = provenance.file_checksums(spark.createDataFrame([(lut_path,)], "path string")).first().checksum
        lut = {"policy_name": "user_lut", **provenance.lut_asset(lut_path.rpartition("/")[2], lut_path, checksum, str(lookup(batch.raw, "export", "source_color", default="log")), str(lookup(batch.raw, "export", "target_color", default="rec709")))}
    root, whole = batch.output_root(own.name)
    folder = root if whole else f"{root}/{own.name}"

    offsets = documents.manifest(spark, batch.required_path("sync_manifest"))
    wanted = segments.scene_segments(offsets.select("scene").distinct(), documents.time_segments(spark, batch.required_path("time_segments"), batch.time_key))
    wanted = wanted.where(F.col("scene") == scene) if scene else wanted
    tasks = segments.with_phases(segments.export_tasks(wanted), offsets)
    exports.recover(spark, folder)
    if files.exists(spark, folder):
        listed = files.written(exports.listing(spark, folder), "listing")
        inventory = exports.inventory(listed)
        told = inventory.select("scene").distinct().join(exports.lacking(listed).withColumn("_l", F.lit(True)), "scene", "left").select("scene", F.col("_l").isNull().alias("has_metadata"))
        state = segments.keep_incomplete(tasks.select(F.col("export_scene").alias("scene"), "camera_id"), inventory, told)
        torn = [r.scene for r in state.where("export_state = 'partial'").select("scene").distinct().orderBy("scene").limit(20).collect()]
        if torn:
            raise ValueError(f"scenes with incomplete output, clear them first: {', '.join(torn)}")
        tasks = tasks.join(state.select(F.col("scene").alias("export_scene"), "camera_id"), ["export_scene", "camera_id"], "left_semi")
    source = spark.read.parquet(batch.required_path("frames")).withColumn("t", F.col("pos_msec") / 1000)
    lost = segments.unmatched_tasks(tasks, source.select("scene", "camera_id").distinct()).select("scene", "camera_id")
    if not lost.isEmpty():
        raise ValueError("no frames for " + ", ".join(f"{r.scene}/{r.camera_id}" for r in lost.orderBy("scene", "camera_id").limit(20).collect()))
    hit = segments.frames_in_segments(source, tasks.select("scene", "segment_index", "start", "end", "export_scene").distinct()).join(tasks.select("export_scene", "camera_id"), ["export_scene", "camera_id"], "left_semi")
    hit = hit.select(F.concat_ws("/", "export_scene", media.view_id(F.col("camera_id"))).alias("scene"), "camera_id", F.col("out_frame").cast("int").alias("frame_index"), "pos_msec", "h", "w", "data")
    made = frames.export(hit, maps, common, cut, own, table)
    if own.resize:
        made = provenance.require(made, (F.col("w") == own.resize[0]) & (F.col("h") == own.resize[1]), f"{own.name} frames must be {own.resize}")
    place = F.split("scene", "/")
    numbered = made.select(place[0].alias("scene"), place[1].alias("view_id"), F.col("frame_index").alias("number"), "h", "w", "data")
    job = f"{run_id(own.name, scene or 'all', batch.batch_id)}-{uuid.uuid4().hex[:8]}"
    won = exports.write_frames(numbered, folder, job, own.bit_depth, own.png_compression)
    counted = won.groupBy(F.col("scene").alias("export_scene"), "view_id").agg(F.sum("n").cast("int").alias("frame_count"), F.max("width").alias("width"), F.max("height").alias("height"))
    views = tasks.join(counted, ["export_scene", "view_id"], "left")
    views = provenance.require(views, F.coalesce(F.col("frame_count"), F.lit(0)) > 0, "a view has no frames in its segment").withColumn("time_key", F.lit(batch.time_key))
    views = views.join(F.broadcast(rectification.select("camera_id", "map_file")), "camera_id")
    versions = {"rectification_asset_version": region.rectification_asset_version, "roi_asset_version": region.roi_asset_version, "crop_policy_version": region.crop_policy_version}
    region_row = documents.region(spark, batch.required_path("roi_metadata"))
    run = {"run_id": run_id(own.name, scene or "all", batch.batch_id)}
    tell = lambda r: json.dumps({k: v for k, v in r.items() if k != "export_scene"}, indent=4, ensure_ascii=False).encode()
    try:  # all documents are made, and all checks pass, before anything is published
        documents_ = files.written(provenance.view_metadata(views, own, batch.batch_id, versions), "views")
        fit = provenance.require(export_qa.verified(documents_), F.col("ok"), "the views of a scene differ in size or number of frames, or some are absent")
        scenes = provenance.sequence_metadata(documents_.join(fit.select("export_scene"), "export_scene", "left_semi"), own, batch.batch_id, batch.fps, region_row, lut, batch.path("sync_manifest"), run)
        scenes = files.written(scenes, "scenes")
        published = files.written(exports.publish(folder, job, won), "published")
        files.write_files(documents_, folder, lambda r: (f"{r['export_scene']}/{r['view_id']}/view_metadata.json", tell(r)), ["export_scene", "camera_id"]).count()
        exports.settle(folder, published)
        last = files.written(files.write_files(scenes, folder, lambda r: (f"{r['export_scene']}/metadata.json", json.dumps({**r, "phase_offset_ms": dict(r["phase_offset_ms"])}, indent=4, ensure_ascii=False).encode()), ["export_scene"]), "told")
    except Exception:
        exports.recover(spark, folder)
        raise
    exports.drop(f"{folder}/{exports.PARTS}")
    return {"tasks": tasks, "views": documents_.drop("segment"), "scenes": last}


def run_id(profile: str, scene: str, batch: str, now: datetime | None = None) -> str:
    """Time, profile, scene and batch of a run."""
    return "_".join([(now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S"), profile, scene, batch])


#: Schemas of the tables that stand for what other libraries make.
GIVEN = {"clips": "video string, camera_id string, duration double", "detections": "camera_id string, frame_index int, board array<double>, corners array<double>", "frames": SCHEMAS["frame"]}
