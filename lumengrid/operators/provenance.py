"""Signatures of assets, and the metadata documents of exports."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import media
from ..model import REFERENCE, Profile


def canonical_json(value) -> str:
    """Sorted keys, no spaces, ASCII."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def signature(value) -> str:
    """The first 16 hex digits of the canonical text's SHA-256. Documents are small and live on the driver."""
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()[:16]


def text_signature(text: Column) -> Column:
    """The same of texts that are canonical already."""
    return F.substring(F.sha2(text, 256), 1, 16)


#: Bytes of a file that are held at a time.
STEP = 1 << 20


def streamed_checksum(path: str) -> tuple[str, int]:
    """SHA-256 and length of a file, read a step at a time."""
    store, at = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    sha, n = hashlib.sha256(), 0
    with store.open_input_stream(at, compression=None, buffer_size=0) as f:
        while part := f.read(STEP):
            sha.update(part)
            n += len(part)
    return sha.hexdigest(), n


def file_checksums(files: DataFrame) -> DataFrame:
    """Files (path) to path, checksum (SHA-256) and length. Tasks stream them, so a file of any size needs little memory; one that can't be read fails the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                sha, n = streamed_checksum(path)
                yield pa.RecordBatch.from_pydict({"path": [path], "checksum": [sha], "length": pa.array([n], pa.int64())})

    return files.select("path").mapInArrow(run, "path string, checksum string, length long")


def lut_asset(name: str, path: str, checksum: str, source: str, target: str) -> dict:
    version = signature({"lut_file": name, "lut_checksum": checksum, "source_color": source, "target_color": target})
    return {"lut_file": name, "lut_path": path, "lut_checksum": checksum, "lut_asset_version": version, "source_color_space": source, "target_color_space": target}


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """df whose rows must all meet the condition; the query fails otherwise."""
    return df.where(F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def compatible(region: DataFrame, rectification: DataFrame) -> DataFrame:
    """The region's metadata, once its rectification version and reference camera match."""
    r = rectification.select(F.col("asset_version").alias("_v"), "master_camera").distinct()
    joined = region.join(F.broadcast(r.limit(2)), F.lit(True))
    ok = (F.col("_v") == F.col("rectification_asset_version")) & (F.col("master_camera") == REFERENCE)
    return require(joined, ok, "region and rectification don't fit together").drop("_v", "master_camera")


def required_region(region: DataFrame) -> DataFrame:
    """A region whose document has all that an export needs."""
    for name in ("common_valid_roi", "safe_rect_roi", "final_release_crop_16_9", "roi_asset_version"):
        region = require(region, F.col(name).isNotNull(), f"the region's document lacks {name}")
    return region


def view_metadata(tasks: DataFrame, profile: Profile, batch: str, versions: dict[str, str]) -> DataFrame:
    """A metadata document per exported view: tasks with export_scene, scene, camera_id, map_file, phase_offset_ms, frame_count, width, height, time_key, segment_index, segment_count, start, end."""
    segment = F.struct("time_key", "segment_index", "segment_count", F.col("start").alias("start_time"), F.col("end").alias("end_time"), F.col("scene").alias("source_scene_id"))
    quality = F.lit(profile.jpeg_quality).cast("int").alias("jpeg_quality") if profile.image_format == "jpeg" else F.lit(profile.bit_depth).alias("png_bit_depth")
    return tasks.select(
        F.lit("lfv_export_view_metadata_v1").alias("schema_version"), media.view_id(F.col("camera_id")).alias("view_id"), "camera_id", F.concat("scene", F.lit(".mp4")).alias("source_clip"), F.lit(batch).alias("batch_name"), F.col("map_file").alias("rectification_map_file"), "phase_offset_ms", "frame_count",
        F.lit(profile.image_format).alias("output_format"), F.lit(profile.bit_depth).alias("bit_depth"), F.array("width", "height").alias("output_resolution"), F.lit(REFERENCE).alias("reference_camera"),
        *[F.lit(versions[k]).alias(k) for k in ("rectification_asset_version", "roi_asset_version", "crop_policy_version")], segment.alias("segment"), F.lit("export_pipeline_v1").alias("export_pipeline_version"), quality, "export_scene",
    )


#: Fields of a release region that a scene's document repeats: fixed values.
REGION_FIELDS = ["roi_policy", "roi_policy_version", "common_valid_roi", "common_valid_mask_bbox", "safe_rect_roi", "final_release_crop_16_9", "crop_policy_version", "rectification_asset_version", "roi_asset_version", "roi_validation_status"]
#: The order of crops and resizing, by profile: fixed values.
CROP_ORDER = {"benchmark": ["common_valid_roi", "final_release_crop_16_9", "resize_1920x1080"], "fidelity": ["common_valid_roi", "final_release_crop_16_9"]}


def sequence_metadata(views: DataFrame, profile: Profile, batch: str, fps: float, region: DataFrame | None = None, lut: dict | None = None, manifest: str | None = None, run: dict | None = None, strict: bool = True) -> DataFrame:
    """A document per exported scene, from its views. A scene whose reference offset isn't 0, or with a view without an offset, fails the query; if not strict, it stays and phase_status tells. region: one row of a release region; lut: the colour table's asset; run: what to tell of the run."""
    phases = F.map_from_entries(F.array_sort(F.collect_list(F.struct("camera_id", "phase_offset_ms"))))
    rows = views.groupBy("export_scene").agg(phases.alias("phase_offset_ms"), F.first("source_clip").alias("source_video"), F.first("output_resolution").alias("final_output_resolution"), F.first("segment").alias("segment"))
    ref = F.try_element_at("phase_offset_ms", F.lit(REFERENCE))
    lost = F.exists(F.map_values("phase_offset_ms"), lambda x: x.isNull())
    status = F.when(ref.isNull(), "missing_reference_phase").when(ref != 0.0, "reference_phase_not_zero").when(lost, "missing_phase_offset").otherwise("ok")
    rows = rows.withColumn("phase_status", status)
    if strict:
        rows = require(rows, F.col("phase_status") == "ok", "the reference camera's phase offset must be 0, and every view needs one").drop("phase_status")
    on = lut is not None and profile.color_standardised
    told = lut or {}
    colour = media.colour_standardisation(F.lit(on), *[F.lit(told.get(k)) for k in ("policy_name", "source_color_space", "target_color_space", "lut_file", "lut_path", "lut_checksum", "lut_asset_version")])
    quality = {"jpeg_quality": F.lit(profile.jpeg_quality)} if profile.image_format == "jpeg" else {"png_bit_depth": F.lit(profile.bit_depth)}
    size = F.array(*map(F.lit, profile.resize)) if profile.resize else F.lit("no_resize")
    rows = rows.withColumns({"schema_version": F.lit("lfv_export_sequence_metadata_v1"), "scene_id": F.col("export_scene"), "batch_name": F.lit(batch), "profile": F.lit(profile.name), "reference_camera": F.lit(REFERENCE), "fps_nominal": F.lit(fps), "output_format": F.lit(profile.image_format), "bit_depth": F.lit(profile.bit_depth), "resize_target": size, "crop_order": F.array(*map(F.lit, CROP_ORDER[profile.name])), "color_standardization": colour, "lut_asset_version": colour["lut_asset_version"], "source_sync_manifest": F.lit(manifest), "export_pipeline_version": F.lit("export_pipeline_v1"), **quality})
    if run is not None:
        rows = rows.withColumn("runtime", F.struct(*[F.lit(v).alias(k) for k, v in run.items()]))
    if region is not None:
        rows = rows.join(F.broadcast(region.select(*[c for c in REGION_FIELDS if c in region.columns]).limit(1)), F.lit(True))
    return rows
