"""The data model: the camera grid, document schemas, export profiles and limits."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS, COLUMNS = "ABCDE", range(1, 6)
CAMERAS = [f"CAM_{r}{c}" for r in ROWS for c in COLUMNS]
REFERENCE = "CAM_C3"
#: Cameras compared with the reference: its direct neighbours, then two far ones (fixed values).
NEIGHBOURS = ["CAM_C2", "CAM_C4", "CAM_B3", "CAM_D3"]
WIDE_BASELINE = ["CAM_A1", "CAM_E5"]

RECT = "struct<x:int,y:int,width:int,height:int>"
MATRIX = "array<array<double>>"

#: Spark DDL of each document.
SCHEMAS = {
    "manifest": "map<string, struct<master_clap_time:double, offsets:map<string, struct<offset_ms:string, frame_shift:int>>>>",
    "segments": "map<string, map<string, string>>",
    "clip_sidecar": "source_video string, camera string, fps double, sync_info struct<master_clap_time:double, offset_ms:double, phase_error_ms:double>, clip_info struct<start_time:double, duration:double>",
    "calibration": f"map<string, struct<K:{MATRIX}, D:{MATRIX}, R_rel:{MATRIX}, T_rel:array<double>>>",
    "rectify_meta": f"struct<schema_version:string, master_camera:string, image_size:array<int>, crop_alpha:double, rectification_asset_version:string, cameras:map<string, struct<map_file:string, new_K:{MATRIX}, applied_scale:double, image_size:array<int>, rectification_asset_version:string>>>",
    "roi": f"struct<schema_version:string, rectification_asset_version:string, image_size:array<int>, roi_policy_version:string, roi_policy:string, validity_margin_px:struct<x:int,y:int>, common_valid_mask_bbox:{RECT}, common_valid_roi:{RECT}, safe_rect_roi:{RECT}, final_release_crop_16_9:{RECT}, crop_policy_version:string, roi_validation_status:string, roi_asset_version:string>",
    "detection": "camera_id string, frame_index int, detected boolean, reason string, corners array<struct<x:float,y:float>>, center array<double>, bbox array<double>, bbox_area double, orientation_score double",
    "frame": "scene string, camera_id string, frame_index int, pos_msec double, h int, w int, data binary",
    "audio": "scene string, camera_id string, samples array<float>",
    "rect_map": "camera_id string, h int, w int, map_x binary, map_y binary",
}


def cameras(spark: SparkSession) -> DataFrame:
    """The 25 cameras in row-major order: camera_id, row, col, view_index. A fixed 25 rows, so it is always broadcast."""
    grid = spark.range(25, numPartitions=1).select(F.col("id").cast("int").alias("view_index"))
    letter = F.expr(f"substr('{ROWS}', view_index div 5 + 1, 1)")
    return grid.select(letter.alias("row"), F.expr("cast(view_index % 5 + 1 as int)").alias("col"), "view_index").withColumn("camera_id", F.concat(F.lit("CAM_"), "row", "col")).select("camera_id", "row", "col", "view_index")


@dataclass(frozen=True)
class Profile:
    """How frames are exported."""

    name: str
    image_format: str
    resize: tuple[int, int] | None
    bit_depth: int
    jpeg_quality: int | None = None
    png_compression: int | None = None
    color_standardised: bool = True


#: Export profiles: fixed values.
PROFILES = {
    "benchmark": Profile("benchmark", "jpeg", (1920, 1080), 8, jpeg_quality=97),
    "fidelity": Profile("fidelity", "png", None, 16, png_compression=1),
}


def profile(name: str, **changes) -> Profile:
    if name not in PROFILES:
        raise ValueError(f"unknown profile {name}; known: {', '.join(sorted(PROFILES))}")
    return replace(PROFILES[name], **{k: v for k, v in changes.items() if v is not None})


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules."""

    abs_warn_ms: float = 300.0
    abs_fail_ms: float = 600.0
    scene_mad_k: float = 6.0
    camera_mad_k: float = 6.0
    black: int = 2
    near_black: int = 8
    full_line: float = 0.80
    band_px: int = 8
    run_px: int = 3
    near_ratio: float = 0.03
    black_ratio: float = 0.01
    epipolar: float = 8.0
    mono_p95: float = 2.0
    stereo_p95: float = 2.0
    detection_rate: float = 0.3
    least_detections: int = 5
    samples: int = 3
    upgraded_samples: int = 9
    clip_margin_s: float = 0.1
    least_clip_s: float = 1.0


LIMITS = Limits()
