"""All stages from corner detections to checked exports, on small images."""

import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumengrid.model import CAMERAS, REFERENCE, SCHEMAS
from lumengrid.operators import calibration, frames, roi, solvers
from lumengrid.plans import build, config, preflight, stages
from lumengrid.sources import documents, files
from lumengrid.sources import media as sources

W, H = 64, 36
K = np.array([[70.0, 0, 31.5], [0, 71.0, 17.5], [0, 0, 1]])


def board():
    return np.array([[x * 10.0, y * 10.0] for y in range(4) for x in range(5)])


def truth(i):
    """The pose that takes camera i's coordinates to the reference's."""
    return np.zeros(6) if CAMERAS[i] == REFERENCE else np.array([0.002 * (i % 5 - 2), 0.003 * (i // 5 - 2), 0.001, i % 5 - 2.0, i // 5 - 2.0, 0.3])


def detections(spark, cameras=CAMERAS, n=6, noise=0.0):
    rng, rows = np.random.default_rng(4), []
    poses = [np.concatenate([rng.uniform(-0.35, 0.35, 3), rng.uniform(-12, -4, 1), rng.uniform(-9, -3, 1), rng.uniform(70, 95, 1)]) for _ in range(n)]
    for c in cameras:
        t = truth(CAMERAS.index(c))
        back = solvers.rodrigues(t[:3]).T
        for f, p in enumerate(poses):  # p is the board in the reference's coordinates
            own = np.concatenate([solvers.rotation_vector(back @ solvers.rodrigues(p[:3])), back @ (p[3:] - t[3:])])
            image = solvers.project(board(), K, own) + rng.normal(0, noise, (20, 2))
            rows.append((c, f, board().ravel().tolist(), image.ravel().tolist()))
    return spark.createDataFrame(rows, build.GIVEN["detections"])


def test_joint_pose(spark):
    found = detections(spark, [REFERENCE, "CAM_A1", "CAM_E4"], 7, 0.02)
    solved = spark.createDataFrame([(c, 70.0, 71.0, 31.5, 17.5, "ok") for c in (REFERENCE, "CAM_A1", "CAM_E4")], "camera_id string, fx double, fy double, cx double, cy double, status string")
    boards = solvers.poses(found, solved)
    got = {r.camera_id: r for r in solvers.stereo(found, boards, solved).collect()}
    plain = {r.camera_id: r for r in solvers.relative_poses(boards).collect()}
    for c, r in got.items():
        t = truth(CAMERAS.index(c))
        assert r.status == "ok" and r.n_common == 7 and r.error < 0.05
        assert np.abs(np.reshape(r.R_rel, (3, 3)) - solvers.rodrigues(t[:3])).max() < 5e-3 and np.abs(np.array(r.T_rel) - t[3:]).max() < 0.6
        assert np.abs(np.array(r.T_rel) - t[3:]).max() <= np.abs(np.array(plain[c].T_rel) - t[3:]).max() + 0.05
    assert solvers.stereo(found.where("frame_index < 3"), boards, solved).where("status = 'too_few_common_frames' and R_rel is null").count() == 2


def test_matrices_and_masks(spark):
    assert calibration.optimal_matrix(K, W, H, 1.0)[1] == (0, 0, W, H)
    with pytest.raises(ValueError):
        calibration.optimal_matrix(K, W, H, 2.0)
    x, y = frames.rectification_map(K, np.eye(3), K, W, H)
    assert np.abs(x - np.arange(W)).max() < 1e-4 and np.abs(y - np.arange(H)[:, None]).max() < 1e-4
    maps = spark.createDataFrame([(c, H, W, (x + i).astype("<f4").tobytes(), y.astype("<f4").tobytes()) for i, c in enumerate(CAMERAS[:5])], SCHEMAS["rect_map"]).repartition(3)
    masks = frames.mask_words(maps, W, H, 2)
    both = roi.common_words(masks)
    assert tuple(roi.bounding_box(both).first()) == tuple(roi.largest_rectangle(both).first()) == (2, 2, W - 4 - 4, H - 4)
    assert roi.blind_cameras(masks).count() == 0 and roi.blind_cameras(frames.mask_words(maps, 4, 4, 2)).count() == 5
    crop = {"x": 4, "y": 4, "width": 16, "height": 9}
    rim = frames.rim_pixels(maps.where("camera_id = 'CAM_A1'"), crop).collect()
    assert len(rim) == 2 * 16 + 2 * 9 - 4 and {(r.x, r.y) for r in rim if r.y == 4} == {(v, 4) for v in range(4, 20)}
    grey = np.arange(25, dtype=np.uint8)
    rows = [("s", c, 0, 0.0, 2, 3, np.full((2, 3, 3), grey[i], np.uint8).tobytes()) for i, c in enumerate(CAMERAS)]
    got = {r.sheet: (r.h, r.w, r.data[0]) for r in frames.sheets(spark.createDataFrame(rows, SCHEMAS["frame"])).collect()}
    assert got["grid"] == (10, 15, 0) and got["row_B"] == (2, 15, 5) and got["col_3"] == (10, 3, 2) and len(got) == 11


def test_frames_by_time_and_number(spark):
    rows = [("s", "CAM_A1", i, i * 10.0, 1, 1, b"abc") for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMAS["frame"])
    times = spark.createDataFrame([("s", 0, "start", 0.011), ("s", 0, "end", 9.0)], "scene string, segment_index int, position string, t double")
    assert sorted(r.frame_index for r in frames.at_times(df, times).collect()) == [2, 4]
    wanted = spark.createDataFrame([("s", "CAM_A1", 3), ("s", "CAM_A1", 9)], "scene string, camera_id string, frame_index int")
    assert {r.frame_index: r.reason for r in frames.by_index(df, wanted).collect()} == {3: None, 9: "read_failed"}


def test_files(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    files.write_json(spark, path, {"x": "é"})
    files.write_json(spark, path, {"x": 2}, backup=True)
    files.write_json(spark, path, {"x": 3}, backup=True)
    assert files.read_json(spark, path) == {"x": 3} and files.read_json(spark, path + ".bak") == {"x": 2}
    documents.write_report(spark.createDataFrame([("s", "CAM_A1", 1.0, 2.0, 1.0, 0.0, 1.0, 0.0, ["a", "b"])], "scene string, camera_id string, offset_ms double, abs_offset_ms double, scene_median double, scene_z double, camera_median double, camera_z double, flags array<string>"), f"{tmp_path}/r")
    texts = [p.read_bytes() for p in (tmp_path / "r").glob("*.csv")]
    assert texts and all(t.startswith(b"\xef\xbb\xbfscene,camera,offset_ms,frame_shift,") for t in texts) and any(b"a;b" in t for t in texts)
    assert build.run_id("benchmark", "0001", "b", datetime(2020, 1, 2, 3, 4, 5)) == "20200102_030405_benchmark_0001_b"
    assert config.named({"a": {"paths": {"x": "1"}}}, "a", {"paths": {"y": "2"}}).raw == {"batch_id": "a", "paths": {"x": "1", "y": "2"}}
    with pytest.raises(ValueError, match="unknown batch"):
        config.named({}, "z")


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("batch")
    doc = {"0001.mp4": {"master_clap_time": 1.0, "offsets": {c: {"offset_ms": 0.0 if c == REFERENCE else 5.0, "frame_shift": 0} for c in CAMERAS}}}
    (at / "m.json").write_text(json.dumps(doc))
    (at / "t.json").write_text(json.dumps({"b": {"0001": [[0.0, 0.02], [0.03, 0.2]]}}))
    (at / "look.cube").write_text("LUT_3D_SIZE 2\n" + "\n".join(f"{r} {g} {b}" for b in (0, 1) for g in (0, 1) for r in (0, 1)))
    detections(spark).write.parquet(f"{at}/detections")
    spark.createDataFrame([("0001.mp4", c, None if c == "CAM_E5" else 9.0 + i / 10) for i, c in enumerate(CAMERAS)], build.GIVEN["clips"]).write.parquet(f"{at}/clips")
    image = np.full((H, W, 3), 120, np.uint8)
    spark.createDataFrame([("0001", c, i, i * 10.0, H, W, image.tobytes()) for c in CAMERAS for i in range(6)], build.GIVEN["frames"]).write.parquet(f"{at}/frames")
    text = f"""
batch_id: b
camera: {{reference: CAM_C3, rows: [A, B, C, D, E], columns: [1, 2, 3, 4, 5], resolution: [{W}, {H}]}}
roi: {{margin_px: 1}}
export: {{benchmark: {{resize_target: [16, 9]}}}}
paths: {{sync_manifest: {at}/m.json, time_segments: {at}/t.json, detections: {at}/detections, calibration_json: {at}/out/c.json, rectification_dir: {at}/maps, roi_metadata: {at}/maps/roi.json, frames: {at}/frames, clips: {at}/clips, synced_root: {at}/synced, lut: {at}/look.cube, output_root: {at}/exports}}
"""
    (at / "b.yaml").write_text(text)
    return at


def run(at, stage, *more):
    return stages.main(["--config", f"{at}/b.yaml", "--stage", stage, "--output", f"{at}/tables/{stage}", *more])


def test_clips(spark, batch):
    assert run(batch, "sync-clip") == 0
    clips = spark.read.parquet(f"{batch}/tables/sync-clip/clips")
    assert clips.count() == 25  # the camera without a duration shares the common clip of the others, which is reckoned without it
    side = files.read_json(spark, f"{batch}/synced/CAM_B2/0001.json")
    assert side["camera"] == "CAM_B2" and side["sync_info"]["offset_ms"] == 5.0 and side["clip_info"]["duration"] > 1


def test_from_detections_to_checked_exports(spark, batch):
    assert run(batch, "rectify") == 2  # there is no calibration yet
    assert run(batch, "calibrate", "--dry-run") == 0 and not (batch / "out").exists()
    assert run(batch, "calibrate") == 0
    told = files.read_json(spark, f"{batch}/out/c.json")
    assert sorted(told) == CAMERAS and abs(told["CAM_B4"]["K"][0][0] - 70) < 1 and len(told["CAM_B4"]["T_rel"]) == 3
    assert run(batch, "calibration-qa") in (0, 1)
    risks = {r.reason for r in spark.read.parquet(f"{batch}/tables/calibration-qa/risks").collect()}
    assert "detected_frames_less_than_5" not in risks and "mono_reprojection_p95_gt_2px" not in risks
    modes = spark.read.parquet(f"{batch}/tables/calibration-qa/residuals").where("camera_id is null").collect()
    assert {r["mode"] for r in modes} == {"direct", "inverse"} and all(r.n == 24 * 6 * 20 for r in modes)

    assert run(batch, "rectify") == 0
    meta = files.read_json(spark, f"{batch}/maps/rectify_meta.json")
    assert len(meta["cameras"]) == 25 and meta["image_size"] == [W, H] and len(meta["rectification_asset_version"]) == 16
    assert sources.rect_maps(spark, f"{batch}/maps").count() == 25
    r = documents.with_image_size(spark.createDataFrame([("x", "CAM_C3", None, None)], "schema_version string, master_camera string, image_size array<int>, asset_version string"), sources.rect_maps(spark, f"{batch}/maps")).first()
    assert r.image_size == [W, H] and len(r.asset_version) == 16

    assert run(batch, "roi") == 0
    region = files.read_json(spark, f"{batch}/maps/roi.json")
    crop, safe = region["final_release_crop_16_9"], region["safe_rect_roi"]
    assert crop["width"] * 9 == crop["height"] * 16 and safe["x"] <= crop["x"] and region["rectification_asset_version"] == meta["rectification_asset_version"]
    assert region["roi_validation_summary"]["global_min_crop_margin_px"] == min(region["roi_validation_summary"]["camera_crop_margin_summary"].values()) >= 1
    signed = {k: v for k, v in region.items() if k != "roi_asset_version"}
    from lumengrid.operators import provenance

    assert provenance.signature(signed) == region["roi_asset_version"]

    assert run(batch, "roi-qa") == 0
    assert spark.read.parquet(f"{batch}/tables/roi-qa/verdict").first().status == "pass"

    assert run(batch, "export") == 0
    root = batch / "exports" / "benchmark"
    assert sorted(p.name for p in root.iterdir()) == ["0001_seg01", "0001_seg02"]
    views = sorted(p for p in (root / "0001_seg01").iterdir() if p.is_dir())
    assert len(views) == 25 and sorted(p.name for p in views[3].iterdir() if not p.name.startswith(".")) == ["000001.png", "000002.png", "000003.png", "view_metadata.json"]
    one = files.read_json(spark, f"{root}/0001_seg02/metadata.json")
    assert one["phase_offset_ms"]["CAM_C3"] == 0.0 and len(one["phase_offset_ms"]) == 25 and one["roi_asset_version"] == region["roi_asset_version"] and one["color_standardization"]["lut_file"] == "look.cube" and one["runtime"]["run_id"].endswith("_benchmark_all_b")
    assert files.read_json(spark, f"{views[0]}/view_metadata.json")["frame_count"] == 3
    read = sources.images(spark, str(views[0])).where("h > 0").first()
    assert (read.w, read.h) == (16, 9) and abs(int(read.data[0]) - 120) <= 1

    assert run(batch, "export-qa") == 0
    assert spark.read.parquet(f"{batch}/tables/export-qa/summary").first().n_pass == 2
    assert run(batch, "export") == 0  # complete scenes are left alone
    assert spark.read.parquet(f"{batch}/tables/export/tasks").count() == 0
    (root / "0001_seg02" / "metadata.json").unlink()
    with pytest.raises(ValueError, match="0001_seg02"):
        run(batch, "export")


def test_inputs_that_are_not_there(spark, batch):
    b = config.load(batch / "b.yaml")
    gone = config.Batch({**b.raw, "paths": {**b.raw["paths"], "frames": f"{batch}/nothing"}})
    assert preflight.file_errors(spark, gone, "export") == [f"no such input: frames ({batch}/nothing)"]
    no_lut = config.Batch({**b.raw, "paths": {**b.raw["paths"], "lut": None}})
    with pytest.raises(ValueError, match="colour table"):
        build.export(spark, no_lut)


def test_quantiles_like_numpy(spark):
    from lumengrid.functions import stats

    rng = np.random.default_rng(0)
    values = {"a": rng.normal(size=5000), "b": np.repeat([1.0, 2.0, 3.0], [1, 500, 2]), "c": np.array([4.0]), None: np.array([1.0, 2.0])}
    rows = [(k, float(v)) for k, own in values.items() for v in own] + [("a", None), ("d", None)]
    got = {r.k: r for r in stats.quantiles(spark.createDataFrame(rows, "k string, v double"), "v", ["k"], {"m": 0.5, "p": 0.95, "q": 1.0}).collect()}
    assert set(got) == set(values)
    for k, own in values.items():
        assert np.allclose([got[k].m, got[k].p, got[k].q], np.quantile(own, [0.5, 0.95, 1.0]), rtol=1e-12)
    one = stats.quantiles(spark.createDataFrame(rows, "k string, v double").withColumn("j", F.lit(1)), "v", ["k", "j"], {"m": 0.5}).count()
    assert one == 4
