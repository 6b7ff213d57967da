"""Rules on hand-made rows."""

import json
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumengrid.functions import media, stats
from lumengrid.model import CAMERAS, PROFILES, SCHEMAS, Limits, profile
from lumengrid.operators import calibration, export_qa, frames, provenance, roi, segments, signals, sync
from lumengrid.plans import config, preflight, stages
from lumengrid.sources import documents, media as files
from lumengrid.streaming import watch

QUIET = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(df):
    return df.collect()[0]


def test_robust_z(spark):
    df = spark.createDataFrame([("s", float(v)) for v in (0, 10, 20, 30, 1000)], "g string, v double")
    rows = stats.with_robust_z(df, "v", "g", "x").orderBy("v").collect()
    assert rows[0].x_median == 20 and rows[0].x_mad == 10
    assert [round(r.x_z, 7) for r in rows] == [1.3489815, 0.6744908, 0, 0.6744908, 66.1000944]


def test_scalars(spark):
    row = one(spark.range(1).select(
        *[media.view_index(F.lit(c)).alias(c) for c in ("CAM_A1", "CAM_B4", "CAM_C3", "CAM_E5", "CAM_F1")],
        media.segment_scene(F.lit("0002"), F.lit(0), F.lit(2)).alias("two"), media.segment_scene(F.lit("0001"), F.lit(0), F.lit(1)).alias("single"), media.scene_id(F.lit("0001.MP4")).alias("stem"),
        *[media.offset_class(F.lit(v), 300.0, 600.0).alias(f"o{i}") for i, v in enumerate((299.9, 300.0, 599.9, 600.0, -700.0))],
        media.to_8_bit(F.lit(128 * 257)).alias("a"), media.to_8_bit(F.lit(65535)).alias("b"), media.to_16_bit(F.lit(255)).alias("c"),
    ))
    assert [row[c] for c in ("CAM_A1", "CAM_B4", "CAM_C3", "CAM_E5", "CAM_F1")] == [0, 8, 12, 24, None]
    assert (row.two, row.single, row.stem) == ("0002_seg01", "0001", "0001")
    assert [row[f"o{i}"] for i in range(5)] == [None, "abs_warn", "abs_warn", "abs_fail", "abs_fail"]
    assert (row.a, row.b, row.c) == (128, 255, 65535)


def test_clip_start(spark):
    df = spark.createDataFrame([("v", "CAM_A1", 1.25, 10.0)], "video string, camera_id string, clap double, offset_ms double")
    r = one(sync.clip_starts(df))
    assert r.frame == 165 and abs(r.cut - 2.752752752752753) < 1e-12 and abs(r.phase_error_ms + 7.24724724724668) < 1e-9
    peaks = spark.createDataFrame([("s", "CAM_C3", 1000), ("s", "CAM_A1", 1480)], "scene string, camera_id string, peak long")
    got = {r.camera_id: (r.offset_ms, r.frame_shift) for r in sync.offsets_from_peaks(peaks).collect()}
    assert got == {"CAM_C3": (0.0, 0), "CAM_A1": (10.0, 1)}


@pytest.mark.parametrize("n,k,want", [(10, 3, [0, 4, 9]), (10, 9, [0, 1, 2, 3, 4, 6, 7, 8, 9]), (10, 1, [0]), (0, 3, []), (5, 0, [])])
def test_even_samples(spark, n, k, want):
    assert one(spark.range(1).select(media.even_samples(F.lit(n), F.lit(k)).alias("x"))).x == want


@QUIET
@given(st.integers(1, 400), st.integers(2, 30))
def test_even_samples_like_linspace(spark, n, k):
    want = sorted({int(v) for v in np.round(np.linspace(0, n - 1, k))})
    assert one(spark.range(1).select(media.even_samples(F.lit(n), F.lit(k)).alias("x"))).x == want


@QUIET
@given(st.integers(0, 50), st.integers(0, 50), st.integers(1, 4000), st.integers(1, 3000))
def test_crop(spark, x, y, w, h):
    r = one(spark.range(1).select(media.rect(F.lit(x), F.lit(y), F.lit(w), F.lit(h)).alias("rect")).transform(roi.crops))
    if min(w // 16, h // 9) == 0:
        assert r.crop is None
    else:
        assert r.crop_inside and r.crop_exact and r.crop.width + 16 > min(w, h * 16 // 9) - 16


def test_crop_example(spark):
    r = one(spark.range(1).select(media.crop_16_9(media.rect(F.lit(10), F.lit(20), F.lit(1000), F.lit(500))).alias("c")))
    assert r.c.asDict() == {"x": 70, "y": 22, "width": 880, "height": 495}


@QUIET
@given(st.lists(st.lists(st.booleans(), min_size=5, max_size=5), min_size=1, max_size=6))
def test_rectangle(rows):
    mask = np.array(rows)
    best = max((h * w for y in range(len(mask)) for x in range(5) for h in range(1, len(mask) - y + 1) for w in range(1, 6 - x) if mask[y : y + h, x : x + w].all()), default=0)
    got = roi.rectangle(mask)
    assert (got[2] * got[3] if got else 0) == best
    assert not got or mask[got[1] : got[1] + got[3], got[0] : got[0] + got[2]].all()


def test_longest_run(spark):
    df = spark.createDataFrame([([True, True, False, True, True, True],), ([],), ([False],)], "m array<boolean>")
    assert [r[0] for r in df.select(stats.longest_run(F.col("m"))).collect()] == [3, 0, 0]


def test_segments(spark):
    raw = spark.createDataFrame([("a", '"del"'), ("b", "[0, 1]"), ("c", "[[2.5, 4.0], [6.0, 7.0]]"), ("d", None)], "scene string, value string")
    got = [(r.scene, r.segment_index, r.segment_count, r.start, r.end) for r in segments.parse_segments(raw).orderBy("scene", "segment_index").collect()]
    assert got == [("b", 0, 1, 0, 1), ("c", 0, 2, 2.5, 4), ("c", 1, 2, 6, 7)]
    bad = spark.createDataFrame([("e", "[2, 1]")], "scene string, value string")
    with pytest.raises(Exception, match="bad time segment"):
        segments.parse_segments(bad).collect()
    assert segments.parse_segments(bad, validate=False).count() == 1


def test_missing_and_flags(spark):
    rows = [("s", c, 0.0 if c == "CAM_C3" else 5.0) for c in CAMERAS[:-2]] + [("s", "CAM_E4", None)]
    got = {(r.camera_id, r.reason) for r in sync.missing(spark.createDataFrame(rows, "scene string, camera_id string, offset_ms double")).collect()}
    assert got == {("CAM_E4", "invalid_offset_ms"), ("CAM_E5", "missing_camera_offset")}
    ranked = [("s", "CAM_A1", 350.0), ("t", "CAM_A1", -700.0), ("t", "CAM_A2", 650.0), ("s", "CAM_B1", -350.0), ("s", "CAM_C3", 0.0)]
    order = [(r.scene, r.camera_id) for r in sync.flagged(spark.createDataFrame(ranked, "scene string, camera_id string, offset_ms double")).collect()]
    assert order == [("t", "CAM_A1"), ("t", "CAM_A2"), ("s", "CAM_A1"), ("s", "CAM_B1")]
    empty = spark.createDataFrame([], "scene string, camera_id string, offset_ms double")
    assert sync.flagged(empty).count() == 0 and sync.missing(empty).count() == 0


def test_durations(spark):
    rows = [("a", 0.0, 1.0), ("a", 10.0, 2.0), ("a", 9.0, 2.5), ("b", 3.0, 2.5)]
    got = sync.common_durations(spark.createDataFrame(rows, "video string, duration double, start double")).collect()
    assert [(r.video, r.common_duration) for r in got] == [("a", 6.4)]


@pytest.mark.parametrize("black,near,want", [(0.02, 0.0, "fail"), (0.0, 0.05, "warning"), (0.0, 0.0, "pass")])
def test_verdict(spark, black, near, want):
    df = spark.createDataFrame([(black, near)], "black_ratio double, near_ratio double")
    assert one(roi.verdict(df)).status == want
    assert one(roi.verdict(df.where("false"))).status == "fail"


@pytest.mark.parametrize("a,b,want", [(0.8, 1.0, "direct"), (1.0, 0.8, "inverse"), (0.9, 1.0, "no_change_recommended"), (None, 1.0, "unknown")])
def test_rotation(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert one(df.select(calibration.rotation_mode(F.col("a"), F.col("b")).alias("m"))).m == want


def test_summary(spark):
    r = one(stats.summary(spark.createDataFrame([("c", float(v)) for v in (1, 2, 3, 4, 100)], "k string, v double"), "v", ["k"]))
    assert (r.n, r["mean"], r["median"], round(r.p95, 9), r["max"]) == (5, 22, 3, 80.8, 100)


def test_classes(spark):
    scenes = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0), ("d", 0), ("e", 0)], "scene string, n_errors int")
    samples = spark.createDataFrame([("b", 3, 0, 0.0), ("c", 0, 3, 0.0), ("d", 0, 0, 0.0), ("e", 0, 0, 0.0)], "scene string, black_run int, near_run int, near_ratio double")
    odd = spark.createDataFrame([("e",)], "scene string")
    assert dict(export_qa.classify(scenes, samples, odd).collect()) == {"a": "fail", "b": "fail", "c": "warning", "d": "pass", "e": "warning"}


def test_signature():
    assert provenance.signature({"b": [1.0, 2], "a": "x"}) == "a93c12efcf7f2f6e"


def test_signals(spark):
    rng = np.random.default_rng(3)
    clap = np.exp(-np.arange(200) / 30) * rng.standard_normal(200)
    rows = []
    for cam, at in (("CAM_C3", 1000), ("CAM_A1", 1480), ("CAM_B2", 640)):
        x = rng.standard_normal(4000) * 0.001
        x[at : at + 200] += clap
        rows.append(("s", cam, x.astype(np.float32).tolist()))
    audio = spark.createDataFrame(rows, SCHEMAS["audio"])
    region = spark.createDataFrame([("s", 950, 1250)], "scene string, start int, end int")
    peaks = {r.camera_id: r.peak for r in signals.align(audio, region).collect()}
    assert peaks["CAM_A1"] - peaks["CAM_C3"] == 480 and peaks["CAM_B2"] - peaks["CAM_C3"] == -360
    fixed = spark.createDataFrame([("s", "CAM_A1", 7)], "scene string, camera_id string, peak long")
    assert {r.camera_id: r.peak for r in signals.align(audio, region, fixed).collect()}["CAM_A1"] == 7
    assert signals.match(np.ones(10), np.ones(3)) is None


def test_kernels():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (40, 50, 3), dtype=np.uint8)
    y, x = np.mgrid[0:40, 0:50].astype(float)
    assert (frames.remap(image, x, y) == image).all()
    rng = np.random.default_rng(9)
    u, v = rng.uniform(-7, image.shape[1] + 6, (70, 9)).astype(np.float32), rng.uniform(-7, image.shape[0] + 6, (70, 9)).astype(np.float32)
    sampled = frames.remap(image, u, v)
    for p in zip(*np.nonzero(u < 1e9)):  # tap by tap
        px, py = int(np.rint(float(u[p]) * 32)), int(np.rint(float(v[p]) * 32))
        wx, wy = frames.lanczos(np.array(px % 32 / 32)), frames.lanczos(np.array(py % 32 / 32))
        total = np.zeros(3)
        for j in range(8):
            for i in range(8):
                a, b = px // 32 + i - 3, py // 32 + j - 3
                if 0 <= a < image.shape[1] and 0 <= b < image.shape[0]:
                    total += wx[i] * wy[j] * image[b, a]
        assert np.abs(sampled[p].astype(int) - np.clip(np.rint(total), 0, 255)).max() <= 1
    assert not frames.remap(image, np.full((2, 2), np.nan, np.float32), np.zeros((2, 2), np.float32)).any()
    assert (frames.remap(image, x + 3, y)[:, :-3] == image[:, 3:]).all() and not frames.remap(image, x + 100, y).any()
    half = frames.resize(image, 25, 20)
    assert np.abs(half.astype(int) - np.rint(image.reshape(20, 2, 25, 2, 3).mean(axis=(1, 3)))).max() <= 1
    assert (frames.resize(image, 50, 40) == image).all()
    grid = np.stack(np.meshgrid(*[np.linspace(0, 1, 5)] * 3, indexing="ij")[::-1], axis=-1)
    text = "LUT_3D_SIZE 5\n" + "\n".join(" ".join(map(str, c)) for c in grid.reshape(-1, 3))
    assert (frames.look_up(image, frames.parse_cube(text)) == image).all()
    assert (frames.to_depth(frames.to_depth(image, 16), 8) == image).all()


def test_export_and_borders(spark, tmp_path):
    image = np.full((36, 64, 3), 100, dtype=np.uint8)
    image[:4] = 0
    y, x = np.mgrid[0:36, 0:64].astype("<f4")
    rows = [("s", c, i, i * 16.7, 36, 64, image.tobytes()) for c in CAMERAS[:3] for i in range(2)]
    df = spark.createDataFrame(rows, SCHEMAS["frame"])
    maps = spark.createDataFrame([(c, 36, 64, x.tobytes(), y.tobytes()) for c in CAMERAS[:3]], SCHEMAS["rect_map"])
    whole = {"x": 0, "y": 0, "width": 64, "height": 36}
    out = frames.export(df, maps, whole, {"x": 16, "y": 9, "width": 32, "height": 18}, profile("benchmark", resize=(16, 9)))
    got = out.collect()
    assert len(got) == 6 and (got[0].h, got[0].w) == (9, 16) and set(got[0].data) == {100}
    lines = frames.border_lines(df).where("edge = 'top' and frame_index = 0 and camera_id = 'CAM_A1'").orderBy("line").collect()
    assert [r.black_ratio for r in lines] == [1, 1, 1, 1, 0, 0, 0, 0]
    sheet = one(frames.contact_sheet(df.where("frame_index = 1"), 2))
    assert (sheet.h, sheet.w) == (72, 128)
    inventory = spark.createDataFrame([("s", c, False, True, 2, 64, 36) for c in CAMERAS], "scene string, camera_id string, in_progress boolean, has_view_metadata boolean, frame_files int, width int, height int")
    checked = stages.export_check(inventory, df, config.Batch())
    assert checked["status"].collect()[0].status == "fail" and one(checked["structure"]).n_errors == 0
    (tmp_path / "a.png").write_bytes(files.png(image))
    read = one(files.images(spark, str(tmp_path)))
    assert (read.h, read.w) == (36, 64) and bytes(read.data) == image.tobytes()
    assert zlib.crc32(files.png(frames.to_depth(image, 16))) != 0


def test_sources(spark, tmp_path):
    doc = {f"000{s}.mp4": {"master_clap_time": 1.0, "offsets": {c: {"offset_ms": "bad" if (s, c) == (2, "CAM_A1") else 0.0 if c == "CAM_C3" else float(i), "frame_shift": 0} for i, c in enumerate(CAMERAS)}} for s in (1, 2)}
    (tmp_path / "m").mkdir(), (tmp_path / "t").mkdir(), (tmp_path / "c").mkdir(), (tmp_path / "maps").mkdir(), (tmp_path / "audio" / "CAM_A1").mkdir(parents=True)
    (tmp_path / "m" / "m.json").write_text(json.dumps(doc))
    rows = documents.manifest(spark, str(tmp_path / "m"))
    assert rows.count() == 50 and rows.where("offset_ms is null").count() == 1
    (tmp_path / "t" / "t.json").write_text("﻿" + json.dumps({"b": {"0001": [[0.0, 1.0]], "0002": "del", "0003": [1, 2]}}))
    assert documents.time_segments(spark, str(tmp_path / "t"), "b").count() == 2 and documents.time_segments(spark, str(tmp_path / "t"), "z").count() == 0
    cal = {c: {"K": [[1, 0, 0], [0, 1, 0], [0, 0, 1]], "D": [[3.0, 4.0]], "R_rel": [[1, 0, 0]] * 3, "T_rel": [0, 0, 0]} for c in CAMERAS}
    (tmp_path / "c" / "c.json").write_text(json.dumps(cal))
    got = documents.calibration(spark, str(tmp_path / "c"))
    assert got.count() == 25 and one(calibration.distortion(got.select("camera_id", F.col("D").alias("d")))).norm == 5
    assert preflight.set_errors(got.where("camera_id <> 'CAM_A1'"), "calibration").count() == 1
    for name, old in (("new", {"schema_version": "x", "master_camera": "CAM_C3", "image_size": [4, 3], "rectification_asset_version": "v", "cameras": {"CAM_A1": {"map_file": "f"}}}), ("old", {"CAM_A1": {"map_file": "f", "image_size": [4, 3], "rectification_asset_version": "w"}})):
        (tmp_path / name).mkdir()
        (tmp_path / name / "r.json").write_text(json.dumps(old))
        r = one(documents.rectification(spark, str(tmp_path / name)))
        assert r.image_size == [4, 3] and r.asset_version == ("v" if name == "new" else "w") and r.map_file == "f"
    (tmp_path / "roi").mkdir()
    (tmp_path / "roi" / "r.json").write_text(json.dumps({"rectification_asset_version": "v", "image_size": [4, 3], "common_valid_roi": {"x": 0, "y": 0, "width": 4, "height": 3}, "roi_asset_version": "q"}))
    r = one(documents.region(spark, str(tmp_path / "roi")))
    assert r.schema_version == "release_roi_metadata_v1" and r.safe_rect_roi.width == 4
    assert provenance.compatible(documents.region(spark, str(tmp_path / "roi")), documents.rectification(spark, str(tmp_path / "new"))).count() == 1
    np.savez(tmp_path / "maps" / "CAM_B2_rect_map.npz", map_x=np.ones((3, 4), np.float32), map_y=np.zeros((3, 4), np.float32))
    r = one(files.rect_maps(spark, str(tmp_path / "maps")))
    assert (r.camera_id, r.h, r.w) == ("CAM_B2", 3, 4) and np.frombuffer(r.map_x, "<f4").sum() == 12
    np.arange(100, dtype="<f4").tofile(tmp_path / "audio" / "CAM_A1" / "0001.f32")
    assert len(one(files.raw_audio(spark, str(tmp_path / "audio"), 0.001)).samples) == 48
    listed = files.listing(spark, str(tmp_path / "audio"))
    assert [r.name for r in listed.collect()] == ["0001.f32"]
    wanted = spark.createDataFrame([("CAM_A1", "0001.F32")], "camera_id string, name string")
    assert one(files.videos_of(listed, wanted)).path.endswith("0001.f32")
    report = tmp_path / "report"
    documents.write_report(sync.scored(rows), str(report))
    assert spark.read.csv(str(report), header=True).columns == documents.REPORT
    assert documents.manifest_document(rows.withColumn("offset_ms", F.col("offset_text"))).count() == 2


def test_stages(spark, tmp_path):
    doc = {"0001.mp4": {"master_clap_time": 1.0, "offsets": {c: {"offset_ms": 0.0, "frame_shift": 0} for c in CAMERAS}}}
    (tmp_path / "m.json").write_text(json.dumps(doc))
    (tmp_path / "t.json").write_text(json.dumps({"b": {"0001": [[0, 1], [2, 3]]}}))
    (tmp_path / "b.yaml").write_text(f"batch_id: b\ncamera: {{reference: CAM_C3, rows: [A, B, C, D, E], columns: [1, 2, 3, 4, 5]}}\npaths: {{sync_manifest: {tmp_path}/m.json, time_segments: {tmp_path}/t.json}}\n")
    batch = config.load(tmp_path / "b.yaml")
    assert batch.batch_id == batch.time_key == "b" and batch.cameras == CAMERAS and config.lookup(batch.raw, "a", "b", default=3) == 3
    assert stages.main(["--config", str(tmp_path / "b.yaml"), "--stage", "sync-qa", "--output", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out" / "scores")).count() == 25
    assert stages.main(["--config", str(tmp_path / "b.yaml"), "--stage", "export"]) == 2
    offsets = documents.manifest(spark, batch.required_path("sync_manifest"))
    wanted = segments.scene_segments(offsets.select("scene").distinct(), documents.time_segments(spark, batch.required_path("time_segments"), batch.time_key))
    tasks = segments.with_phases(segments.export_tasks(wanted), offsets)
    with pytest.raises(Exception, match="no phase offset"):
        segments.with_phases(segments.export_tasks(wanted), offsets.where("camera_id <> 'CAM_B2'")).collect()
    assert tasks.count() == 50 and {r.export_scene for r in tasks.select("export_scene").distinct().collect()} == {"0001_seg01", "0001_seg02"}
    rows = tasks.withColumns({"map_file": F.lit("m"), "frame_count": F.lit(60), "width": F.lit(1920), "height": F.lit(1080), "time_key": F.lit("b")})
    views = provenance.view_metadata(rows, PROFILES["benchmark"], "b", {"rectification_asset_version": "1", "roi_asset_version": "2", "crop_policy_version": "3"})
    assert provenance.sequence_metadata(views, PROFILES["benchmark"], "b", batch.fps).count() == 2
    with pytest.raises(Exception, match="phase offset"):
        provenance.sequence_metadata(views.withColumn("phase_offset_ms", F.lit(1.0)), PROFILES["benchmark"], "b", 59.94).collect()
    assert preflight.requested(["*"], tasks).count() == 50
    with pytest.raises(Exception, match="no requested scene"):
        preflight.requested(["9"], tasks).collect()
    assert preflight.report(spark, batch, "sync-qa", "0009", documents.manifest(spark, str(tmp_path / "m.json"))).count() == 1
    with pytest.raises(ValueError):
        profile("other")
    assert Limits().samples == 3


def test_export_qa_stage(spark, tmp_path):
    bright, dark = np.full((16, 16, 3), 90, np.uint8), np.zeros((16, 16, 3), np.uint8)
    root = tmp_path / "exports" / "benchmark"
    for scene in ("good", "black", "marked", "lacking", "torn", "untold"):
        for i in range(24 if scene == "lacking" else 25):
            view = root / scene / f"view_{i:02d}"
            view.mkdir(parents=True)
            (view / "view_metadata.json").write_text(json.dumps({"output_resolution": [16, 16]}))
            for k in range(2):
                (view / f"{k:04d}.png").write_bytes(b"no image" if (scene, i, k) == ("torn", 3, 1) else files.png(dark if (scene, i) == ("black", 7) else bright))
        if scene != "untold":
            (root / scene / "metadata.json").write_text("{}")
    (root / "marked" / "view_04" / ".in_progress").write_text("")
    (root / "bare").mkdir()
    text = f"batch_id: b\ncamera: {{reference: CAM_C3, rows: [A, B, C, D, E], columns: [1, 2, 3, 4, 5]}}\npaths: {{output_root: {tmp_path}/exports"
    (tmp_path / "b.yaml").write_text(text + "}\n")
    points = spark.createDataFrame([("good", "CAM_C2", 1, 9.0)] * 12, "scene string, camera_id string, frame_index int, residual double")
    points.write.parquet(f"{tmp_path}/points")
    (tmp_path / "p.yaml").write_text(text + f", tracked_points: {tmp_path}/points}}\n")
    run = lambda config, *more: stages.main(["--config", str(tmp_path / config), "--stage", "export-qa", "--output", str(tmp_path / "out"), *more])
    status = lambda: {r.scene: r.status for r in spark.read.parquet(f"{tmp_path}/out/status").collect()}
    assert run("b.yaml") == 1
    assert status() == {"good": "pass", "black": "fail", "marked": "fail", "lacking": "fail", "torn": "fail", "untold": "fail", "bare": "fail"}
    faults = {r.scene: (r.n_errors, r.other_faults, r.in_progress_markers, r.missing_view_dirs[-6:]) for r in spark.read.parquet(f"{tmp_path}/out/structure").collect()}
    assert faults["good"] == faults["black"] == (0, "", "", "") and faults["torn"] == (1, "unreadable_frames", "", "") and faults["untold"] == (1, "missing_metadata", "", "")
    assert faults["marked"] == (1, "", "CAM_A5", "") and faults["lacking"] == (1, "", "", "CAM_E5") and faults["bare"][3] == "CAM_E5"
    assert run("b.yaml", "--scene", "good") == 0 and status() == {"good": "pass"}
    assert run("p.yaml", "--scene", "good") == 0 and status() == {"good": "warning"}


def test_stages_end_with_an_error(spark, tmp_path):
    doc = {"0001.mp4": {"master_clap_time": 1.0, "offsets": {c: {"offset_ms": 0.0, "frame_shift": 0} for c in CAMERAS[:-1]}}}
    (tmp_path / "m.json").write_text(json.dumps(doc))
    (tmp_path / "b.yaml").write_text(f"batch_id: b\ncamera: {{reference: CAM_C3, rows: [A, B, C, D, E], columns: [1, 2, 3, 4, 5]}}\npaths: {{sync_manifest: {tmp_path}/m.json, synced_root: {tmp_path}, raw_root: {tmp_path}}}\n")
    run = lambda *more: stages.main(["--config", str(tmp_path / "b.yaml"), *more])
    assert run("--stage", "sync-qa") == 2  # a camera is missing in the manifest
    assert run("--stage", "calibrate") == 2 and run("--stage", "roi-qa", "--preflight-only") == 2


def test_streaming(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for s, off in ((1, 10.0), (2, 700.0)):
        (folder / f"{s}.json").write_text(json.dumps({f"000{s}.mp4": {"master_clap_time": 1.0, "offsets": {"CAM_A1": {"offset_ms": off}}}}))
    stream = watch.manifest_stream(spark, str(folder))
    watch.keep_table(watch.absolute_alerts(stream), str(tmp_path / "alerts"), str(tmp_path / "cp")).awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "alerts")).collect()
    assert [(r.scene, r.level) for r in got] == [("0002", "abs_fail")]
    watch.keep_table(watch.absolute_alerts(watch.manifest_stream(spark, str(folder))), str(tmp_path / "alerts"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 1


def told(faults):
    return {(r.path, r.reason) for r in faults.collect()}


def test_tolerant_documents(spark, tmp_path):
    from lumengrid.sources import tolerant

    def put(name, *docs):
        folder = tmp_path / name
        folder.mkdir()
        for i, d in enumerate(docs):
            (folder / f"{i}.json").write_text(d if isinstance(d, str) else json.dumps(d))
        return str(folder)

    path = put("m", "﻿" + json.dumps({"0001.mp4": {"master_clap_time": 1, "offsets": {"CAM_A1": {"offset_ms": 5, "frame_shift": 1}, "CAM_A2": {"offset_ms": "n/a"}, "CAM_A3": 7, "CAM_A4": {"offset_ms": "6.5", "frame_shift": "x"}, "CAM_A5": {"offset_ms": "NaN"}, "CAM_B1": {"offset_ms": None}}}, "0002.mp4": {"offsets": [1]}, "0003.mp4": 3}), "{torn", "[1]")
    rows, faults = tolerant.manifest(spark, path)
    got = {r.camera_id: (r.video, r.master_clap_time, r.offset_ms, r.frame_shift) for r in rows.collect()}
    assert got["CAM_A1"] == ("0001.mp4", 1.0, 5.0, 1) and got["CAM_A4"] == ("0001.mp4", 1.0, 6.5, None) and got["CAM_A2"][2] is None and len(got) == 6
    one = '$["0001.mp4"]["offsets"]'
    assert told(faults) == {("$", "not JSON"), ("$", "not an object"), (one + '["CAM_A2"]["offset_ms"]', "not double"), (one + '["CAM_A3"]["offset_ms"]', "missing"), (one + '["CAM_A4"]["frame_shift"]', "not int"), (one + '["CAM_A5"]["offset_ms"]', "not finite"), (one + '["CAM_B1"]["offset_ms"]', "missing"), ('$["0002.mp4"]["master_clap_time"]', "missing"), ('$["0002.mp4"]["offsets"]', "not an object"), ('$["0003.mp4"]["master_clap_time"]', "missing"), ('$["0003.mp4"]["offsets"]', "not an object")}
    assert {r.file.rsplit("/", 1)[-1] for r in faults.collect()} == {"0.json", "1.json", "2.json"}

    path = put("t", {"b": {"s1": "del", "s2": [0, 2.5], "s3": [[0, 1], [3, 2], [4, 5], ["x", 1], [7]], "s4": 5, "s5": "later", "s6": []}, "other": {"s9": [0, 1]}}, "no")
    rows, faults = tolerant.time_segments(spark, path, "b")
    assert {(r.scene, r.segment_index, r.segment_count, r.start, r.end) for r in rows.collect()} == {("s2", 0, 1, 0.0, 2.5), ("s3", 0, 5, 0.0, 1.0), ("s3", 2, 5, 4.0, 5.0)}
    assert told(faults) >= {("$", "not JSON"), ('$["b"]["s3"][1]', "not a rising pair"), ('$["b"]["s3"][3]', "not a rising pair"), ('$["b"]["s3"][4]', "not a rising pair"), ('$["b"]["s4"]', "not a list of segments"), ('$["b"]["s5"]', "not a list of segments")}

    eye = [[1, 0, 0], [0, 1, 0], [0, 0, 1]]
    path = put("c", {"CAM_A1": {"K": eye, "D": [[0, 0]], "R_rel": eye, "T_rel": [1, 2, 3]}, "CAM_A2": {"K": eye[:2], "R_rel": "x", "T_rel": [1, 2]}})
    rows, faults = tolerant.calibration(spark, path)
    got = {r.camera_id: r for r in rows.collect()}
    assert got["CAM_A1"].K == eye and got["CAM_A1"].D == [0, 0] and got["CAM_A1"].T_rel == [1, 2, 3] and got["CAM_A2"].K is None
    assert told(faults) == {('$["CAM_A2"]["K"]', "not 3 x 3"), ('$["CAM_A2"]["R_rel"]', "not array<array<double>>"), ('$["CAM_A2"]["T_rel"]', "not 3")}

    path = put("r", {"schema_version": "rectification_meta_v2", "image_size": [64, 36], "rectification_asset_version": "v", "cameras": {"CAM_A1": {"map_file": "a.npz", "new_K": eye}, "CAM_A2": {"new_K": eye}}}, {"CAM_B1": {"map_file": "b.npz", "new_K": eye, "image_size": [1, 2]}, "CAM_B2": {"map_file": 5, "new_K": eye, "image_size": [1]}})
    rows, faults = tolerant.rectification(spark, path)
    got = {r.camera_id: (r.schema_version, r.map_file, r.image_size, r.asset_version) for r in rows.collect()}
    assert got["CAM_A1"] == ("rectification_meta_v2", "a.npz", [64, 36], "v") and got["CAM_B1"] == ("rectification_meta_v1_legacy", "b.npz", [1, 2], None)
    assert told(faults) == {('$["cameras"]["CAM_A2"]["map_file"]', "missing"), ('$["CAM_B2"]["image_size"]', "not 2")}

    rect = {"x": 1, "y": 2, "width": 3, "height": 4}
    first = {"rectification_asset_version": "v", "common_valid_roi": rect, "final_release_crop_16_9": rect}
    path = put("g", first, {**first, "schema_version": "release_roi_metadata_v2"}, {**first, "schema_version": "release_roi_metadata_v9"}, {"safe_rect_roi": rect, "final_release_crop_16_9": {"x": "far"}})
    rows, faults = tolerant.region(spark, path)
    got = {r.file[-6]: r for r in rows.collect()}
    assert set(got) == {"0", "1", "3"} and tuple(got["0"].safe_rect_roi) == tuple(got["3"].common_valid_roi) == (1, 2, 3, 4)
    reasons = {(r.file[-6], r.path, r.reason) for r in faults.collect()}
    assert reasons >= {("1", '$["roi_asset_version"]', "missing"), ("1", '$["safe_rect_roi"]', "missing"), ("2", '$["schema_version"]', "unknown version"), ("3", '$["rectification_asset_version"]', "missing")} and not any(f == "0" for f, *_ in reasons)
    assert any(f == "3" and p == '$["final_release_crop_16_9"]' for f, p, _ in reasons)


def test_master_videos_and_best_orientation(spark):
    from lumengrid.operators import calibration
    from lumengrid.sources import media

    paths = ["/v/CAM_A1/0002.MP4", "/v/CAM_A2/0002.MP4", "/v/CAM_A1/0001.mp4", "/v/CAM_A1/b.mp4", "/v/CAM_A1/B2.mp4", "/v/CAM_A1/notes.txt"]
    files = spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p in paths], "path string, name string")
    assert [r.name for r in media.master_videos(files).collect()] == ["0001.mp4", "0002.MP4", "b.mp4", "B2.mp4"]
    review = spark.createDataFrame([("B.MP4",), ("0002.mp4",), ("gone.mp4",)], "scene string")
    assert [r.name for r in media.master_videos(files, review).collect()] == ["0002.MP4", "b.mp4"]
    one = spark.range(1).select(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0), F.lit(-1.0)).alias("s"), F.array(F.lit(0.6), F.lit(0.8)).alias("a"), F.array(F.lit(0.8), F.lit(-0.6)).alias("b"))
    r = one.select(calibration.best_candidate(F.col("s")).alias("best"), calibration.dot(F.col("a"), F.col("b")).alias("zero"), calibration.dot(F.col("a"), F.col("a")).alias("one")).first()
    assert r.best == 1 and abs(r.zero) < 1e-12 and abs(r.one - 1) < 1e-12
