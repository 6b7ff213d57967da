"""Operators that deal large groups out: words and bands of masks, time buckets, quantiles, checksums, and what a stage does with many or absent rows."""

import json
import os
import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumengrid.functions import stats
from lumengrid.model import CAMERAS, REFERENCE
from lumengrid.operators import calibration, provenance, roi, segments
from lumengrid.plans import build, config
from lumengrid.sources import files


def words_of(spark, mask, cameras=("A",)):
    rows = []
    for c in cameras:
        for y in range(mask.shape[0]):
            for b in range(-(-mask.shape[1] // 64)):
                bits = sum(int(v) << i for i, v in enumerate(mask[y, b * 64 : b * 64 + 64]))
                rows.append((c, y, b, bits - (1 << 64) if bits >> 63 else bits))
    return spark.createDataFrame(rows, "camera_id string, y int, block int, bits long")


def plain_rectangle(mask):
    """All rectangles, the hard way: the largest, then by bottom row, right edge, and height."""
    best = None
    h, w = mask.shape
    total = np.zeros((h + 1, w + 1), int)
    total[1:, 1:] = mask.cumsum(0).cumsum(1)
    for y0 in range(h):
        for y1 in range(y0 + 1, h + 1):
            full = [total[y1, x + 1] - total[y0, x + 1] - total[y1, x] + total[y0, x] == y1 - y0 for x in range(w)]
            x = 0
            while x < w:
                if full[x]:
                    e = x
                    while e < w and full[e]:
                        e += 1
                    key = (-(e - x) * (y1 - y0), y1, e, -(y1 - y0))
                    best = min(best, (key, (x, y0, e - x, y1 - y0))) if best else (key, (x, y0, e - x, y1 - y0))
                    x = e
                else:
                    x += 1
    return best and best[1]


@pytest.mark.parametrize("band", [3, 8, 64])
def test_rectangle_by_bands(spark, band):
    rng = np.random.default_rng(band)
    masks = [rng.random((20, 70)) < p for p in (0.2, 0.7, 0.95)] + [np.ones((17, 66), bool), np.zeros((9, 3), bool)]
    tall = np.zeros((25, 64), bool)
    tall[2:24, 63] = tall[5:9, 10:31] = True
    ties = np.zeros((24, 40), bool)
    ties[3:6, 4:8] = ties[3:7, 20:23] = ties[15:18, 1:5] = True
    for mask in [*masks, tall, ties]:
        common = roi.common_words(words_of(spark, mask))
        got = roi.largest_rectangle(common, band).first()
        want = plain_rectangle(mask)
        assert tuple(got) == (want or (None,) * 4)
        box = roi.bounding_box(common).first()
        ys, xs = np.nonzero(mask)
        assert tuple(box) == ((xs.min(), ys.min(), xs.max() + 1 - xs.min(), ys.max() + 1 - ys.min()) if len(ys) else (None,) * 4)
    holes = words_of(spark, np.ones((20, 64), bool)).where("y not between 8 and 10")  # rows without words end what stands on them
    assert tuple(roi.largest_rectangle(roi.common_words(holes), band).first()) == (0, 11, 64, 9)


def test_words_of_pixels(spark):
    rng = np.random.default_rng(2)
    rows = [(c, y, x, float(rng.uniform(0, 12)), float(rng.uniform(0, 8))) for c in ("a", "b", "c") for y in range(5) for x in range(70)]
    rows += [("a", 1, 1, 99.0, 99.0), ("a", 2, 2, None, 4.0)]  # a second, invalid value of a pixel, and a null
    df = spark.createDataFrame(rows, "camera_id string, y int, x int, map_x double, map_y double")
    got = {(r.y, r.block): r.bits & ((1 << 64) - 1) for r in roi.common_words(roi.words(df, 12, 8, 1)).collect()}
    ok = {}
    for c, y, x, u, v in rows:
        ok[y, x] = ok.get((y, x), True) and u is not None and 1 <= u <= 10 and 1 <= v <= 6
    want = {}
    for (y, x), k in ok.items():
        want[y, x // 64] = want.get((y, x // 64), 0) | (int(k) << x % 64)
    assert got == want


def test_frames_of_long_segments(spark):
    """The buckets' join and numbers are those of the plain interval join; no task has over twice the median of an hour-long scene."""
    rng = np.random.default_rng(5)
    rows = [("s", CAMERAS[i % 25], i, float(t)) for i, t in enumerate(rng.uniform(0, 3600, 30_000))]
    rows += [("s", "CAM_A1", 50_000 + i, 60.0) for i in range(4)] + [("s", "CAM_A1", 60_000, None), ("s", "CAM_A1", 60_001, float("nan")), ("t", "CAM_A1", 1, -5.0), ("t", "CAM_A1", 2, 0.0)]
    frames = spark.createDataFrame(rows, "scene string, camera_id string, frame_index int, t double")
    cuts = [("s", 0, 0.0, 3600.0), ("s", 1, 59.5, 60.0), ("s", 2, 100.0, float("inf")), ("s", 3, 5.0, 4.0), ("t", 0, -1e12, 1e12), ("u", 0, 0.0, 9.0), ("s", 4, 1e9, 2e9)]
    parts = spark.createDataFrame(cuts, "scene string, segment_index int, start double, end double")
    got = segments.frames_in_segments(frames, parts)
    want = {}
    for scene, k, a, b in cuts:
        for c in CAMERAS:
            own = sorted((t, f) for s, cam, f, t in rows if s == scene and cam == c and t is not None and a <= t <= b)
            want |= {(scene, k, c, f): i + 1 for i, (_, f) in enumerate(own)}
    assert {(r.scene, r.segment_index, r.camera_id, r.frame_index): r.out_frame for r in got.collect()} == want
    assert got.columns == ["scene", "camera_id", "frame_index", "t", "segment_index", "start", "end", "out_frame"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for k, v in (("spark.sql.shuffle.partitions", "16"), ("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(k, v)
    try:
        one = segments.frames_in_segments(frames.where("scene = 's'"), parts.where("segment_index = 0"))
        sizes = sorted(r["count"] for r in one.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def test_quantiles_of_large_groups(spark, monkeypatch):
    rng = np.random.default_rng(0)
    values = {"a": rng.normal(size=4000), "b": np.repeat([1.0, 2.0, 3.0], [1, 500, 2]), None: rng.normal(size=3000), "c": np.array([4.0])}
    df = spark.createDataFrame([(k, float(v)) for k, own in values.items() for v in own] + [("d", None)], "k string, v double")
    for distinct, many in ((200_000, 10), (1000, 10), (1000, 1)):
        monkeypatch.setattr(stats, "DISTINCT", distinct)
        monkeypatch.setattr(stats, "MANY", many)
        got = {r.k: (r.m, r.p) for r in stats.quantiles(df, "v", ["k"], {"m": 0.5, "p": 0.95}).collect()}
        assert set(got) == set(values) and all(np.allclose(got[k], np.quantile(own, [0.5, 0.95]), rtol=1e-12) for k, own in values.items())


def test_quantiles_of_a_million_groups(spark):
    df = spark.range(2_000_000).select((F.col("id") % 1_000_000).alias("k"), F.col("id").cast("double").alias("v"))
    got = stats.quantiles(df, "v", ["k"], {"m": 0.5})
    assert got.agg(F.count(F.lit(1)), F.sum(F.when(F.col("m") == F.col("k") + 500_000, 1).otherwise(0))).first() == (1_000_000, 1_000_000)
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_checksums_stream(spark, tmp_path):
    """Three gigabytes with flat memory, and the checksums of small files."""
    import hashlib

    big = tmp_path / "big.bin"
    with open(big, "wb") as f:
        f.truncate(3 << 30)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    sha, n = provenance.streamed_checksum(str(big))
    assert n == 3 << 30 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 64_000  # kilobytes
    os.truncate(big, 1000)
    (tmp_path / "empty.bin").touch()
    got = {r.path.rsplit("/", 1)[-1]: (r.checksum, r.length) for r in provenance.file_checksums(spark.createDataFrame([(str(big),), (f"file://{tmp_path}/empty.bin",)], "path string")).collect()}
    assert got == {"big.bin": (hashlib.sha256(bytes(1000)).hexdigest(), 1000), "empty.bin": (hashlib.sha256(b"").hexdigest(), 0)}
    with pytest.raises(Exception, match="nowhere"):
        provenance.file_checksums(spark.createDataFrame([(f"{tmp_path}/nowhere",)], "path string")).collect()


def test_described_detections(spark):
    flat = lambda g: [float(v) for p in g.reshape(-1, 2) for v in p]
    board = np.array([[[c, r] for c in range(4)] for r in range(4)], float)
    seen = board @ np.array([[30.0, 4.0], [-5.0, 28.0]]) + 100
    wide = np.array([[[c, r] for c in range(5)] for r in range(3)], float)
    turned = [np.rot90(np.flip(seen, 1) if m else seen, k) for m in (0, 1) for k in range(4)]
    rows = [(REFERENCE, 3, flat(board), flat(seen)), (REFERENCE, 1, flat(board), []), (REFERENCE, 2, flat(board), None), ("CAM_A1", 0, flat(board), flat(np.zeros((4, 4, 2))))]
    rows += [("CAM_B1", k, flat(board), flat(t)) for k, t in enumerate(turned)] + [("CAM_B2", 0, flat(wide), flat(wide * 9)), ("CAM_B2", 1, flat(wide), flat(np.flip(wide, 1) * 9))]
    got = {(r.camera_id, r.frame_index): r for r in calibration.described(spark.createDataFrame(rows, build.GIVEN["detections"])).collect()}
    assert len(got) == len(rows)
    assert [got[REFERENCE, k].reason for k in (1, 2, 3)] == ["checkerboard_not_found", "read_failed", None] and got["CAM_A1", 0].reason == "orientation_align_failed"
    assert not got["CAM_A1", 0].detected and got["CAM_A1", 0].score is None
    unit = lambda v: v / np.linalg.norm(v)
    ends = lambda g: (unit((g[:, -1] - g[:, 0]).mean(0)), unit((g[-1] - g[0]).mean(0)))
    rx, ry = ends(seen)
    for k, t in enumerate(turned):  # the best of all eight is the reference's own
        r = got["CAM_B1", k]
        assert r.detected and abs(r.score - 2) < 1e-9 and np.allclose((r.cx, r.cy), seen.reshape(-1, 2).mean(0))
        assert np.isclose(r.area, np.prod(np.ptp(seen.reshape(-1, 2), axis=0)))
    x, y = ends(wide * 9)
    best = max(sx * x @ rx + sy * y @ ry for sx in (1, -1) for sy in (1, -1))
    assert np.isclose(got["CAM_B2", 0].score, best) and np.isclose(got["CAM_B2", 1].score, best)


def test_an_absent_camera_is_a_risk(spark, tmp_path):
    from tests.test_stages import K, detections

    told = {c: {"K": K.tolist(), "D": [[0.0] * 5], "R_rel": np.eye(3).tolist(), "T_rel": [0.0] * 3} for c in CAMERAS}
    (tmp_path / "c.json").write_text(json.dumps(told))
    detections(spark, [c for c in CAMERAS[:8] + [REFERENCE]]).write.parquet(f"{tmp_path}/d")
    batch = config.Batch({"batch_id": "b", "paths": {"detections": f"{tmp_path}/d", "calibration_json": f"{tmp_path}/c.json"}})
    tables = build.calibration_qa(spark, batch)
    found = {r.camera_id: r for r in tables["detections"].collect()}
    assert len(found) == 25 and found["CAM_E5"].n_detected == 0 and found["CAM_A1"].n_detected == 6
    assert found["CAM_A1"].max_area > 0 and 0 < found["CAM_A1"].min_score <= 2.0001
    failed = {r.camera_id for r in tables["risks"].where("level = 'fail' and reason = 'detected_frames_less_than_5'").collect()}
    assert failed == set(CAMERAS) - set(CAMERAS[:8]) - {REFERENCE}


def test_all_sidecars_are_written(spark, tmp_path):
    """4,000 sidecars, though nothing is done with the stage's tables."""
    doc = {f"{v:04d}.mp4": {"master_clap_time": 1.0, "offsets": {c: {"offset_ms": 0.0, "frame_shift": 0} for c in CAMERAS}} for v in range(160)}
    (tmp_path / "m.json").write_text(json.dumps(doc))
    spark.createDataFrame([(v, c, 9.0) for v in doc for c in CAMERAS], build.GIVEN["clips"]).write.parquet(f"{tmp_path}/clips")
    batch = config.Batch({"batch_id": "b", "paths": {"sync_manifest": f"{tmp_path}/m.json", "clips": f"{tmp_path}/clips", "synced_root": f"{tmp_path}/synced"}})
    build.sync_clip(spark, batch)
    assert sum(1 for _ in (tmp_path / "synced").rglob("*.json")) == 4000
    files.clear(spark)
