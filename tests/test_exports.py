"""Exported folders: listing by tasks, frames opened on demand, and the sink of two phases."""

import json
import os
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual, StringContains

from lumengrid.model import CAMERAS
from lumengrid.operators import export_qa
from lumengrid.plans import config, stages
from lumengrid.sources import exports, files, media

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def image(value, h=20, w=30, rim=0):
    out = np.full((h, w, 3), value, np.uint8)
    out[:rim] = 0
    return out


def make_scene(root, name, frames=12, dark=(), views=25, document=True, marker=None):
    for v in range(views):
        at = root / name / f"view_{v:02d}"
        at.mkdir(parents=True)
        for k in range(frames):
            (at / f"{k + 1:06d}.png").write_bytes(media.png(image(90 + v, rim=5 if (v, k) in dark else 0)))
        (at / "view_metadata.json").write_text(json.dumps({"output_resolution": [30, 20]}))
        if v == marker:
            (at / ".in_progress").touch()
    if document:
        (root / name / "metadata.json").write_text("{}")


def test_png_with_row_filters():
    rng = np.random.default_rng(3)
    for kind, channels in ((2, 3), (6, 4), (0, 1), (4, 2)):
        own = rng.integers(0, 256, (6, 5, channels)).astype(np.uint8)
        rows, flat = [], own.reshape(6, -1).astype(int)
        for y in range(6):
            f, step, up = y % 5, channels, flat[y - 1] if y else np.zeros(flat.shape[1], int)
            left = np.concatenate([np.zeros(step, int), flat[y][:-step]])
            corner = np.concatenate([np.zeros(step, int), up[:-step]])
            p = left + up - corner
            paeth = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
            guess = [0, left, up, (left + up) // 2, paeth][f]
            rows.append(bytes([f]) + ((flat[y] - guess) % 256).astype(np.uint8).tobytes())
        import struct

        chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 6, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")
        want = own[..., 2::-1] if channels > 2 else np.repeat(own[..., :1], 3, axis=2)
        assert np.array_equal(exports.read_png(data), want)
    deep = rng.integers(0, 256, (4, 3, 3)).astype(np.uint8)
    assert np.array_equal(exports.read_png(media.png(deep.astype(np.uint16) * 257)), deep) and np.array_equal(exports.read_png(media.png(deep)), deep)
    with pytest.raises(ValueError):
        exports.read_png(b"GIF89a")


def test_listing(spark, tmp_path):
    make_scene(tmp_path, "s1", 3)
    make_scene(tmp_path, "s2", 2, views=3, document=False, marker=1)
    (tmp_path / "s3").mkdir()
    (tmp_path / ".parts").mkdir()
    (tmp_path / "s1" / "view_00" / "notes.txt").touch()
    (tmp_path / "s1" / "view_01" / "view_metadata.json").write_text("no JSON")
    listed = exports.listing(spark, str(tmp_path))
    got = {(r.scene, r.camera_id): r for r in exports.inventory(listed).collect()}
    assert len(got) == 75 and sum(r.dir_exists for r in got.values()) == 28
    assert got["s1", "CAM_A1"].frame_files == 3 and (got["s1", "CAM_A3"].width, got["s1", "CAM_A3"].height) == (30, 20)
    assert got["s1", "CAM_A2"].has_view_metadata and got["s1", "CAM_A2"].width is None
    assert got["s2", "CAM_A2"].in_progress and not got["s2", "CAM_A1"].in_progress and not got["s2", "CAM_E5"].dir_exists
    assert {(r.scene, r.fault) for r in exports.lacking(listed).collect()} == {("s2", "missing_metadata"), ("s3", "missing_metadata")}
    names = exports.frame_names(listed).where("scene = 's1' and camera_id = 'CAM_B1'").orderBy("frame_index").collect()
    assert [(r.frame_index, r.view_id, r.name) for r in names] == [(i, "view_05", f"{i + 1:06d}.png") for i in range(3)]
    one = exports.listing(spark, str(tmp_path), "nowhere")
    assert exports.inventory(one).where("not dir_exists").count() == 25 and exports.lacking(one).count() == 1
    assert exports.listing(spark, f"{tmp_path}/none").count() == 0


def test_structure_of_a_million_paths(spark):
    """The same structure from a listing of a million frames as reckoned plainly."""
    scenes = spark.range(1_000_000).select(F.concat(F.lit("s"), (F.col("id") % 400).cast("string")).alias("scene"), F.format_string("view_%02d", (F.col("id") / 400).cast("int") % 25).alias("view_id"), F.concat((F.col("id") / 10_000).cast("int").cast("string"), F.lit(".png")).alias("name"), ((F.col("id") / 10_000).cast("int") + 1).alias("place"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"))
    scenes = scenes.where("not (scene = 's7' and view_id = 'view_03')").where("not (scene = 's8' and view_id = 'view_04' and place > 50)")
    told = scenes.select("scene", "view_id").distinct().select("scene", "view_id", F.lit("view_metadata.json").alias("name"), F.lit(None).cast("int").alias("place"), F.lit(1920).alias("width"), F.lit(1080).alias("height"))
    got = {r.scene: r for r in export_qa.structure(exports.inventory(scenes.unionByName(told))).collect()}
    assert len(got) == 400 and sum(r.n_errors for r in got.values()) == 2
    assert got["s7"].missing_view_dirs == "CAM_A4" and not got["s8"].frame_count_consistent and got["s9"].n_errors == 0


def test_reader_opens_only_what_is_asked_for(tmp_path, monkeypatch):
    make_scene(tmp_path, "s1", 6)
    make_scene(tmp_path, "s2", 6)
    opened, listed = [], []
    plain, names = exports._open, exports._names
    monkeypatch.setattr(exports, "_open", lambda store, path: (opened.append(path), plain(store, path))[1])
    monkeypatch.setattr(exports, "_names", lambda store, path: (listed.append(path), names(store, path))[1])

    def rows(*filters, shares=1):
        opened.clear(), listed.clear()
        reader = exports.FrameFiles({"path": str(tmp_path), "shares": shares, "pushdown": "true"}).reader(None)
        left = list(reader.pushFilters(list(filters)))
        return left, [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]

    left, got = rows(EqualTo(("scene",), "s2"), In(("camera_id",), ("CAM_A1", "CAM_C3", "CAM_X9")), GreaterThan(("frame_index",), 2), LessThanOrEqual(("frame_index",), 4), StringContains(("name",), "0"))
    assert [type(f) for f in left] == [StringContains] and len(opened) == len(got) == 4 and len(listed) == 2
    assert {(r["scene"], r["view_id"], r["frame_index"]) for r in got} == {("s2", v, i) for v in ("view_00", "view_12") for i in (3, 4)}
    assert got[0]["data"][:3] == bytes([90] * 3) and (got[0]["h"], got[0]["w"]) == (20, 30)
    _, got = rows(EqualTo(("frame_index",), 0), shares=2)
    assert len(got) == len(opened) == 50
    assert rows(EqualTo(("scene",), None))[1] == [] == rows(EqualTo(("scene",), "s1"), EqualTo(("scene",), "s2"))[1]


def test_data_source_in_spark(spark, tmp_path):
    make_scene(tmp_path, "s1", 4)
    (tmp_path / "s1" / "view_07" / "000002.png").write_bytes(b"torn")
    df = exports.frame_files(spark, str(tmp_path), shares=2)
    some = df.where("scene = 's1' and camera_id in ('CAM_B3', 'CAM_A1') and frame_index < 2")
    want = {("view_00", 0, True), ("view_00", 1, True), ("view_07", 0, True), ("view_07", 1, False)}
    assert {(r.view_id, r.frame_index, r.reason is None) for r in some.collect()} == want
    assert df.count() == 100 and df.where("name like '%3.png' and h = 20").count() == 25
    few = exports.frame_files(spark, str(tmp_path), ["s1"], ["CAM_B3", "CAM_A1"], [0, 1])
    assert {(r.view_id, r.frame_index, r.reason is None) for r in few.collect()} == want and few.rdd.getNumPartitions() == 2
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = exports.frame_files(spark, str(tmp_path)).where("scene = 's1' and camera_id in ('CAM_B3', 'CAM_A1') and frame_index < 2")
        assert {(r.view_id, r.frame_index, r.reason is None) for r in pushed.collect()} == want and pushed.rdd.getNumPartitions() == 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def qa(spark, root, monkeypatch):
    asked = []
    plain = exports.opened
    monkeypatch.setattr(exports, "opened", lambda s, r, wanted: (asked.append(wanted.select("scene", "camera_id", "frame_index").collect()), plain(s, r, wanted))[1])
    batch = config.Batch({"batch_id": "b", "paths": {"output_root": str(root), "checks_root": f"{root}/checks"}})
    tables = {k: v.collect() for k, v in stages.export_qa_stage(spark, batch, None, "benchmark").items()}
    files.clear(spark)
    return tables, asked


def test_sampling_in_two_phases(spark, tmp_path, monkeypatch):
    root = tmp_path / "benchmark"
    make_scene(root, "calm", 40)
    make_scene(root, "dark", 40, dark={(3, 0), (3, 10), (9, 39)})
    make_scene(root, "faulty", 2, document=False)
    tables, asked = qa(spark, tmp_path, monkeypatch)
    assert {r.scene: r.status for r in tables["status"]} == {"calm": "pass", "dark": "fail", "faulty": "fail"}
    first, second = asked
    assert len(first) == 2 * 25 * 3 and {r.scene for r in second} == {"dark"}
    assert len(second) == 25 * 6  # the other three of nine are known already
    assert {(r.scene, r.upgraded, r["count"]) for r in spark.createDataFrame(tables["samples"]).groupBy("scene", "upgraded").count().collect()} == {("calm", False, 75), ("dark", True, 225)}
    report = {r.scene: r for r in tables["reports"]}
    assert {s: r.summary for s, r in report.items()} == {"calm": "sound", "dark": "black borders", "faulty": "structural faults, not sampled"}
    assert report["faulty"].scene_errors == ["missing_metadata"] and report["faulty"].sampling_plan is None and report["calm"].suspicious_reasons == []
    plan = report["dark"].sampling_plan
    assert (plan.initial_sample_count, plan.final_sample_count, plan.upgraded) == (3, 9, True) and plan.sample_frame_indices == sorted(plan.sample_frame_indices)
    assert ("CAM_A4", 0, "black_border") in {tuple(x) for x in report["dark"].suspicious_reasons} and ("CAM_B5", 39, "black_edge:top") in {tuple(x) for x in report["dark"].suspicious_reasons}
    assert len(report["dark"].views) == 25 and len(report["dark"].views["CAM_A4"].border_samples) == 9 and report["dark"].views["CAM_A1"].output_resolution == [30, 20]
    assert [w.rank for w in report["dark"].border_worst_cameras] == list(range(1, 11)) and report["dark"].border_worst_cameras[0].camera_id in ("CAM_A4", "CAM_B5")
    told = json.loads((tmp_path / "checks" / "dark" / "check_report.json").read_text())
    assert told["status"] == "fail" and len(told["views"]["CAM_E5"]["border_samples"]) == 9 and told["sampling_plan"]["final_sample_count"] == 9
    assert {(r.scene, r.status, r.upgraded, r.final_sample_count) for r in tables["scenes"]} == {("calm", "pass", False, 3), ("dark", "fail", True, 9), ("faulty", "fail", None, None)}
    # the same samples as of all frames at once
    listed = exports.listing(spark, str(root))
    views = exports.inventory(listed).where("frame_files = 40").select("scene", "camera_id", "frame_files")
    every = stages.border_figures(exports.frame_files(spark, str(root)).where("scene <> 'faulty'"), config.Batch().limits)
    want = export_qa.adaptive(every, export_qa.sampling_plan(views, 3), export_qa.sampling_plan(views, 9))
    plain = lambda rows, cols: sorted(str([r[c] for c in cols]) for r in rows)
    cols = ["scene", "camera_id", "frame_index", "black_ratio", "near_ratio", "black_run", "near_run", "upgraded"]
    assert plain(tables["samples"], cols) == plain(want.collect(), cols)


def test_long_views_open_three_frames(spark, tmp_path, monkeypatch):
    root = tmp_path / "benchmark"
    make_scene(root, "long", 1)
    for v in range(25):
        for k in range(1, 1500):
            os.link(root / "long" / f"view_{v:02d}" / "000001.png", root / "long" / f"view_{v:02d}" / f"{k + 1:06d}.png")
    tables, asked = qa(spark, tmp_path, monkeypatch)
    assert tables["status"][0].status == "pass" and [len(a) for a in asked] == [75, 0]
    (root / "long" / "view_04" / "000001.png").unlink()
    (root / "long" / "view_04" / "000001.png").write_bytes(b"torn")
    tables, _ = qa(spark, tmp_path, monkeypatch)
    assert tables["status"][0].status == "fail" and tables["structure"][0].other_faults == "unreadable_frames"


# ---------------------------------------------------------------- sink


def numbered(spark, scenes=("a", "b"), frames=6, parts=5, h=4, w=5):
    rows = [(s, f"view_{v:02d}", k + 1, h, w, image(v * 3 + k, h, w).tobytes()) for s in scenes for v in range(25) for k in range(frames)]
    return spark.createDataFrame(rows, exports.FrameSink({}).schema()).repartition(parts)


def pictures(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*.png") if ".parts" not in p.parts)


def test_sink(spark, tmp_path):
    won = exports.write_frames(numbered(spark), str(tmp_path), "j1")
    assert pictures(tmp_path) == [] and won.agg(F.sum("n")).first()[0] == 300 and sorted(p.name for p in tmp_path.iterdir()) == [".parts"]
    done = exports.publish(str(tmp_path), "j1", won).collect()
    assert len(done) == 50 and {(r.frame_count, r.width, r.height) for r in done} == {(6, 5, 4)}
    assert len(pictures(tmp_path)) == 300 and len(list(tmp_path.rglob(".in_progress"))) == 50
    assert len(exports.publish(str(tmp_path), "j1", won).collect()) == 50 and len(pictures(tmp_path)) == 300  # again
    assert exports.settle(str(tmp_path), won.select("scene", "view_id").distinct()) == 50 and not list(tmp_path.rglob(".in_progress"))
    assert exports.read_png((tmp_path / "a" / "view_02" / "000004.png").read_bytes())[0, 0, 0] == 9
    deep = numbered(spark, ("c",), 1).withColumn("data", F.expr("cast(repeat('ab', 60) as binary)"))
    exports.publish(str(tmp_path), "j2", exports.write_frames(deep, str(tmp_path), "j2", bits=16)).count()
    assert (tmp_path / "c" / "view_00" / "000001.png").read_bytes()[24] == 16


def test_failed_job_leaves_nothing(spark, tmp_path):
    bad = numbered(spark).withColumn("h", F.when((F.col("scene") == "b") & (F.col("view_id") == "view_20"), F.raise_error(F.lit("broken frame")).cast("int")).otherwise(F.col("h")))
    with pytest.raises(Exception, match="broken frame"):
        exports.write_frames(bad, str(tmp_path), "j")
    assert pictures(tmp_path) == [] and not (tmp_path / ".parts" / "j").exists() or not list((tmp_path / ".parts").rglob("committed.json"))
    assert exports.recover(spark, str(tmp_path)) == 0 and not list(tmp_path.iterdir())


class Context:
    def __init__(self, part, attempt):
        self.part, self.attempt = part, attempt

    def partitionId(self):
        return self.part

    def taskAttemptId(self):
        return self.attempt


def test_speculative_copy(spark, tmp_path, monkeypatch):
    """Two attempts of one task write all they have; the commit names one, and only its files appear."""
    own = lambda value: pa.RecordBatch.from_pylist([{"scene": "s", "view_id": "view_00", "number": k, "h": 4, "w": 5, "data": image(value, 4, 5).tobytes()} for k in (1, 2)], schema=pa.schema([("scene", pa.string()), ("view_id", pa.string()), ("number", pa.int32()), ("h", pa.int32()), ("w", pa.int32()), ("data", pa.binary())]))
    writer = exports.FrameWriter({"path": str(tmp_path), "job": "j"})
    told = []
    for attempt in (7, 8):
        monkeypatch.setattr(exports.TaskContext, "get", classmethod(lambda cls, a=attempt: Context(0, a)))
        told.append(writer.write(iter([own(attempt)])))
    monkeypatch.undo()
    writer.commit([told[1], None])
    exports.publish(str(tmp_path), "j", exports.committed(spark, str(tmp_path), "j")).count()
    assert pictures(tmp_path) == ["s/view_00/000001.png", "s/view_00/000002.png"]
    assert exports.read_png((tmp_path / "s" / "view_00" / "000002.png").read_bytes())[0, 0, 0] == 8


def test_recovery_undoes_what_is_half_published(spark, tmp_path):
    make_scene(tmp_path, "a", 1)  # complete already
    won = exports.write_frames(numbered(spark, ("a", "b", "c")), str(tmp_path), "j")
    exports.publish(str(tmp_path), "j", won.where("scene = 'b' and view_id < 'view_09'")).count()
    (tmp_path / ".parts" / "old").mkdir()
    assert exports.recover(spark, str(tmp_path)) == 1
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a"] and len(pictures(tmp_path)) == 25
    assert exports.recover(spark, str(tmp_path)) == 0 == exports.recover(spark, f"{tmp_path}/none")


KILLED = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from lumengrid.sources import exports
from tests.test_exports import numbered
root = sys.argv[1]
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{{root}}/shared").config("spark.sql.execution.arrow.maxRecordsPerBatch", "10").getOrCreate()
rows = numbered(spark, h=64, w=64)  # more than what lies in buffers

def dies(batches):
    for n, b in enumerate(batches):
        if n == 4 and TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() in (1, 3):
            raise RuntimeError("killed half way") if TaskContext.get().partitionId() == 1 else SystemExit(1)
        yield b

won = exports.write_frames(rows.mapInArrow(dies, rows.schema), f"{{root}}/out", "j")
assert won.agg({{"n": "sum"}}).first()[0] == 300
tried = {{p.split("-")[0] for p in os.listdir(f"{{root}}/out/.parts/j") if "-" in p}}
assert len([p for p in os.listdir(f"{{root}}/out/.parts/j") if "-" in p]) > len(tried)  # the attempts that died left files
exports.publish(f"{{root}}/out", "j", won).count()
exports.drop(f"{{root}}/out/.parts")
"""


def test_killed_tasks(tmp_path):
    env = {**os.environ, "SPARK_LOCAL_IP": "127.0.0.1"}
    run = subprocess.run([sys.executable, "-c", KILLED.format(repo=REPO), str(tmp_path)], cwd=REPO, env=env, capture_output=True, text=True, timeout=240)
    assert run.returncode == 0, run.stderr[-3000:]
    root = tmp_path / "out"
    assert len(pictures(root)) == 300 and sorted(p.name for p in root.iterdir()) == ["a", "b"]
    assert exports.read_png((root / "b" / "view_24" / "000006.png").read_bytes())[0, 0, 0] == 77
    assert len(CAMERAS) == len(list((root / "a").iterdir()))


#: A JPEG of one grey pixel block, 8 x 8.
JPEG = "ffd8ffe000104a46494600010100000100010000ffdb004300" + "10" * 64 + "ffc0000b080008000801011100ffc4001f0000010501010101010100000000000000000102030405060708090a0bffc400b5100002010303020403050504040000017d01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a434445464748494a535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9faffda0008010100003f00" + "28a0" + "ffd9"


def test_jpegs_by_name(spark, tmp_path, monkeypatch):
    for v in range(2):
        at = tmp_path / "s" / f"view_{v:02d}"
        at.mkdir(parents=True)
        for k in range(4):
            (at / f"{k + 1:06d}.jpg").write_bytes(bytes.fromhex(JPEG) if k != 3 else b"torn")
    names = exports.frame_names(exports.listing(spark, str(tmp_path)))
    plan = names.where("frame_index in (0, 3)")
    for most in (1000, 1):
        monkeypatch.setattr(exports, "MOST_NAMES", most)
        got = {(r.camera_id, r.frame_index): (r.h, r.w, r.reason) for r in exports.opened(spark, str(tmp_path), plan).collect()}
        assert got == {(c, k): ((8, 8, None) if k == 0 else (None, None, "unreadable")) for c in ("CAM_A1", "CAM_A2") for k in (0, 3)}
