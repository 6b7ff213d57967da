"""Every query against its SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from lumengrid.plans.queries import ORACLE, QUERIES
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def value(v):
    return float(f"{v:.9g}") if isinstance(v, float) else str(v) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLE[name])
    names = [x[0] for x in cur.description]
    assert sorted(got.columns) == sorted(names)
    want = Counter(tuple(value(dict(zip(names, r))[n]) for n in sorted(names)) for r in cur.fetchall())
    assert Counter(tuple(value(r[n]) for n in sorted(names)) for r in got.collect()) == want


def duck_rows(name, folder):
    c = duckdb.connect()
    for x in TABLES:
        c.execute(f"create view {x} as select * from read_parquet('{folder}/{x}.parquet')")
    cur = c.execute(ORACLE[name])
    names = [x[0] for x in cur.description]
    return Counter(tuple(value(dict(zip(names, r))[n]) for n in sorted(names)) for r in cur.fetchall())


@pytest.mark.parametrize("name", ["roi_common_mask", "roi_crop_margins", "roi_largest_rectangle", "roi_blind_cameras", "calibration_risks", "scene_status_counts", "adaptive_samples", "preflight_camera_sets", "export_completion", "export_resume", "metadata_sequences", "residual_stats", "calibration_residuals", "roi_bounding_box", "frames_in_segments", "exported_files", "adaptive_reads", "calibration_described", "calibration_orientations", "streamed_checksums"])
def test_whole_tables(spark, name):
    """On larger tables too."""
    folder = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, folder)
    rows = Counter(tuple(value(r[n]) for n in sorted(got.columns)) for r in got.collect())
    assert rows and rows == duck_rows(name, folder)


def test_every_row_counts(spark, tmp_path):
    """Suppliers beyond 25, frames of any number and all scenes change results."""
    few = tmp_path / "few"
    few.mkdir()
    for x in TABLES:
        os.symlink(f"/root/testdata/sf0.01/{x}.parquet", few / f"{x}.parquet")
    os.unlink(few / "supplier.parquet")
    spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").where("s_suppkey > 25").coalesce(1).write.parquet(f"{few}/supplier.parquet")
    assert QUERIES["roi_common_mask"](spark, str(few)).count() == 48 * 32
    assert QUERIES["roi_crop_margins"](spark, str(few)).where("camera_id is not null").select("camera_id").distinct().count() == 25
    r = QUERIES["roi_largest_rectangle"](spark, str(few)).collect()[0]
    assert r.width * r.height > 0
    assert QUERIES["roi_bounding_box"](spark, str(few)).collect()[0].width > 0
    status = {r.status: r.n_scenes for r in QUERIES["scene_status_counts"](spark, str(few)).collect()}
    assert sum(status.values()) == 40 and min(status.values()) > 0
    assert QUERIES["adaptive_samples"](spark, str(few)).select("scene").distinct().count() == 30
    assert {r.upgraded for r in QUERIES["adaptive_samples"](spark, str(few)).collect()} == {True, False}
    assert {r.reason for r in QUERIES["calibration_risks"](spark, str(few)).collect()} >= {"detected_frames_less_than_5", "detection_rate_below_30_percent"}


def test_faulty_cases_are_there(spark):
    """Scenes with 3 of 25 views, or without the scene's metadata, aren't complete."""
    folder = "/root/testdata/sf0.01"
    got = {r.scene: (r.n_views, r.state) for r in QUERIES["export_completion"](spark, folder).collect()}
    assert got[100] == (3, "partial") and got[101] == (25, "complete") and got[102] == (25, "partial")
    assert {r.scene for r in QUERIES["export_resume"](spark, folder).collect()} >= {100, 102} and 101 not in {r.scene for r in QUERIES["export_resume"](spark, folder).collect()}
    assert "missing_phase_offset" in {r.phase_status for r in QUERIES["export_tasks"](spark, SF).collect()}
    states = {r.phase_status for d in (SF, folder) for r in QUERIES["metadata_sequences"](spark, d).collect()}
    assert states >= {"missing_reference_phase", "reference_phase_not_zero", "missing_phase_offset"}
