"""Figures kept up to date by a stream equal those of a batch, after restarts too."""

import json

import numpy as np
import pytest

from lumengrid.functions import stats
from lumengrid.streaming import robust, watch


def test_weighted_medians():
    rng = np.random.default_rng(1)
    for _ in range(200):
        values = np.unique(rng.integers(-9, 9, rng.integers(1, 8))).astype(float)
        counts = rng.integers(1, 5, len(values))
        flat = np.repeat(values, counts)
        n, median, mad, least, most = robust.figures(values, counts)
        assert (n, median, mad, least, most) == (len(flat), np.median(flat), np.median(np.abs(flat - np.median(flat))), flat.min(), flat.max())


@pytest.mark.parametrize("by", ["camera_id", "scene"])
def test_incremental_figures(spark, tmp_path, by):
    rng, folder = np.random.default_rng(3), tmp_path / "in"
    folder.mkdir()

    def arrive(k):
        doc = {f"{k:02d}{v}.mp4" if by == "camera_id" else f"00{v}.mp4": {"master_clap_time": 1.0, "offsets": {f"CAM_A{c}": {"offset_ms": "n/a" if (k, c) == (1, 2) else float(rng.integers(-50, 50) * 2)} for c in range(1, 6)}} for v in range(3)}
        (folder / f"{k}.json").write_text(json.dumps(doc))

    def run():
        robust.keep_figures(watch.manifest_stream(spark, str(folder)), by, f"{tmp_path}/table", f"{tmp_path}/check").awaitTermination(240)

    def same():
        got = {r.key: (r.n, r.median, r.mad, r.least, r.most) for r in robust.latest(spark, f"{tmp_path}/table").collect()}
        from lumengrid.sources import documents

        rows = documents.manifest(spark, str(folder)).where("offset_ms is not null")
        want = {r[by]: (r.n, r.median_ms, r.mad_ms, r.min_ms, r.max_ms) for r in stats.spread(rows, "offset_ms", by).collect()}
        assert got == want and len(got) > 2

    for k in range(2):
        arrive(k)
    run()
    same()
    arrive(2)
    run()  # a new query from the old checkpoint
    same()
    before = robust.latest(spark, f"{tmp_path}/table").count()
    run()  # nothing new
    assert robust.latest(spark, f"{tmp_path}/table").count() == before
