"""Language identification, the Merkle manifest and centroid clustering against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumengrid.llm import centroids, language, merkle
from lumengrid.llm.entry import queries
from tests.conftest import SF


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(fields):
    return h(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def plain_tree(digests):
    """Root, and for each leaf the siblings as (place, others)."""
    paths, under, now = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(now) > 1:
        runs = [(now[k : k + 3], under[k : k + 3]) for k in range(0, len(now), 3)]
        for ds, us in runs:
            for j, u in enumerate(us):
                for i in u:
                    paths[i].append((j, ds[:j] + ds[j + 1 :]))
        now, under = [h(ds) for ds, _ in runs], [[i for u in us for i in u] for _, us in runs]
    return now[0], paths


def plain_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[s] = (own, *plain_tree([plain_leaf(r) for r in own]))
    root, tops = plain_tree([trees[s][1] for s in names])
    out = []
    for k, s in enumerate(names):
        own, sub, paths = trees[s]
        for r, path in zip(own, paths):
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            d = plain_leaf((*r[:4], text))
            for j, others in (*path, *tops[k]):
                d = h([*others[:j], d, *others[j:]])
            out.append((r[0], plain_leaf(r), sub, root, h([o for _, others in (*path, *tops[k]) for o in others]), d, d == root))
    return out


KIND = "doc_id long, source string, lang string, n_chars long, text string"


def docs(n, rnd, hot=0.4):
    return [(i, "hot" if rnd.random() < hot else rnd.choice([None, "", "a", "ä", "z", "zz"]), rnd.choice([None, "en"]), rnd.choice([None, i]), rnd.choice([None, "", "x\ny", "two words", "é\n\n"])) for i in range(n)]


def flat(df):
    return sorted((str(tuple(r)) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


@pytest.mark.parametrize("n,deep", [(1, 1), (2, 1), (40, 1), (300, 1), (300, 2), (1000, 5)])
def test_merkle(spark, monkeypatch, n, deep):
    monkeypatch.setattr(merkle, "DEEP", deep)
    monkeypatch.setattr(merkle, "BLOCK", 3**deep)
    rows = docs(n, random.Random(n))
    if n == 40:
        rows += [rows[3], rows[3], (None, "a", None, 3, "n\n"), (None, "a", None, 2, "m\n"), (7, "a", "x", 1, None), (9, "one", None, None, "l\n" * 100_000)]
    df = spark.createDataFrame(rows, KIND).withColumns({"tree": F.lit("t"), "leaf": F.lit(1), "place": F.lit(3), "n": F.lit(2), "digest": F.lit("d")}).repartition(5)
    assert flat(merkle.manifest(df)) == sorted(str(r) for r in plain_manifest(rows))


def test_merkle_many_sources_and_nothing(spark):
    rows = [(i, f"s{i % 400}", "en", i, f"t{i}\n") for i in range(900)]
    assert flat(merkle.manifest(spark.createDataFrame(rows, KIND))) == sorted(str(r) for r in plain_manifest(rows))
    empty = merkle.manifest(spark.createDataFrame([], KIND))
    assert empty.count() == 0 and empty.columns[-1] == "verified"


def test_merkle_proofs_alone():
    for n in (1, 2, 3, 4, 10, 26, 27):
        own = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
        root, proofs = merkle.walk(own, merkle.levels(n))
        assert root.hex() == plain_tree([d.hex() for d in own])[0]
        assert all(merkle.fold(d, bytes(p)) == root for d, p in zip(own, proofs))
        assert all(merkle.fold(own[0], bytes(p)) != root for p in proofs[1:])


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), [str(x) for x in r[1]]))
    c = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, m), j) for j, m in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        c = [[sum(col) // len(g) for col in zip(*g)] if (g := [v for (_, v), o in zip(kept, own) if o == j]) else m for j, m in enumerate(c)]
    got = [(i, *near(v)[::-1]) for i, v in kept]
    sums = {j: sum(d for _, o, d in got if o == j) for j in range(len(c))}
    fit = lambda x: x if x < 1 << 63 else None
    return sorted(str((i, j, fit(d), fit(sums[j]), fit(sum(sums.values())), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())) for i, j, d in got)


def test_centroids(spark):
    rnd = random.Random(2)
    vec = lambda size=1.0: [float(np.float32(rnd.gauss(0, size))) for _ in range(64)]
    rows = [(i, vec()) for i in range(200)]
    rows += [rows[5], rows[5], (None, vec()), (300, None), (301, []), (302, vec()[:63]), (303, [None, *vec()[1:]]), (304, [math.nan, *vec()[1:]]), (305, [math.inf, *vec()[1:]]), (5, vec())]
    kind = "vec_id long, embedding array<float>"
    run = lambda rows, parts=3: sorted(str(tuple(r)) for r in centroids.clusters(spark.createDataFrame(rows, kind).withColumns({"cluster": F.lit(1), "label": F.lit("x")}).repartition(parts)).collect())
    assert run(rows) == plain_clusters(rows) == run(rows, 7)
    for size in (1e5, 3e6, 2e7, 1e18, 1e37):  # float64, 64-bit integers, Python's integers
        some = [(i, vec(size)) for i in range(40)]
        assert run(some) == plain_clusters(some)
    assert run(rows[:3]) == plain_clusters(rows[:3]) and run([]) == [] and run([(1, None)]) == []
    same = [(i, rows[0][1]) for i in range(50)]
    assert run(same) == plain_clusters(same)


def test_distances_beyond_each_bound():
    rng = np.random.default_rng(1)
    for size, kind in ((10**3, np.int64), (2 * 10**7, np.int64), (10**9, np.int64), (10**30, object)):
        x = np.array([[int(v * size) for v in row] for row in rng.uniform(-1, 1, (30, 64))], dtype=kind)
        c = [[int(v) for v in row] for row in x[:7]] + [[int(v) for v in x[3]]]
        number, distance = centroids.nearest(x, c, 11)
        for v, k, d in zip(x.tolist(), number, distance):
            assert (d, k) == min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    kept, x = centroids.integers(pa.array([[1e308] * 64, None, [0.51] * 64], pa.list_(pa.float64())))
    assert kept.tolist() == [True, False, True] and int(x[0][0]) == int(1e308) * 64 and int(x[1][0]) == 32


def plain_counts(text):
    out = np.zeros(language.CELLS)
    low = text.lower()
    c = [0, *(ord(x) if x.isalpha() else 0 for x in low), 0]
    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    for n in (1, 2, 3):
        for i in range(len(c) - n + 1):
            g = c[i : i + n]
            ok = g[0] if n == 1 else (g[0] or g[1]) if n == 2 else g[1]
            if ok:
                h = sum(x * int(language._STRIDE[j]) + j + 1 for j, x in enumerate(g)) & mask
                out[mix(h) & (language.CELLS - 1)] += 1
    return out


def test_grams():
    for text in ("Aé b", "one", "x1 Straße İ 漢字 a", "a\nbc  d"):
        assert np.array_equal(language.counts(text), plain_counts(text))
    assert language.counts("12 _.") is None and language.counts("") is None and language.counts(None) is None
    long = "der die das und " * 5000
    assert np.array_equal(language.counts(long, 997), language.counts(long))


def test_machine_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 30)).astype(np.float32)
    y = np.where(x @ rng.normal(size=30) > 0.3, 1.0, -1.0)
    w = language.fit_machine(x, y, 0.1)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97
    z = np.column_stack([x, np.ones(200)])
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()) * 200
    slope = 0.1 * w - ((weight * y * np.maximum(0, 1 - y * (z @ w)))[:, None] * z).sum(axis=0)
    assert np.abs(slope).max() < 1e-2  # the least of ridge/2 |w|^2 + 1/2 sum weight * hinge^2


def test_language_held_out(spark):
    """Accuracy and recall of each language over held-out documents; none of them is learnt from."""
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert language.sample(docs).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).count() == 0
    got = queries()["op11_language"](spark, d).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 300 and (got.lang == got.lang_pred).mean() > 0.98
    for lang, g in got.groupby("lang"):
        assert (g.lang == g.lang_pred).mean() > 0.95, lang
    for lang, g in got.groupby("lang_pred"):
        assert (g.lang == g.lang_pred).mean() > 0.95, lang
    assert got.score.between(0, 1).all()


def test_language_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    long = "das und die von " * 200_000
    more = [(1_000_001, None, None), (1_000_002, "", "en"), (1_000_003, "12 %% 3", None), (1_000_004, long, None), (1_000_004, long, None), (None, "la de las el que los", None), (None, None, "xx")]
    every = docs.unionByName(spark.createDataFrame(more, docs.schema)).withColumns({"score": F.lit(1), "lang_pred": F.lit("q"), "one": F.lit(2), "share": F.lit(0), "side": F.lit(0), "source": F.lit("s")})
    rows = language.languages(every).collect()
    assert len(rows) == docs.count() + len(more)
    got = {r.doc_id: r for r in rows if (r.doc_id or 0) > 1_000_000}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1_000_001, 1_000_002, 1_000_003)) and got[1_000_004].lang_pred == "de"
    assert {(r.lang_pred, r.held_out) for r in rows if r.doc_id is None} >= {("und", False)}
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 1_000_004}) == 1
    assert language.languages(docs.where("false")).count() == 0
    assert {r.lang_pred for r in language.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert {r.lang_pred for r in language.languages(docs.withColumn("lang", F.lit("de"))).collect()} == {"de"}
    other = language.languages(docs.withColumn("lang", F.when(F.col("lang") == "es", "x-es").otherwise(F.col("lang")))).collect()  # a language of no known family
    assert "x-es" in {r.lang_pred for r in other}


def test_sample_is_bounded_with_a_hot_id(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 8).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 700).alias("text"), F.lit("en").alias("lang"))
    n = language.sample(rows, 100).count()
    assert 20 <= n <= 200
