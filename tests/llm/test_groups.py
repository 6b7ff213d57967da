"""Hot groups, huge texts, and what the deduplication stages keep."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumengrid.llm import common, exact_dedup, near_dedup
from tests.llm.test_llm import brute_near


def test_meet_broadcasts_only_large_groups(spark, monkeypatch):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 700).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("k <> 5")
    want = sorted(map(tuple, rows.join(groups, "k").select("id", "k", "n", "first").collect()))
    for how, more in (("inner", 0), ("left", rows.where("k = 5").count())):
        got = common.meet(rows, groups, ["k"], "n", how)
        assert got.count() == len(want) + more and sorted(map(tuple, got.where("n is not null").select("id", "k", "n", "first").collect())) == want
    monkeypatch.setattr(common, "MANY", 10)
    some = common.saved(groups, "some")
    assert sorted(map(tuple, common.matched(rows, some, ["k"]).select("id", "k", "n", "first").collect())) == want


@pytest.mark.parametrize("huge,size", [(0, 7), (40, 16), (1000, 100)])
def test_huge_texts_hash_in_segments(spark, huge, size):
    rnd = random.Random(3)
    texts = ["", " ", *("".join(rnd.choice("ab \n") for _ in range(n)) for n in (1, 5, 39, 40, 41, 300, 999, 2500)), None]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3]), (None, texts[9]), (77, texts[9] + " ")], "doc_id long, text string")
    plain = lambda d: sorted(map(str, d.collect()))
    assert plain(exact_dedup.digests(docs, huge, size)) == plain(exact_dedup.digests(docs))
    assert plain(exact_dedup.exact_dedup(docs, huge, size)) == plain(exact_dedup.exact_dedup(docs))


def test_a_third_of_all_rows_are_copies(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same  words again and again").otherwise(F.concat(F.sha1(F.col("id").cast("string")), F.lit(" b c d"))).alias("text"))
    got = exact_dedup.exact_dedup(docs)
    assert got.where("kept").count() == 601 and got.where("group_size = 300 and keep_id = 0").count() == 300
    near = near_dedup.near_dedup(docs)
    assert near.where("kept").count() == 601 and near.where("component_id = 0").count() == 300


def test_hubs_are_dealt_out(spark):
    """2,000 near copies of one text: pairs, verification and components give no task more than its share."""
    rows = spark.range(4000).select(F.col("id").alias("id"), F.col("id").cast("string").alias("hashes"))
    rows = common.saved(rows, "rows")
    found = spark.range(1, 2000).select(F.lit(0).cast("long").alias("hub"), F.col("id").alias("other"))
    more = spark.range(2000, 4000).select(F.col("id").alias("hub"), ((F.col("id") + 1) % 4000).alias("other"))
    pairs = near_dedup.hubs(found.unionByName(more).unionByName(found.select(F.col("other").alias("hub"), F.col("hub").alias("other"))))
    assert pairs.where("hub = other").count() == 0
    got = near_dedup.with_rows(pairs, rows)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = sorted(r["count"] for r in near_dedup.with_rows(pairs, rows).groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", n)
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
    assert all(r.h.hashes == str(r.hub) and r.o.hashes == str(r.other) for r in got.collect())
    told = {tuple(sorted((r.hub, r.other))) for r in got.collect()}
    assert len(told) == got.count() and told == {(0, i) for i in range(1, 2000)} | {tuple(sorted((i, (i + 1) % 4000))) for i in range(2000, 4000)}
    star = near_dedup.components(spark.range(1, 2000).select(F.col("id").alias("a"), F.lit(5000).cast("long").alias("b")))
    assert star.count() == 2000 and star.where("component = 1").count() == 2000


def test_components_beyond_broadcasts(spark, monkeypatch):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(500, i) for i in range(600, 760)]
    par = {x: x for e in links for x in e}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        par[max(x, y)] = min(x, y)
    df = spark.createDataFrame([(min(e), max(e)) for e in links if e[0] != e[1]], "a long, b long")
    want = {x: find(x) for e in links if e[0] != e[1] for x in e}
    assert {r.id: r.component for r in near_dedup.components(df).collect()} == want
    monkeypatch.setattr(common, "MANY", 20)
    assert {r.id: r.component for r in near_dedup.components(df).collect()} == want


def test_candidates_across_components_stay_few(spark):
    """Families just below the threshold share most shingles, but rare ones come first: few pairs are listed."""
    rnd = random.Random(8)
    rows, part = [], 0
    for _ in range(3):
        base = [rnd.randrange(1 << 62) for _ in range(400)]
        for _ in range(150):
            own = set(base)
            for x in rnd.sample(base, 36):
                own.discard(x)
                own.add(rnd.randrange(1 << 62))
            part += 1
            rows.append((part, len(own), part, b"".join(sorted(x.to_bytes(8, "little") for x in own))))
    rest = spark.createDataFrame(rows, "doc_id long, n long, part long, hashes binary")
    assert near_dedup.across(rest).count() <= len(rows)


CASES = [(1, "a b c d e"), (1, "a b c d e"), (2, "a  b c d e"), (None, None), (None, None), (3, ""), (4, None), (None, "f g h i j"), (5, "f g h i j k"), (5, "quite another text"), (6, "x" * 200_000)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_nulls_repeats_and_clashing_columns(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [(i, t, f"own{k}", 1, "h", 0.5, 3, 4) for k, (i, t) in enumerate(CASES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own string, hits int, drop_id string, toxicity double, key int, own_text_sha256 int")
    folder = "/root/testdata/sf0.001"
    for input_ in (docs, docs.where("false")):
        out = stage(spark, input_, folder)
        got = out.collect()
        if name == "bpe":
            assert len(got) == input_.count() and out.columns[0] == "doc_id"
            continue
        assert out.columns == docs.columns and {tuple(r) for r in got} <= set(rows)
        kept = {r.text or "" for r in got}
        if input_ is docs and name == "exact_dedup":
            assert {" ".join(t.split()) for t in kept} == {" ".join((t or "").split()) for _, t in CASES}
        elif input_ is docs and name in ("toxicity", "decontamination"):
            assert len(got) == len(rows)
        elif input_ is docs:
            parts = brute_near(list(enumerate(t for _, t in CASES)))
            have = {parts[k][1] for k, (_, t) in enumerate(CASES) if (t or "") in kept}
            assert {parts[k][1] for k in parts} <= have | {k for k, (_, t) in enumerate(CASES) if not t}


def test_tables_are_deleted(spark):
    import os

    since = common.made()
    df = common.saved(spark.range(3), "one")
    path = df.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(path)
    common.drop(df)
    assert not os.path.isdir(path) and common.made() == since
    uri = common.put(spark, "two.bin", b"x")
    assert os.path.isfile(uri.removeprefix("file://"))
    common.clear(spark, since)
    assert not os.path.isfile(uri.removeprefix("file://")) and common.made() == since


def test_sha_of_groups_is_that_of_normalised_texts(spark):
    got = exact_dedup.exact_dedup(spark.createDataFrame([(1, "a\t\tb"), (2, "a b")], "doc_id long, text string")).collect()
    assert {r.text_sha256 for r in got} == {hashlib.sha256(b"a b").hexdigest()}
