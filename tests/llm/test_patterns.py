"""Decontamination: memory of the patterns, sets, clashing columns and repeats, against brute force."""

import random

from pyspark.sql import functions as F

from lumengrid.llm import decontaminate
from tests.llm.test_llm import brute_contamination


def items_of(n, words, seed=3):
    rnd = random.Random(seed)
    return [(f"i{k}", " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(1, 9))) for _ in range(words))) for k in range(n)]


def test_packed_size_is_bounded():
    items = [(i, t.encode()) for i, t in items_of(400, 60)]
    estimate = sum(decontaminate._PER_BYTE * len(t) + decontaminate._PER_WORD * len(t.split()) for _, t in items)
    packed = decontaminate.Matcher.pack(items)
    assert len(packed) <= estimate < 40 * sum(len(t) for _, t in items)
    short = [(i, b"a b c d e f g h i j k l m n o p " * 3) for i, _ in items]
    assert len(decontaminate.Matcher.pack(short)) <= sum(decontaminate._PER_BYTE * len(t) + decontaminate._PER_WORD * len(t.split()) for _, t in short)


def test_a_set_at_a_time(spark):
    bench = spark.createDataFrame(items_of(60, 40), "item_id string, text string")
    sizes = [len(p) for p in decontaminate.pattern_sets(bench, 40_000)]
    assert len(sizes) > 5 and max(sizes) <= 40_000


def test_matcher_against_brute_force():
    rnd = random.Random(9)
    words = ["a", "bb", "Cc", "d1", "é", "the", "of"]
    for _ in range(40):
        items = [(f"i{k}", " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 5, 13, 14, 25])))) for k in range(6)]
        text = rnd.choice(["", "; "]).join(" ".join(rnd.choice(words) for _ in range(30)) + " " + rnd.choice(items)[1] + " " for _ in range(4))
        n, ranges, found = decontaminate.Matcher(decontaminate.Matcher.pack([(i, t.encode()) for i, t in items])).scan(text.encode())
        want = brute_contamination(text, items)
        assert (n, sum(b - a for a, b in ranges), len(found)) == want[:3]


def test_sets_clashing_columns_repeats_and_long_texts(spark):
    items = items_of(30, 20)
    rnd = random.Random(4)
    texts = [None, "", items[3][1], items[3][1], "pre " + items[4][1] + " " + items[29][1] + " post", "none of it " * 10, " ".join(rnd.choice(items)[1] for _ in range(3000)), "x" * 300_000]
    rows = [(i, t, i, "h", 1, "m", 2, "k") for i, t in enumerate(texts)] + [(2, items[3][1], 2, "h", 1, "m", 2, "k"), (None, items[5][1], None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits long, _hits string, n int, more string, n_words int, key string")
    bench = spark.createDataFrame(items, "item_id string, text string").withColumn("hits", F.lit(1))
    for most in (1, 20_000, decontaminate.MAX_PATTERN_BYTES):
        found = decontaminate.hits(docs, bench, "found", most)
        assert found.columns == [*docs.columns, "found"]
        got = sorted(((r.doc_id is None, r.doc_id or 0, r.found["n_words"], sorted(r.found["items"])) for r in found.collect()), key=str)
        one = {t: sorted(i for i, x in items if brute_contamination(t, [(i, x)])[1]) for t in set(texts[:6]) | {items[5][1]}}
        for none, doc, n, names in got:
            t = items[5][1] if none else texts[doc]
            if t in one:
                assert names == one[t]
        assert len(got) == len(rows)
    whole = {(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()}
    assert whole == {(r[0], *brute_contamination(r[1], items)[:2], brute_contamination(r[1], items)[4]) for r in rows}
