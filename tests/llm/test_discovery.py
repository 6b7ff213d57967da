"""What bootstrapping finds beyond the base patterns, on planted identifiers."""

import random

from pyspark.sql import functions as F

from lumengrid.llm import pii
from tests.llm.test_llm import brute_pii, pii_ok

RND = random.Random(12)
FILL = [f"w{c}" for c in "abcdefghijklmnop"]


def filled(*parts):
    words = lambda: " ".join(RND.choice(FILL) for _ in range(RND.randrange(2, 9)))
    return " ".join([words(), *(x for p in parts for x in (p, words()))])


def number(ok):
    while True:
        s = "4" + "".join(RND.choice("0123456789") for _ in range(15))
        if pii_ok("card", s) == ok:
            return s


def spans_of(spark, rows, **more):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return {r.doc_id: set(filter(None, r.spans.split(","))) for r in pii.personal_data(df.withColumns(more)).collect()}


def test_planted_identifiers_beyond_the_base(spark):
    good, bad = [number(True) for _ in range(40)], [number(False) for _ in range(25)]
    rows, want = [], {}
    for x in good:
        rows.append(filled(x))
    for x in bad:  # by shape
        rows.append(filled(x + RND.choice(["", ".", "!!", ",$"])))
        want[len(rows) - 1] = f"card:{rows[-1].index(x)}:{rows[-1].index(x) + 16}"
    for i in range(30):
        rows.append(filled(f"contact via ann{i}@host{i}.org"))
    for i in range(7):  # by the words before
        x = f"bob{i}(at)host"
        rows.append(filled(f"contact via {x}"))
        want[len(rows) - 1] = f"email:{rows[-1].index(x)}:{rows[-1].index(x) + len(x)}"
    clean = len(rows)
    for i in range(60):
        rows.append(filled(str(1900 + i), f"v{i}.2", f"{i}%", "a" * 80 + "1"))
    got = spans_of(spark, rows, value=F.lit(1), kind=F.lit("x"), key_a=F.lit(0))
    beyond = {i: s - set(brute_pii(rows[i]).split(",")) for i, s in got.items()}
    found = {i for i, s in beyond.items() if s}
    assert all(beyond[i] == {want[i]} for i in found & set(want))
    recall, precision = len(found & set(want)) / len(want), len(found & set(want)) / len(found)
    assert recall >= 0.9 and precision >= 0.9 and not any(got[i] for i in range(clean, len(rows)))


def test_other_kinds_count_against_a_pattern(spark):
    rows = [f"see {number(True)} now" for _ in range(8)] + [f"see u{i}@h.org now" for i in range(8)] + ["see 77x now"]
    assert spans_of(spark, rows)[16] == set()


def test_repeats_have_equal_spans_and_frequent_tokens_are_bounded(spark):
    bad = number(False)
    rows = [filled(number(True)) for _ in range(20)] + [f"q {bad} q"] * 30 + ["the 7 of 7 in 7"] * 300
    got = spans_of(spark, rows)
    assert {frozenset(got[i]) for i in range(20, 50)} == {frozenset({"card:2:18"})} and not any(got[i] for i in range(50, 350))


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a@b.co 12")], "doc_id long, text string")
    plan = pii.personal_data(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    beyond, planted = [], 0
    for r in pii.personal_data(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        base = set(filter(None, brute_pii(r.text).split(",")))
        assert base <= set(r.spans.split(","))
        beyond += [r.text[int(a) : int(e)] for a, e in (s.split(":")[1:] for s in set(filter(None, r.spans.split(","))) - base)]
    assert len(beyond) >= 8 and sum(len(x) == 16 and x.isdigit() for x in beyond) >= 0.9 * len(beyond)
