"""Near-duplicate detection with HyperMinHash.

A document's set holds its distinct 3-word shingles as 64-bit hashes. Its sketch has REGISTERS buckets; a bucket keeps
of its smallest hash only the number of leading zeros and ten mantissa bits, and an empty bucket borrows from another
one in an order of its own. Bands of five registers are hashed to keys. Documents with equal sets are one class;
class representatives that share a key are candidates. Instead of all pairs of a bucket, each member meets the bucket's
smallest and largest id; the Jaccard estimate from the registers, corrected for registers that agree by accident, drops
what is far below the threshold, and the rest is confirmed on the full sets. Connected components follow. The documents
of buckets that still hold several components then go through an exact prefix join, which finds whatever links
components without listing the pairs of a bucket. A pair at the threshold misses all 26 bands with a probability of 4e-7.

Large classes, buckets and components are few, so their rows are broadcast; the pairs of a hub that meets many are dealt
out, with copies of its sketch and set. No task receives a large group.

Defined cases: texts without words, and null texts, have an empty set, link with nothing and stay; fewer than three
words are one shingle; a row with a null doc_id is grouped by its set but is never the row that stays unless the class
has no id; repeated rows of an id share its class; a very long text is hashed piece by piece, and its set is held by one
task at a time; an empty table gives an empty result; only doc_id and text are read, so other columns can't clash, and a
stage passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LARGE, MANY, as_bytes, drop, free, kept_rows, many_word_hashes, matched, meet, mix64, saved, steps, table

REGISTERS, ROWS = 130, 5
BANDS = REGISTERS // ROWS
MANTISSA = 10
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Standard deviations by which an estimate may fall short before a pair is dropped unseen.
MARGIN = 6.0
SHINGLE = 3
#: Hash cells by whose counts shingles are ordered in the exact search.
ORDER_CELLS = 1 << 20

_U = np.uint64
_ORDER = np.array([np.argsort(mix64(np.arange(REGISTERS, dtype=_U) + _U(1000 * (j + 1)))) for j in range(REGISTERS)])


def shingles(words: np.ndarray) -> np.ndarray:
    """The distinct shingles of a text, sorted, from its word hashes."""
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        h = np.array([n], dtype=_U)
        for i in range(n):
            h = mix64(h * _U(31) + words[i : i + 1])
        return h
    return np.unique(mix64(words[:-2] * _U(0x9E3779B97F4A7C15) + mix64(words[1:-1] + _U(7)) * _U(0xC2B2AE3D27D4EB4F) + words[2:]))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The compressed registers of a non-empty sorted set, none left empty."""
    bucket = ((hashes >> _U(32)) * _U(REGISTERS)) >> _U(32)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    least = np.minimum.reduceat(hashes & _U(0xFFFFFFFF), first)
    part, power = np.frexp(least.astype(np.float64))
    value = ((32 - power) << MANTISSA) + np.where(least > 0, (part * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    full = bucket[first].astype(np.int64)
    if len(full) == REGISTERS:
        return value.astype(np.uint16)
    out, there = np.zeros(REGISTERS, dtype=np.int64), np.zeros(REGISTERS, dtype=bool)
    out[full], there[full] = value, True
    empty = np.flatnonzero(~there)
    probe = _ORDER[empty]
    out[empty] = out[probe[np.arange(len(empty)), there[probe].argmax(axis=1)]]
    return out.astype(np.uint16)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch."""
    regs = sketches.reshape(-1, BANDS, ROWS).astype(_U)
    key = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=_U)), regs.shape[:2])
    for r in range(ROWS):
        key = mix64(key ^ (regs[:, :, r] + _U(0x9E3779B9)))
    return key


def accidental(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The chance that a register of two disjoint sets agrees: over the leading-zero counts, the mantissa cells that both minima fall into."""
    a, b = np.maximum(1.0, n_a / REGISTERS)[:, None], np.maximum(1.0, n_b / REGISTERS)[:, None]
    zeros = np.arange(32)[None, :]
    low = 0.5 ** (zeros + 1)
    cell = low / (1 << MANTISSA)
    return np.minimum(0.5, ((1 << MANTISSA) * a * cell * b * cell * np.exp(-(a + b) * 1.5 * low)).sum(axis=1))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard from registers, without the accidental agreements."""
    share = (a == b).mean(axis=1)
    chance = accidental(n_a, n_b)
    return np.clip((share - chance) / (1 - chance), 0, 1)


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    for start, end in steps(texts):
        for words in many_word_hashes([t.lower() for t in texts[start:end]]):
            yield shingles(words)


_MARK = "doc_id long, n_shingles long, fp_a long, fp_b long, sketch binary, keys array<long>"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, fa, fb, sk = [], [], [], []
        for s in _sets(as_bytes(batch.column(1))):
            n.append(len(s))
            fa.append(int(mix64(s + _U(1)).sum().astype(np.int64)) if len(s) else 0)
            fb.append(int(mix64(s ^ _U(0x5851F42D4C957F2D)).sum().astype(np.int64)) if len(s) else 0)
            sk.append(sketch(s) if len(s) else None)
        keys = iter(band_keys(np.stack(own)).astype(np.int64) if (own := [x for x in sk if x is not None]) else [])
        lists = [None if x is None else next(keys) for x in sk]
        arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(fa, pa.int64()), pa.array(fb, pa.int64()), pa.array([None if x is None else x.tobytes() for x in sk], pa.binary()), pa.array(lists, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "fp_a", "fp_b", "sketch", "keys"])


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in _sets(as_bytes(batch.column(1)))], pa.binary())], ["doc_id", "hashes"])


def _near(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for a, b, n_a, n_b in columns:
        if not len(a):
            yield pa.array([], pa.bool_())
            continue
        x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in (a, b))
        least = PERCENT / 100 - MARGIN * (PERCENT / 100 * (1 - PERCENT / 100) / REGISTERS) ** 0.5
        yield pa.array(estimate(x, y, n_a.to_numpy(), n_b.to_numpy()) >= least)


def _linked(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for a, b in columns:
        out = []
        for x, y in zip(a, b):
            x, y = (np.frombuffer(v.as_buffer(), dtype=_U) for v in (x, y))
            both = np.concatenate((x, y))
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            out.append(100 * shared >= PERCENT * (len(both) - shared))
        yield pa.array(out, pa.bool_())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ids in links (a, b): labels fall to the smallest neighbour's label, then jump to their label's label, until nothing changes."""
    edges = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    now = saved(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    while True:
        # a hub has many edges, and a label many ids: neither join gives them to one task
        near = matched(edges, now.select(F.col("id").alias("b"), F.col("component").alias("_c")), ["b"]).groupBy("a").agg(F.min("_c").alias("m"))
        low = now.join(near, now.id == near.a).select("id", F.least("component", "m").alias("low"), "component")
        far = now.select(F.col("id").alias("low"), F.col("component").alias("to"))
        new = matched(low, far, ["low"], "left").select("id", F.least("low", F.coalesce("to", "low")).alias("component"), F.col("component").alias("before"))
        new = saved(new, "labels")
        if new.where("component <> before").isEmpty():
            return new.select("id", "component")
        drop(now)
        now = new.select("id", "component")


def hubs(pairs: DataFrame) -> DataFrame:
    """Pairs (hub, other), each once whichever way round it occurs. An id is `other` in as many pairs as it has buckets, twice, at most; hubs may have any number."""
    both = pairs.select(F.least("hub", "other").alias("a"), F.greatest("hub", "other").alias("b"), "hub").where("a < b").groupBy("a", "b").agg(F.min("hub").alias("hub"))
    return both.select("hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("other"))


def with_rows(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (hub, other) with the columns of `rows` (id, ...; written) of both, as struct columns h and o. A hub with many pairs is dealt out: its pairs get one of several numbers, and its row a copy for each. There are at most MANY copies besides the first ones, and no pair's row carries a hub's set through a shuffle."""
    pairs = saved(pairs, "pairs")
    names = [c for c in rows.columns if c != "id"]
    amount = saved(pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n")), "hubs")
    quota = max(LARGE, -(-(amount.agg(F.sum("n")).first()[0] or 0) // MANY))
    shares = F.expr(f"(n + {quota - 1}) div {quota}")
    dealt = meet(pairs, amount, ["hub"], "n").select("hub", "other", F.pmod(F.xxhash64("other"), shares).alias("share"))
    copies = rows.join(amount, F.col("id") == F.col("hub")).select("hub", F.struct(*names).alias("h"), F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("share"))
    others = rows.select(F.col("id").alias("other"), F.struct(*names).alias("o"))
    return dealt.join(others, "other").join(copies, ["hub", "share"]).select("hub", "other", "h", "o")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (hub, other) whose full sets are near enough, as (a, b)."""
    linked = F.arrow_udf(_linked, "boolean")
    whole = with_rows(pairs, sets.withColumnRenamed("doc_id", "id"))
    return saved(whole.where(linked("h.hashes", "o.hashes")).select(F.least("hub", "other").alias("a"), F.greatest("hub", "other").alias("b")), "links")


def across(rest: DataFrame) -> DataFrame:
    """Pairs (a, b) of different parts among rest (doc_id, n, part, hashes) that may be near: an exact prefix join.

    Under any common order of shingles, near sets share one among their first (1 - t) n + 1, and the places at which
    they share it bound their overlap. The order puts rare shingles first, by counts of ORDER_CELLS hash cells; the
    table of cells has a fixed size, so tasks can hold it, and a coarse count costs time but never a pair.
    """
    spark = rest.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ORDER_CELLS, dtype=np.int64)
        for batch in batches:
            for h in batch.column(0):
                np.add.at(total, (np.frombuffer(h.as_buffer(), dtype=_U) % _U(ORDER_CELLS)).astype(np.int64), 1)
        cell = np.flatnonzero(total)
        for i in range(0, len(cell), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(cell[i : i + 100_000]), pa.array(total[cell[i : i + 100_000]])], ["cell", "n"])

    counted = rest.select("hashes").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").toPandas()
    table_ = np.ones(ORDER_CELLS, dtype=np.int64)
    table_[counted["cell"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)
    held = spark.sparkContext.broadcast(table_)

    def first(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        order = held.value
        for column in columns:
            out = []
            for h in column:
                s = np.frombuffer(h.as_buffer(), dtype=_U)
                most = len(s) - -(-PERCENT * len(s) // 100) + 1
                out.append(s[np.lexsort((s, order[(s % _U(ORDER_CELLS)).astype(np.int64)]))[:most]].astype(np.int64))
            yield pa.array(out, pa.list_(pa.int64()))

    rows = saved(rest.select("doc_id", "n", "part", F.posexplode(F.arrow_udf(first, "array<long>")("hashes")).alias("place", "shingle")), "prefixes")
    several = rows.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("shingle")
    rows = rows.join(several, "shingle", "left_semi")
    x, y = (rows.select("shingle", F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("part").alias(f"p_{c}"), F.col("place").alias(f"i_{c}")) for c in "ab")
    near = f"a < b and p_a <> p_b and {100 + PERCENT} * least(n_a - i_a, n_b - i_b) >= {PERCENT} * (n_a + n_b)"
    return saved(x.join(y, (x.shingle == y.shingle) & F.expr(near)).select("a", "b").distinct(), "across")


def decided(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, the fingerprint of its set (fp_a, fp_b, n_shingles), component_id, kept."""
    marks = saved(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_mark, _MARK), "sketches")
    same = ["fp_a", "fp_b", "n_shingles"]
    words = marks.where("n_shingles > 0").select("doc_id", *same)
    classes = words.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("m"))
    members = meet(words, classes.where("m > 1"), same, "m", "left").select("doc_id", *same, F.coalesce("rep", "doc_id").alias("rep"))
    members = saved(members.unionByName(marks.where("n_shingles = 0").select("doc_id", *same, F.lit(None).cast("long").alias("rep"))), "members")
    own = classes.where("rep is not null").select(F.col("rep").alias("doc_id"), *same)
    reps = saved(marks.join(own, ["doc_id", *same], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", "sketch", "keys"), "reps")

    # each member of a bucket meets the bucket's smallest and largest id
    rows = reps.select("doc_id", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = saved(meet(rows, buckets, ["key"], "m"), "shared")
    pairs = hubs(shared.select(F.col("low").alias("hub"), F.col("doc_id").alias("other")).unionByName(shared.select(F.col("high").alias("hub"), F.col("doc_id").alias("other"))))
    near = F.arrow_udf(_near, "boolean")
    met = with_rows(pairs, reps.select(F.col("doc_id").alias("id"), "n_shingles", "sketch"))
    fit = F.expr(f"100 * least(h.n_shingles, o.n_shingles) >= {PERCENT} * greatest(h.n_shingles, o.n_shingles)")
    likely = saved(met.where(fit).where(near("h.sketch", "o.sketch", "h.n_shingles", "o.n_shingles")).select("hub", "other"), "likely")

    # the full sets of all that may still be compared: in a bucket of two or three, every pair has met
    large = shared.where("m > 3")
    need = likely.select(F.col("hub").alias("id")).unionByName(likely.select(F.col("other").alias("id"))).unionByName(large.select(F.col("doc_id").alias("id"))).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(need.hint("shuffle_hash"), F.col("doc_id") == F.col("id"), "left_semi")
    sets = saved(texts.mapInArrow(_full, "doc_id long, hashes binary").dropDuplicates(["doc_id"]), "sets")
    links = _verified(likely, sets)
    labels = components(links)

    # documents of larger buckets that still hold several components: whatever links these is found exactly
    marked = large.select("key", "doc_id", "n").join(labels, F.col("doc_id") == F.col("id"), "left").select("key", "doc_id", "n", F.coalesce("component", "doc_id").alias("part"))
    mixed = marked.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("key")
    rest = marked.join(mixed, "key", "left_semi").select("doc_id", "n", "part").distinct()
    rest = saved(rest.join(sets, "doc_id"), "rest")
    if not rest.isEmpty():
        more = _verified(across(rest).select(F.col("a").alias("hub"), F.col("b").alias("other")), sets)
        if not more.isEmpty():
            labels = components(links.unionByName(more))

    comp = F.coalesce("component", "rep", "doc_id")
    linked = matched(members.where("rep is not null"), labels.select(F.col("id").alias("rep"), "component"), ["rep"], "left")
    alone = members.where("rep is null").withColumn("component", F.lit(None).cast("long"))
    return linked.unionByName(alone).select("doc_id", *same, comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    return decided(docs).select("doc_id", "n_shingles", "component_id", "kept")


def _marked(docs: DataFrame, names: list[str]) -> DataFrame:
    @F.arrow_udf("struct<fp_a:long,fp_b:long,n_shingles:long>")
    def mark(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            batch = pa.RecordBatch.from_arrays([pa.nulls(len(column), pa.int64()), column], ["doc_id", "text"])
            for out in _mark(iter([batch])):
                yield pa.StructArray.from_arrays([out.column(n) for n in ("fp_a", "fp_b", "n_shingles")], ["fp_a", "fp_b", "n_shingles"])

    held = free(docs, "own")
    docs = docs.withColumn(held, mark("text"))
    return docs.withColumns({n: F.col(held)[k] for n, k in zip(names, ("fp_a", "fp_b", "n_shingles"))})


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that near_dedup() keeps; all columns."""
    return kept_rows(docs, decided(docs), ["fp_a", "fp_b", "n_shingles"], _marked)


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE unnest(list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS g FROM d WHERE len(w) > 2
           UNION SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
     l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)),
     e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
     r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
     c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""
