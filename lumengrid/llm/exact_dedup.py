"""Exact deduplication by composable polynomial fingerprints.

A text is normalised (each run of \\x20 and \\x09-\\x0D becomes one space) and cut into chunks. Each chunk's
fingerprint is the value of its bytes as a polynomial at four bases modulo the prime 2^31 - 1; the fingerprints of two
neighbours combine by length-shifted arithmetic, fp(A + B) = fp(A) * base^len(B) + fp(B). A text of more than HUGE bytes
is dealt out in segments, which hash in parallel on different machines and are combined by sums. Equal fingerprints are
not trusted: the texts of such a group are compared chunk by chunk while streaming through a sorted partition; a group
in which any comparison fails is split by the SHA-256 of the whole text.

Large groups are few, so their fingerprints are broadcast; no task receives a group of copies.

Defined cases: a null text counts as empty; empty texts are equal to each other; a row with a null doc_id takes part
with its text, never as the row that stays unless all ids of its group are null; repeated rows of one id share the
decision; very long texts go in segments, but for their SHA-256, which is one task's stream; an empty table gives an
empty result; only doc_id and text are read, so other columns can't clash, and a stage passes them on.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, kept_rows, meet, saved, table

PRIME = (1 << 31) - 1
#: Bases of the four polynomials: fixed values, any four numbers below the prime do.
BASES = (1_103_515_245, 214_748_349, 69_069_069, 1_812_433_253)
CHUNK = 4096
#: Longer normalised texts are hashed in segments of SEGMENT bytes.
HUGE, SEGMENT = 16 << 20, 1 << 20
_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_WEIGHT = np.array([[pow(b, CHUNK - 1 - i, PRIME) for b in BASES] for i in range(CHUNK)], dtype=np.float64)
_SHIFT = [pow(b, CHUNK, PRIME) for b in BASES]


def normalise(text: bytes) -> bytes:
    text = text.translate(_SPACE)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def fingerprint(data: bytes) -> tuple[int, int, int, int]:
    """The values of the four polynomials; bytes count from 1 so that leading zero bytes matter. Sums stay below 2^53, so float64 is exact."""
    total = [0, 0, 0, 0]
    head = len(data) % CHUNK
    if head:
        part = (np.frombuffer(data, dtype=np.uint8, count=head).astype(np.float64) + 1) @ _WEIGHT[-head:]
        total = [int(x) % PRIME for x in part]
    rest = np.frombuffer(data, dtype=np.uint8, offset=head).reshape(-1, CHUNK)
    for at in range(0, len(rest), 256):
        for row in (rest[at : at + 256].astype(np.float64) + 1) @ _WEIGHT:
            total = [(t * s + int(x)) % PRIME for t, s, x in zip(total, _SHIFT, row)]
    return tuple(total)


def combine(left: tuple, right: tuple, right_bytes: int) -> tuple:
    """The fingerprint of two neighbouring pieces from those of the pieces."""
    return tuple((x * pow(b, right_bytes, PRIME) + y) % PRIME for x, y, b in zip(left, right, BASES))


def _packed(fp: tuple) -> tuple[int, int]:
    return fp[0] << 31 | fp[1], fp[2] << 31 | fp[3]


_DIGEST = "doc_id long, fp_a long, fp_b long, n_bytes long, text_sha256 string"
_PIECES = f"{_DIGEST}, huge string, segment_no long, segment binary"
_PIECES_TYPE = pa.schema([("doc_id", pa.int64()), ("fp_a", pa.int64()), ("fp_b", pa.int64()), ("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("huge", pa.string()), ("segment_no", pa.int64()), ("segment", pa.binary())])


def _digests(batches: Iterator[pa.RecordBatch], huge: int, size: int) -> Iterator[pa.RecordBatch]:
    """A row for each text with its fingerprint; for a huge one a row for each segment, without a fingerprint."""
    for batch in batches:
        out = []
        for doc, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            text = normalise(text)
            sha = hashlib.sha256(text).hexdigest()
            if len(text) <= huge:
                out.append((doc, *_packed(fingerprint(text)), len(text), sha, None, None, None))
                continue
            name = uuid.uuid4().hex
            for no, at in enumerate(range(0, len(text), size)):
                row = (doc, None, None, len(text), sha, name, no, text[at : at + size])
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _PIECES_TYPE.types)], schema=_PIECES_TYPE)
        cols = list(zip(*out)) if out else [[]] * len(_PIECES_TYPE)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PIECES_TYPE.types)], schema=_PIECES_TYPE)


def digests(docs: DataFrame, huge: int = HUGE, size: int = SEGMENT) -> DataFrame:
    """Fingerprint, length and SHA-256 of every normalised text, written."""
    run = lambda batches: _digests(batches, huge, size)
    raw = saved(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES), "digests")
    names = [x.split()[0] for x in _DIGEST.split(", ")]
    whole, parts = raw.where("huge is null").select(*names), raw.where("huge is not null")
    if parts.isEmpty():
        return whole
    dealt = parts.select("huge", "segment_no", F.col("segment").alias("text")).repartition("huge", "segment_no")
    own = parts.where("segment_no = 0").select("doc_id", "text_sha256", "huge").join(fingerprint_segments(dealt, "huge"), "huge")
    return saved(whole.unionByName(own.select(*names)), "digests")


def fingerprint_segments(segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, fp_a, fp_b, n_bytes) of texts stored as rows (key, segment_no, text) that are already normalised: each segment hashes where it lies, and only fingerprints and lengths travel."""
    kind = segments.schema[key].dataType.simpleString()

    def hashed(batches):
        for batch in batches:
            texts = as_bytes(batch.column(2))
            hashes = [fingerprint(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, texts), pa.int64()), *(pa.array([h[i] for h in hashes], pa.int64()) for i in range(4))], [key, "segment_no", "n", "h0", "h1", "h2", "h3"])

    def shifted(batches):
        for batch in batches:
            after = batch.column(batch.schema.get_field_index("after")).to_pylist()
            for i, b in enumerate(BASES):
                at = batch.schema.get_field_index(f"h{i}")
                batch = batch.set_column(at, f"h{i}", pa.array([h * pow(b, n, PRIME) % PRIME for h, n in zip(batch.column(at).to_pylist(), after)], pa.int64()))
            yield batch

    parts = segments.select(key, F.col("segment_no").cast("long"), "text").mapInArrow(hashed, f"{key} {kind}, segment_no long, n long, h0 long, h1 long, h2 long, h3 long")
    after = Window.partitionBy(key).orderBy(F.desc("segment_no")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("after", F.coalesce(F.sum("n").over(after), F.lit(0)))
    done = parts.mapInArrow(shifted, parts.schema).groupBy(key).agg(F.sum("n").alias("n_bytes"), *[(F.sum(f"h{i}") % PRIME).alias(f"h{i}") for i in range(4)])
    return done.select(key, F.expr("shiftleft(h0, 31) | h1").alias("fp_a"), F.expr("shiftleft(h2, 31) | h3").alias("fp_b"), "n_bytes")


_COMPARED = "doc_id long, fp_a long, fp_b long, n_bytes long, differs boolean, text string"


def _same(a: bytes, b: bytes, step: int = 1 << 16) -> bool:
    return len(a) == len(b) and all(a[i : i + step] == b[i : i + step] for i in range(0, len(a), step))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by group: holds one text, the group's first, and compares each later one with it. Passes on that first row of a group that other partitions hold too, and rows that differ."""
    key, first = None, b""
    for batch in batches:
        ids, a, b, n, salt, salts = (batch.column(i).to_pylist() for i in range(6))
        out = []
        for i, text in enumerate(as_bytes(batch.column(6))):
            text = normalise(text)
            if key != (a[i], b[i], n[i], salt[i]):
                key, first = (a[i], b[i], n[i], salt[i]), text
                if salts[i] > 1:
                    out.append((ids[i], a[i], b[i], n[i], False, text.decode()))
            elif not _same(first, text):
                out.append((ids[i], a[i], b[i], n[i], True, None))
        cols = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()))], ["doc_id", "fp_a", "fp_b", "n_bytes", "differs", "text"])


def _streamed(rows: DataFrame) -> DataFrame:
    keys = ["fp_a", "fp_b", "n_bytes", "salt"]
    return rows.select("doc_id", *keys, "salts", "text").repartition(*keys).sortWithinPartitions(*keys, "doc_id").mapInArrow(_compare, _COMPARED)


def collisions(docs: DataFrame, marks: DataFrame, groups: DataFrame) -> DataFrame:
    """The fingerprints (fp_a, fp_b, n_bytes) whose texts are not all the same; empty unless a fingerprint collides.

    A group of n rows is spread over sqrt(n) salts; the firsts of the salts are compared in a second round.
    """
    keys = ["fp_a", "fp_b", "n_bytes"]
    salts = F.ceil(F.sqrt(F.col("group_size") / 64.0)).cast("long")
    members = meet(marks, groups, keys, "group_size").select("doc_id", *keys, F.greatest(salts, F.lit(1)).alias("salts")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")))
    members = members.where("doc_id is not null").dropDuplicates(["doc_id", *keys])
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    once = saved(_streamed(texts.join(members.hint("shuffle_hash"), "doc_id")), "compared")
    again = _streamed(once.where("not differs").withColumns({"salt": F.lit(0).cast("long"), "salts": F.lit(1).cast("long")}))
    return once.where("differs").select(*keys).unionByName(again.where("differs").select(*keys)).distinct()


def exact_dedup(docs: DataFrame, huge: int = HUGE, size: int = SEGMENT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, fp_a, fp_b."""
    marks = digests(docs, huge, size)
    keys = ["fp_a", "fp_b", "n_bytes"]
    total = [F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    groups = saved(marks.groupBy(*keys).agg(*total).where("group_size > 1"), "copies")
    bad = saved(collisions(docs, marks, groups), "collisions")
    if not bad.isEmpty():  # the whole text's digest parts what the fingerprint does not
        marks = marks.join(bad.withColumn("part", F.lit(True)), keys, "left").withColumn("part", F.when(F.col("part"), F.col("text_sha256")).otherwise(""))
        marks, keys = saved(marks, "digests"), [*keys, "part"]
        groups = marks.groupBy(*keys).agg(*total).where("group_size > 1")
    first = F.coalesce("keep_id", "doc_id")
    joined = meet(marks, groups, keys, "group_size", "left")
    return joined.select("doc_id", first.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("doc_id").eqNullSafe(first).alias("kept"), "text_sha256", "fp_a", "fp_b")


def _marked(docs: DataFrame, names: list[str]) -> DataFrame:
    return docs.withColumn(names[0], F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), 256))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that exact_dedup() keeps; all columns."""
    return kept_rows(docs, exact_dedup(docs), ["text_sha256"], _marked)


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("fp_a", "fp_b")


SQL = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON n.t = g.t
"""
