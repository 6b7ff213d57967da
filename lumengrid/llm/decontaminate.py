"""Benchmark decontamination by Wu-Manber multi-pattern search.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became lower case. Each window of 13 consecutive words of a
benchmark item (an item of fewer words, but not none, is one window) is a pattern: its words between single spaces.
A document's text, brought to the same form, is scanned from left to right: a table indexed by the last block of the
scanned frame says how far the frame may move without missing a pattern; where it says 0, a bucket chosen by that block
lists the patterns to compare directly. Patterns are split by length class, since the shortest one bounds every shift.

A set of patterns is one packed file: the items' texts one after the other, of which each pattern is a stretch, and
integer tables (shifts, buckets by a hash of the suffix block, owners). It is written to the shared folder, fetched once
by each executor and mapped by all its Python workers, so a host holds it once. A set takes at most MAX_PATTERN_BYTES,
by the size of that file; a larger benchmark is cut into sets, which are built and scanned for one after the other, and
the hits, kept by the text's digest, are merged as word ranges.

Defined cases: null or wordless texts have no words and aren't contaminated; wordless items have no window; items
without an id hit like others, count together as one item and aren't listed; rows repeat as they come and get equal
results; a very long text is scanned whole, one at a time; an empty benchmark contaminates nothing; only the named
columns are read, so others can't clash, and a stage passes all of them on.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import struct
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, free, local_copy, matched, put, saved, table

WINDOW = 13
#: Bytes of the packed file of a set of patterns.
MAX_PATTERN_BYTES = 512 << 20
_FORM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain(text: bytes) -> bytes:
    """The words in lower case, a space before, between and after them."""
    return b" " + b" ".join(text.translate(_FORM).split()) + b" "


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    words = text.translate(_FORM).split()
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))] if words else []


def _bits(n: int) -> int:
    """Bits of a hash table for n entries that is at most a quarter full."""
    return max(8, min(26, (4 * max(1, n) - 1).bit_length()))


class WuManber:
    """Finds all occurrences of many byte strings, overlapping ones included. Patterns are (start, length) stretches of `blob`; the tables are arrays, or parts of a mapped file."""

    def __init__(self, blob, start, length, shift, head, follow, least: int, block: int):
        self.blob, self.start, self.length = blob, start, length
        self.shift, self.head, self.follow, self.least, self.block = shift, head, follow, least, block

    @classmethod
    def build(cls, blob: bytes, start: array, length: array) -> WuManber:
        """From stretches in rising order of their starts, each text once. A block's shift comes from the earliest stretch that reaches it, so each place of the blob is hashed once."""
        least = min(length)
        block = min(least, max(2, min(12, least // 3)))
        far = least - block + 1
        shift = bytearray([min(255, far)]) * (1 << _bits(min(len(blob), len(start) * far)))
        head, follow = array("i", [-1]) * (1 << _bits(len(start))), array("i", [-1]) * len(start)
        mask, top, done = len(shift) - 1, len(head) - 1, 0
        for i, s in enumerate(start):
            for end in range(max(s + block, done + 1), s + least + 1):
                at = crc32(blob[end - block : end]) & mask
                if s + least - end < shift[at]:
                    shift[at] = s + least - end
            done = s + least
            at = crc32(blob[done - block : done]) & top
            follow[i], head[at] = head[at], i
        return cls(blob, start, length, shift, head, follow, least, block)

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(place, number of the pattern)."""
        shift, block, least, at, n = self.shift, self.block, self.least, self.least, len(text)
        mask, top, head, follow, start, length, blob = len(shift) - 1, len(self.head) - 1, self.head, self.follow, self.start, self.length, self.blob
        while at <= n:
            h = crc32(text[at - block : at])
            step = shift[h & mask]
            if step:
                at += step
                continue
            begin, i = at - least, head[h & top]
            while i >= 0:
                if text[begin : begin + length[i]] == blob[start[i] : start[i] + length[i]]:
                    yield begin, i
                i = follow[i]
            at += 1


class Matcher:
    """Windows of all items, by length class, with their owners; packed into one buffer that can be mapped."""

    def __init__(self, buffer: bytes):
        data = memoryview(buffer)
        (n,) = struct.unpack_from("<q", data)
        sizes = struct.unpack_from(f"<{n}q", data, 8)
        parts, at = [], 8 + 8 * n
        for size in sizes:
            parts.append(data[at : at + size])
            at += size + -size % 8
        self.names = json.loads(bytes(parts[0]))
        blob = parts[1]
        self.searches = []
        for k in range(2, len(parts), 8):
            least, block = struct.unpack("<qq", parts[k])
            ints = [p.cast("i") for p in (*parts[k + 1 : k + 3], *parts[k + 4 : k + 8])]
            self.searches.append((WuManber(blob, ints[0], ints[1], parts[k + 3], ints[2], ints[3], least, block), ints[4], ints[5]))

    @staticmethod
    def pack(items: list[tuple[str | None, bytes]]) -> bytes:
        blob = bytearray()
        classes: dict[int, tuple[dict[bytes, int], array, array, array, array]] = {}
        for no, (_, text) in enumerate(items):
            whole = plain(text)
            if len(whole) < 3:
                continue
            base, gaps = len(blob), [i for i, c in enumerate(whole) if c == 32]
            blob += whole
            for i in range(max(1, len(gaps) - WINDOW)):
                a, b = gaps[i], gaps[min(len(gaps) - 1, i + WINDOW)] + 1
                number, start, length, which, owner = classes.setdefault(min(3, (b - a).bit_length() // 2), ({}, *(array("i") for _ in range(4))))
                k = number.setdefault(hashlib.blake2b(whole[a:b], digest_size=16).digest(), len(start))
                if k == len(start):
                    start.append(base + a), length.append(b - a)
                which.append(k), owner.append(no)
        fixed = bytes(blob)
        parts = [json.dumps([i for i, _ in items]).encode(), fixed]
        for _, start, length, which, owner in classes.values():
            w = WuManber.build(fixed, start, length)
            order = np.lexsort((owner, which))
            first = np.searchsorted(np.asarray(which)[order], np.arange(len(start) + 1)).astype(np.int32)
            parts += [struct.pack("<qq", w.least, w.block), *(x.tobytes() for x in (start, length, array("B", w.shift), w.head, w.follow, first, np.asarray(owner, dtype=np.int32)[order]))]
        return b"".join([struct.pack(f"<{1 + len(parts)}q", len(parts), *map(len, parts)), *(x for p in parts for x in (p, bytes(-len(p) % 8)))])

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set]:
        """The number of words, the merged ranges of hit words, and the items found."""
        text = plain(text)
        found = sorted((at, w.length[i], k, i) for k, (w, _, _) in enumerate(self.searches) for at, i in w.find(text))
        ranges: list[list[int]] = []
        numbers: set[int] = set()
        word, seen = 0, 0
        for at, size, k, i in found:
            word += text.count(b" ", seen, at)
            seen = at
            end = word + text.count(b" ", at, at + size) - 1
            _, first, owners = self.searches[k]
            numbers.update(owners[first[i] : first[i + 1]])
            if ranges and word <= ranges[-1][1]:
                ranges[-1][1] = max(ranges[-1][1], end)
            else:
                ranges.append([word, end])
        return max(0, text.count(b" ") - 1) if len(text) > 2 else 0, [tuple(r) for r in ranges], {self.names[x] for x in numbers}


@lru_cache(maxsize=1)
def _mapped(path: str) -> Matcher:
    """One for each Python worker; the file's pages are shared by the workers of a host."""
    with open(path, "rb") as f:
        return Matcher(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


_HITS = "n_words long, ranges array<struct<first:long,end:long>>, items array<string>"
_HIT = pa.struct([("n_words", pa.int64()), ("ranges", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])
#: Bytes of a packed set, at most, for each byte of text (the text, and up to eight cells of shifts) and for each word (a pattern's five integers, and up to eight cells of bucket heads).
_PER_BYTE, _PER_WORD = 9, 52


def pattern_sets(benchmark: DataFrame, most: int = MAX_PATTERN_BYTES) -> Iterator[bytes]:
    """The packed sets, one after the other. A benchmark comes to the driver item by item; only the items of one set are there at a time."""
    items, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").toLocalIterator():
        text = r.text.encode()
        own = _PER_BYTE * len(text) + _PER_WORD * len(text.translate(_FORM).split())
        if items and size + own > most:
            yield Matcher.pack(items)
            items, size = [], 0
        items.append((r.item_id, text))
        size += own
    if items:
        yield Matcher.pack(items)


def _scanner(spark, packed: bytes):
    """A column function that scans texts for one packed set."""
    uri = put(spark, f"patterns-{uuid.uuid4().hex}.bin", packed)

    @F.arrow_udf(_HITS)
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = _mapped(local_copy(uri))
        for column in columns:
            out = []
            for text in as_bytes(column):
                n, ranges, items = matcher.scan(text)
                out.append({"n_words": n, "ranges": [{"first": a, "end": b} for a, b in ranges], "items": sorted(items, key=lambda i: (i is None, i or ""))})
            yield pa.array(out, _HIT)

    return scan


def _text_key(text: str = "text"):
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def hits(docs: DataFrame, benchmark: DataFrame, name: str = "_hits", most: int = MAX_PATTERN_BYTES) -> DataFrame:
    """docs with one more column: a struct of n_words, hit word ranges (first, end) and items, from a scan of each whole text. With several sets, each further one is scanned for in a pass of its own, whose hits are few and written; they meet the documents by the text's digest."""
    spark = docs.sparkSession
    sets = pattern_sets(benchmark, most)
    found = docs.withColumn(name, _scanner(spark, next(sets, Matcher.pack([])))(F.col("text")))
    more = []
    for packed in sets:
        own = docs.select("text").withColumn("h", _scanner(spark, packed)(F.col("text"))).where(F.size("h.items") > 0)
        more.append(saved(own.select(_text_key().alias("key"), "h.ranges", "h.items").dropDuplicates(["key"]), "hits"))
    if not more:
        return found
    key, also = free(docs, "key"), free(docs, "more")
    every = more[0]
    for x in more[1:]:
        every = every.unionByName(x)
    every = every.groupBy("key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"), F.flatten(F.collect_set("items")).alias("items"))
    every = every.select(F.col("key").alias(key), F.struct("ranges", "items").alias(also))
    keyed = matched(found.withColumn(key, _text_key()), saved(every, "hits"), [key], "left")
    one, two = F.col(name), F.col(also)
    none = F.when(two.isNull(), one).otherwise(F.struct(one["n_words"].alias("n_words"), F.concat(one["ranges"], two["ranges"]).alias("ranges"), F.array_distinct(F.concat(one["items"], two["items"])).alias("items")))
    return keyed.withColumn(name, none).select(*docs.columns, name)


def _n_hit(ranges):
    """Words in the union of ranges."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    step = lambda s, r: F.struct((s["n"] + F.greatest(F.lit(0).cast("long"), r["end"] - F.greatest(r["first"], s["upto"]))).alias("n"), F.greatest(s["upto"], r["end"]).alias("upto"))
    return F.aggregate(F.array_sort(ranges), start, step, lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs.select("doc_id", "text"), benchmark)
    n, hit = F.col("_hits.n_words"), _n_hit(F.col("_hits.ranges"))
    return found.select("doc_id", n.alias("n_words"), hit.alias("n_hit"), F.size("_hits.items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("_hits.items"), ","), 256).alias("items_sha256")).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated; all columns."""
    name = free(docs, "hits")
    found = hits(docs, table(spark, sf_dir, "benchmark"), name)
    hit = _n_hit(F.col(name)["ranges"])
    return found.where(~((hit > 0) & (20 * hit >= F.col(name)["n_words"]))).drop(name)


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
     bw AS (SELECT item_id, least(len(w), 13) AS k, w, unnest(range(greatest(len(w) - 13, 0) + 1)) AS i FROM b WHERE len(w) > 0),
     pat AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1 : i + k], ' ') AS p FROM bw),
     ks AS (SELECT DISTINCT k FROM pat),
     dw AS (SELECT doc_id, k, w, unnest(range(len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k),
     dg AS (SELECT doc_id, k, i, array_to_string(w[i + 1 : i + k], ' ') AS p FROM dw),
     occ AS (SELECT dg.doc_id, dg.i, dg.k, pat.item_id FROM dg JOIN pat ON dg.p = pat.p AND dg.k = pat.k),
     hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS j FROM occ) GROUP BY doc_id),
     its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
