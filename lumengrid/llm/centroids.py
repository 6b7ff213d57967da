"""Centroid clustering: Lloyd's rounds on integer vectors, exact whatever the order of the additions.

A vector counts if it has exactly DIMENSIONS components, none null or non-finite; component x becomes floor(64 * x). Tasks
turn their batches into matrices. Distances are expanded, |x|^2 - 2 x.c + |c|^2, so that a block of vectors against all
centroids is one float64 matrix product. All numbers in it are integers; while the largest possible distance is below
2^53, float64 holds every one of them exactly, in whatever order BLAS adds. A block beyond that bound is computed with
64-bit integers below 2^63, and with Python's integers beyond. Sums by centroid are Python integers too, combined with
RDD.treeAggregate, so the driver receives one array of centroids, whatever the number of vectors.

Each round reads the vectors again; nothing is cached, so a lost executor costs its tasks only.

Defined cases: vectors that don't count get no row; with fewer vectors than centroids each is a centroid; without any the
result is empty; a null vec_id is hashed as an empty number; equal ids are told apart by their components when centroids
are chosen, and repeated rows may both be chosen; ties of distance go to the smaller number; a distance or an inertia
that no long holds is null; further columns aren't read, so none can clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: float64 holds every integer below the first bound; int64 below the second.
EXACT_FLOAT, EXACT_INT = 1 << 53, 1 << 63
#: Vectors in a matrix product.
BLOCK = 4096


def integers(vectors: pa.Array, dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which of the vectors (lists of numbers) count, and floor(scale * x) of those [n, dimensions]: int64, or Python's integers if one is larger."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dimensions)
    flat = vectors.take(pa.array(rows)).flatten()
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dimensions) if len(rows) else np.empty((0, dimensions))
    given = np.isfinite(x).all(axis=1)  # a null is NaN by now
    x = x[given]
    kept = np.zeros(len(sizes), dtype=bool)
    kept[rows[given]] = True
    if not x.size or np.abs(x).max() < (1 << 62) / scale:
        return kept, np.floor(x * scale).astype(np.int64)
    # from 2^53 on a float is a whole number, and its multiple may leave float64
    return kept, np.array([[math.floor(v * scale) if abs(v) < EXACT_FLOAT else int(v) * scale for v in row] for row in x.tolist()], dtype=object)


def _largest(a: np.ndarray) -> int:
    return int(np.abs(a).max()) if a.size else 0


def nearest(x: np.ndarray, centroids: list[list[int]], block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of its nearest centroid and their squared distance (int64, or Python's integers)."""
    c = np.array(centroids, dtype=object)
    number, distance = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=object)
    for at in range(0, len(x), block):
        part = x[at : at + block]
        bound = part.shape[1] * (_largest(part) + _largest(c)) ** 2  # no term and no sum of terms is larger
        kind = np.float64 if bound < EXACT_FLOAT else np.int64 if bound < EXACT_INT else object
        p, q = part.astype(kind), c.astype(kind)
        d = (p * p).sum(axis=1)[:, None] - 2 * (p @ q.T) + (q * q).sum(axis=1)[None, :]
        own = np.argmin(d, axis=1)  # the first of equal ones
        number[at : at + block] = own
        near = d[np.arange(len(part)), own]
        distance[at : at + block] = near if kind is object else near.astype(np.int64)
    return number, distance


def _blocks(vectors: DataFrame, dimensions: int, scale: int):
    """An RDD of matrices, one for each Arrow batch: numbers of rows and their bytes, so that Python rows aren't made of components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = integers(batch.column(0), dimensions, scale)
            if len(x):
                plain = x.dtype != object
                yield pa.RecordBatch.from_pydict({"whole": [x.tobytes()] if plain else pa.array([None], pa.binary()), "large": pa.array([None] if plain else [[str(v) for v in x.ravel()]], pa.list_(pa.string()))})

    def matrix(r) -> np.ndarray:
        if r.whole is not None:
            return np.frombuffer(r.whole, dtype=np.int64).reshape(-1, dimensions)
        return np.array([int(v) for v in r.large], dtype=object).reshape(-1, dimensions)

    return vectors.select("embedding").mapInArrow(run, "whole binary, large array<string>").rdd.map(matrix)


def _depth(parts: int) -> int:
    return 2 if parts <= 256 else 3


def _gathered(blocks, centroids: list[list[int]], with_vectors: bool) -> list:
    """Per centroid the number of its vectors, the sum of their distances, and their components' sums: Python's integers, added up in a tree of tasks."""
    dimensions = len(centroids[0])

    def add(total: list, x: np.ndarray) -> list:
        number, distance = nearest(x, centroids)
        for k in np.unique(number).tolist():
            own = number == k
            total[k][0] += int(own.sum())
            total[k][1] += sum(distance[own].tolist())
            if with_vectors:
                part = x[own]
                safe = part.dtype == object or _largest(part) * len(part) < EXACT_INT
                total[k][2] = [a + int(b) for a, b in zip(total[k][2], (part if safe else part.astype(object)).sum(axis=0))]
        return total

    def combine(a: list, b: list) -> list:
        return [[m[0] + n[0], m[1] + n[1], [s + t for s, t in zip(m[2], n[2])]] for m, n in zip(a, b)]

    return blocks.treeAggregate([[0, 0, [0] * dimensions] for _ in centroids], add, combine, _depth(blocks.getNumPartitions()))


def first_centroids(vectors: DataFrame, k: int, dimensions: int, scale: int, label: str = "1:") -> list[list[int]]:
    """The k counted vectors whose ids have the smallest hashes, in the hashes' order; each task hands on its k smallest."""
    columns = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, list[str]]] = []
        for batch in batches:
            kept, x = integers(batch.column(1), dimensions, scale)
            hashes = [hashlib.sha256(f"{label}{'' if i is None else i}".encode()).hexdigest() for i in batch.column(0).filter(pa.array(kept)).to_pylist()]
            if hashes:
                last = sorted(hashes)[:k][-1]
                best = sorted(best + [(h, [str(v) for v in own]) for h, own in zip(hashes, x) if h <= last])[:k]
        yield pa.RecordBatch.from_pydict({"h": pa.array([h for h, _ in best], pa.string()), "v": pa.array([v for _, v in best], pa.list_(pa.string()))})

    rows = columns.mapInArrow(run, "h string, v array<string>").orderBy("h", "v").limit(k).collect()
    return [[int(x) for x in r.v] for r in rows]


def fit(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[list[list[int]], list[int]]:
    """The centroids after so many rounds, and the inertia of each one's vectors."""
    centroids = first_centroids(vectors, k, dimensions, scale)
    if not centroids:
        return [], []
    blocks = _blocks(vectors, dimensions, scale)
    for _ in range(rounds):
        got = _gathered(blocks, centroids, True)
        centroids = [[s // n for s in sums] if n else old for old, (n, _, sums) in zip(centroids, got)]
    return centroids, [g[1] for g in _gathered(blocks, centroids, False)]


def _long(x: int) -> int | None:
    return int(x) if -EXACT_INT <= x < EXACT_INT else None


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """One row per counted vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    centroids, inertia = fit(vectors, k, rounds, dimensions, scale)
    total = _long(sum(inertia))
    own_total = pa.array([_long(x) for x in inertia], pa.int64())
    digest = pa.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if centroids else ():
            kept, x = integers(batch.column(1), dimensions, scale)
            number, distance = nearest(x, centroids)
            n = pa.array(number, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept)), n, pa.array([_long(d) for d in distance.tolist()], pa.int64()), own_total.take(n), pa.array([total] * len(number), pa.int64()), digest.take(n)], ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def op13_centroids(spark, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def _round(k: int) -> str:
    """SQL of one assignment and the centroids after it."""
    return f"""
     d{k} AS (SELECT x.n, c.k, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{k} c ON x.i = c.i GROUP BY x.n, c.k),
     a{k} AS (SELECT n, arg_min(k, d * 1000 + k) AS k, min(d) AS d FROM d{k} GROUP BY n),
     s{k} AS (SELECT a.k, x.i, sum(x.v) AS s, count(*) AS m FROM a{k} a JOIN x ON a.n = x.n GROUP BY a.k, x.i),
     c{k + 1} AS (SELECT c.k, c.i, CAST(CASE WHEN s.m IS NULL THEN c.v ELSE (s.s - ((s.s % s.m) + s.m) % s.m) // s.m END AS HUGEINT) AS v FROM c{k} c LEFT JOIN s{k} s ON c.k = s.k AND c.i = s.i),"""


SQL = f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, embedding FROM embeddings
           WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
     x AS (SELECT n, i, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS v FROM v, (SELECT unnest(range(1, {DIMENSIONS + 1})) AS i)),
     f AS (SELECT n, row_number() OVER (ORDER BY sha256('1:' || vec_id), n) - 1 AS k FROM v QUALIFY k < {CENTROIDS}),
     c0 AS (SELECT f.k, x.i, x.v FROM f JOIN x USING (n)),{"".join(_round(k) for k in range(ROUNDS))}
     d AS (SELECT x.n, c.k, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{ROUNDS} c ON x.i = c.i GROUP BY x.n, c.k),
     a AS (SELECT n, arg_min(k, d * 1000 + k) AS k, min(d) AS d FROM d GROUP BY n),
     h AS (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k)
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a JOIN v ON a.n = v.n JOIN h ON a.k = h.k
"""
