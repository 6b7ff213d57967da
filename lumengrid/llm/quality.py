"""Quality classification by a sparse rule ensemble.

One pass turns each whole text into statistics. From a bounded sample of labelled rows, small boosted trees are grown;
each path from a root to a node is a conjunctive rule over the statistics. A logistic regression with an L1 penalty
keeps a few rules, and these are compiled into one Spark column expression over the statistics, which scores all rows.

At most about TRAIN_ROWS labelled documents are learnt from; the statistics and scores cover every document.

Defined cases: null texts count as empty; empty texts have all statistics 0 and are scored like any other; without
training rows of both labels the score is the share of label 1 (0.5 without labels); repeated rows are scored alike;
very long texts are described whole, one at a time; labels without a document, null labels and null ids are left out; of
several labels of a document the largest counts; columns other than doc_id and text aren't read, so others can't clash;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, crc_mod, saved, table

TRAIN_ROWS = 12_000
TREES, DEPTH, CUTS = 24, 3, 24
#: Strength of the L1 penalty on rule weights.
LASSO = 2e-3
MODULUS, HELD = 5, 0
THRESHOLD = 0.3

STATS = ["log_bytes", "log_words", "word_length", "word_length_sd", "distinct_words", "repeated_neighbours", "commonest_word", "lines", "distinct_lines", "line_length", "upper", "digits", "symbols", "stops", "commas", "pipes", "exclaims", "marked_words", "not_ascii", "spaces", "longest_word"]

_KEEP = {name: bytes(b for b in range(256) if b not in chars) for name, chars in {"upper": range(65, 91), "digits": range(48, 58), "symbols": b"#$%&*+<=>@\\^_`{}~/|", "stops": b".", "commas": b",", "pipes": b"|", "exclaims": b"!", "not_ascii": range(128, 256), "spaces": b" \t\n\r\x0b\x0c"}.items()}


def statistics(text: bytes) -> list[float]:
    """The values of STATS."""
    n = len(text)
    words = text.split()
    if not words:
        return [float(np.log1p(n)), *[0.0] * (len(STATS) - 1)]
    k = len(words)
    length = np.fromiter(map(len, words), dtype=np.float64, count=k)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = text.split(b"\n")
    share = {name: len(text.translate(None, other)) / n for name, other in _KEEP.items()}
    marked = sum(not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,;:?") for w in words)
    return [float(np.log1p(n)), float(np.log1p(k)), float(length.mean()), float(length.std()), len(counts) / k, sum(map(bytes.__eq__, words, words[1:])) / k, max(counts.values()) / k, float(np.log1p(len(lines))), len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), share["upper"], share["digits"], share["symbols"], share["stops"], share["commas"], share["pipes"], share["exclaims"], marked / k, share["not_ascii"], share["spaces"], float(np.log1p(length.max()))]


def described(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(t) for t in as_bytes(batch.column(1))]).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(rows[:, i]) for i in range(len(STATS)))], ["doc_id", *STATS])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{s} double" for s in STATS))


#: A condition: statistic, threshold, whether values above it are meant.
Condition = tuple[int, float, bool]


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for s, cut, above in self.conditions:
            out &= (x[:, s] > cut) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for s, cut, above in self.conditions:
            out = out & (F.col(STATS[s]) > F.lit(cut) if above else F.col(STATS[s]) <= F.lit(cut))
        return out


def _grow(x: np.ndarray, binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, path: tuple[Condition, ...], depth: int, rules: set, step: np.ndarray) -> None:
    """One tree on gradients g and curvatures h; collects the paths and writes leaf values to step."""
    best = (1e-3, None)
    total_g, total_h = g[rows].sum(), h[rows].sum()
    if depth and len(rows) >= 20:
        for s in range(x.shape[1]):
            b = binned[rows, s]
            left_g, left_h = (np.cumsum(np.bincount(b, weights=v[rows], minlength=len(cuts[s]) + 1))[:-1] for v in (g, h))
            if not len(left_g):
                continue
            gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
            gain[(left_h < 1) | (total_h - left_h < 1)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (s, k))
    if best[1] is None:
        step[rows] = total_g / (total_h + 1)
        return
    s, k = best[1]
    above = binned[rows, s] > k
    for side in (False, True):
        own = (*path, (s, float(cuts[s][k]), side))
        rules.add(Rule(tuple(sorted(own))))
        _grow(x, binned, cuts, g, h, rows[above == side], own, depth - 1, rules, step)


def extract_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Boost small trees and return the rules of all their paths."""
    cuts = [np.unique(np.quantile(x[:, s], np.linspace(0, 1, CUTS + 2)[1:-1])) for s in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, s], side="left") for s, c in enumerate(cuts)])
    rules: set[Rule] = set()
    f = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        step = np.zeros(len(y))
        _grow(x, binned, cuts, y - p, p * (1 - p), np.arange(len(y)), (), DEPTH, rules, step)
        f += 0.3 * step
    return sorted(rules, key=lambda r: (len(r.conditions), r.conditions))


def lasso(a: np.ndarray, y: np.ndarray, penalty: float = LASSO, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic regression, by accelerated proximal gradients."""
    n, k = a.shape
    rate = 4 * n / (np.linalg.norm(np.column_stack([np.ones(n), a]), 2) ** 2)
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    v, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(-np.clip(a @ v + c, -30, 30))) - y
        new = v - rate * (a.T @ miss) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = c - rate * miss.mean()
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new + (t - 1) / after * (new - w), new_b + (t - 1) / after * (new_b - b)
        w, b, t = new, new_b, after
    return b, w


@dataclass
class Model:
    intercept: float
    rules: list[tuple[float, Rule]]

    def column(self) -> Column:
        """The score as one expression over the statistics."""
        total = F.lit(self.intercept)
        for w, r in self.rules:
            total = total + F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + sum((w * r.holds(x) for w, r in self.rules), np.zeros(len(x))))))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if not len(y) or y.min() == y.max():
        return Model(0.0 if not len(y) else (20.0 if y[0] else -20.0), [])
    order = np.lexsort(x.T)  # the result doesn't depend on the order of rows
    x, y = x[order], y[order]
    rules = extract_rules(x, y)
    if not rules:
        return Model(float(np.log(y.mean() / (1 - y.mean()))), [])
    b, w = lasso(np.column_stack([r.holds(x) for r in rules]).astype(np.float64), y)
    return Model(b, [(float(v), r) for v, r in zip(w, rules) if v])


def train(stats: DataFrame, labels: DataFrame) -> Model:
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").where(crc_mod("doc_id", MODULUS) != HELD).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, TRAIN_ROWS / max(1, own.count()))
    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = stats.join(F.broadcast(picked), "doc_id").select("label", *STATS).toPandas()
    return fit(got[STATS].to_numpy(dtype=float), got["label"].to_numpy(dtype=float))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    stats = saved(described(docs), "statistics")
    model = train(stats, labels)
    return stats.select("doc_id", F.coalesce(crc_mod("doc_id", MODULUS) == HELD, F.lit(False)).alias("held_out"), model.column().alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
