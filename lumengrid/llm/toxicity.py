"""Toxicity by a linear-chain conditional random field.

Tokens are runs of letters. Their features are the word in lower case, its beginnings and endings, its shape, and the
words beside it. The labels mark whole documents, so token labels are derived: Spark counts, over the training
documents, in how many toxic and clean ones each word and each beginning occurs (copies of a text, told by the smallest
shingle hash, count once). Those whose likelihood ratio beats the number of features tested are marks; then the toxic
documents without a mark are looked at alone, against all clean ones, until no more marks are found. Marked tokens of
toxic documents are the first token labels. A CRF learns weights of features and of label transitions from tagged
sequences; its own marginals then label the tokens anew (toxic ones only within toxic documents), and it learns once
more. Forward-backward marginals give each token's probability; a logistic function of their sum, mean and two
largest is the document's score, and tokens above SPAN are the offending spans.

A sequence has WINDOW tokens and shares OVERLAP with the next one; a token's marginal comes from the sequence in which
it lies farther from an end. At most about TRAIN_ROWS labelled documents and TRAIN_WINDOWS sequences are learnt from;
every document is scored whole.

Defined cases: null texts count as empty; empty texts get the score of a text without toxic tokens; without toxic
training rows every score is the share of toxic labels (0 without labels); repeated rows are scored alike; very long
texts are scored whole, their sequences some thousand at a time; labels without a document, null labels and null ids are
left out; of several labels of a document the largest counts; columns other than doc_id and text aren't read, so others
can't clash, and a stage passes them on; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, fit_logistic, free, labelled_rows, saved, table, word_hashes
from .near_dedup import shingles

TRAIN_ROWS = 24_000
TRAIN_WINDOWS = 6_000
#: Features that the model holds at most, the most telling ones.
FEATURES = 20_000
WINDOW, OVERLAP = 64, 16
BEGINNINGS, ENDINGS = (3, 4, 5, 6, 7, 8), (3, 4)
#: A feature is known if it occurs in so many of the sequences learnt from.
LEAST_SEEN = 5
#: Sequences that are run together.
TOGETHER = 4096
#: How many times commoner a mark is in toxic documents, at least.
COMMONER = 5.0
MODULUS, HELD = 4, 2
THRESHOLD = 0.3
SPAN = 0.5
_TOKEN = re.compile(r"[^\W\d_]+")


def marks_of(word: str) -> list[str]:
    """What may mark a word (in lower case): itself and its beginnings."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def shape(token: str) -> str:
    """Capitals, characters beyond ASCII, and length, coarsely."""
    case = "A" if token.isupper() and len(token) > 1 else "Aa" if token[:1].isupper() else "a"
    return f"#{case}{'' if token.isascii() else '+'}{min(len(token) // 3, 4)}"


def own_features(token: str) -> list[str]:
    word = token.lower()
    return [*marks_of(word), *("*" + word[-k:] for k in ENDINGS if len(word) > k), shape(token)]


def side_features(token: str) -> tuple[str, str]:
    """What a token says about the one after it, and about the one before it."""
    word = token.lower()
    return "<" + word, ">" + word


def spread(n: int) -> list[tuple[int, int, int, int]]:
    """The sequences of n tokens: where each begins and ends, and for which tokens its marginals count."""
    step, half = WINDOW - OVERLAP, OVERLAP // 2
    starts = range(0, max(1, n - OVERLAP), step) if n else ()
    return [(s, min(n, s + WINDOW), s + half * (s > 0), n if s + WINDOW >= n else s + WINDOW - half) for s in starts]


def _forward_backward(emit: np.ndarray, there: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences of label scores emit[n, t, 2], padded where not there[n, t]: marginals of label 1 [n, t], expected transitions [2, 2], log partition sums [n]. Each step's probabilities are scaled to a sum of one, so nothing overflows, and no logarithm is taken on the way."""
    n, length, _ = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e, move = np.exp(emit - top), np.exp(trans)
    f, scale = np.empty((length, n, 2)), np.empty((length, n))
    for t in range(length):
        own = np.exp(start) * e[:, 0] if t == 0 else (f[t - 1] @ move) * e[:, t]
        scale[t] = own.sum(axis=1)
        f[t] = own / scale[t, :, None]
        if t:
            f[t], scale[t] = np.where(there[:, t, None], f[t], f[t - 1]), np.where(there[:, t], scale[t], 1.0)
    z = np.log(scale).sum(axis=0) + (top[:, :, 0] * there).sum(axis=1)
    b = np.ones((n, 2))
    marginal = np.empty((n, length))
    moved = np.zeros((2, 2))
    for t in range(length - 1, -1, -1):
        marginal[:, t] = f[t, :, 1] * b[:, 1] * there[:, t]
        if t:
            inner = e[:, t] * b * (there[:, t] / scale[t])[:, None]
            moved += move * (f[t - 1].T @ inner)
            b = np.where(there[:, t, None], inner @ move.T, b)
    return marginal, moved, z


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    trans: list = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])
    start: list = field(default_factory=lambda: [0.0, 0.0])
    #: Of the document's score: intercept, log of 1 + expected toxic tokens, logits of the largest and of the second largest marginal, expected share.
    top: list = field(default_factory=lambda: [-20.0, 0.0, 0.0, 0.0, 0.0])


class _Words(dict):
    """Tokens by number; a new one is looked up in the model, and its three parts are kept in arrays."""

    def __init__(self, model: Model):
        self.model, self.parts = model, array("d")

    def __missing__(self, token: str) -> int:
        w = self.model.weights
        after, before = side_features(token)
        self.parts.extend((self.model.bias + sum(w[f] for f in own_features(token) if f in w), w.get(after, 0.0), w.get(before, 0.0)))
        self[token] = n = len(self)
        return n


def _marginals(scores: np.ndarray, last: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals of label 1 [t, n] of sequences of scores [t, n], which end at last[n]: forward and backward passes of the odds of label 1."""
    e, t = np.exp(np.clip(scores, -30, 30)), np.exp(trans)
    odds = np.empty_like(e)
    odds[0] = np.exp(start[1] - start[0]) * e[0]
    for k in range(1, len(e)):
        r = odds[k - 1]
        odds[k] = e[k] * ((t[0, 1] + t[1, 1] * r) / (t[0, 0] + t[1, 0] * r))
    back = np.ones(e.shape[1])
    for k in range(len(e) - 2, -1, -1):
        q = e[k + 1] * back
        back = np.where(k < last, (t[1, 0] + t[1, 1] * q) / (t[0, 0] + t[0, 1] * q), 1.0)
        odds[k] *= back
    return odds / (1 + odds)


class Tagger:
    def __init__(self, model: Model):
        self.m, self.known = model, _Words(model)
        self.trans, self.start = np.array(model.trans), np.array(model.start)

    def scores(self, texts: list[str]) -> list[np.ndarray]:
        """The score of each token for label 1: what it adds itself, and what the ones before and after it add."""
        if len(self.known) > 500_000:
            self.known = _Words(self.m)
        numbers = [np.fromiter(map(self.known.__getitem__, _TOKEN.findall(x)), dtype=np.int64) for x in texts]
        parts = np.array(self.known.parts).reshape(-1, 3)
        out = []
        for n in numbers:
            own, after, before = parts[n].T
            own = own.copy()
            own[1:] += after[:-1]
            own[:-1] += before[1:]
            out.append(own)
        return out

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """The probability of each token to be toxic."""
        out, waiting = [], []

        def run() -> None:
            scores, last = np.zeros((WINDOW, len(waiting))), np.array([len(part) - 1 for part, *_ in waiting])
            for i, (part, *_) in enumerate(waiting):
                scores[: len(part), i] = part
            got = _marginals(scores, last, self.trans, self.start)
            for i, (_, into, at, a, b) in enumerate(waiting):
                into[a:b] = got[a - at : b - at, i]
            waiting.clear()

        for scores in self.scores(texts):
            out.append(np.empty(len(scores)))
            for at, end, a, b in spread(len(scores)):
                waiting.append((scores[at:end], out[-1], at, a, b))
                if len(waiting) == TOGETHER:
                    run()
        if waiting:
            run()
        return out

    @staticmethod
    def summary(p: np.ndarray) -> tuple[float, float, float, float]:
        if not len(p):
            return 0.0, -9.0, -9.0, 0.0
        least = 1.3e-4
        two = np.clip(np.partition(p, len(p) - 2)[-2:] if len(p) > 1 else [least, p[0]], least, 1 - least)
        second, first = np.log(two / (1 - two)).tolist()
        return math.log1p(float(p.sum())), first, second, float(p.mean())

    def document(self, p: np.ndarray) -> float:
        w = self.m.top
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, w[0] + sum(a * b for a, b in zip(w[1:], self.summary(p)))))))


def _small(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that only a few texts are held as words at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _counted(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): in how many documents each feature occurs; tasks add up their own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for batch in _small(batches):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if label else clean).update({f for w in set(_TOKEN.findall((text or "").lower())) for f in marks_of(w)})
            if len(toxic) + len(clean) > 1 << 18:
                yield from out(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield from out(toxic, clean)

    def out(toxic: Counter, clean: Counter) -> Iterator[pa.RecordBatch]:
        names = list(toxic | clean)
        for i in range(0, len(names), 50_000):
            part = names[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([toxic[f] for f in part], pa.int64()), pa.array([clean[f] for f in part], pa.int64())], ["feature", "toxic", "clean"])

    return rows.select("text", "label").mapInArrow(run, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def telling(rows: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Marks far commoner in toxic documents than chance allows: first among all, then, round by round, among the toxic documents that have no mark yet, whose share is smaller, so that rarer marks stand out. What is collected are at most FEATURES candidates, and which of them the toxic documents of the sample hold."""
    t, c = F.col("toxic"), F.col("clean")
    odd = (t >= 3) & (t * n_clean > COMMONER * (c + 0.5) * n_toxic)
    candidates = {r.feature: (i, r.clean) for i, r in enumerate(_counted(rows).where(odd).orderBy(F.desc(t / (c + 1)), "feature").limit(FEATURES).collect())}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            own = [sorted({candidates[f][0] for w in set(_TOKEN.findall((x or "").lower())) for f in marks_of(w) if f in candidates}) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32()))], ["own"])

    texts = [np.array(r.own, dtype=np.int64) for r in rows.where("label = 1").select("text").mapInArrow(held, "own array<int>").collect()]
    clean = np.array([n for _, n in candidates.values()], dtype=float)
    chosen = np.zeros(len(candidates), dtype=bool)
    left = texts
    while left and len(candidates):
        toxic = np.bincount(np.concatenate(left), minlength=len(clean)).astype(float)
        share = len(left) / (len(left) + n_clean)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = toxic * np.log(toxic / (toxic + clean) / share) + np.where(clean > 0, clean * np.log(clean / (toxic + clean) / (1 - share)), 0)
        new = ~chosen & (toxic >= 3) & (gain > 14)
        if not new.any():
            break
        chosen |= new
        left = [x for x in left if not chosen[x].any()]
    return [f for f, (i, _) in candidates.items() if chosen[i]]


_WINDOW_TYPE = pa.schema([("words", pa.list_(pa.string())), ("tags", pa.list_(pa.int32())), ("toxic", pa.bool_()), ("any", pa.bool_())])


def _windows(rows: DataFrame, marks: set[str], most: int) -> list[tuple[list[str], list[int], bool]]:
    """Sequences with first token labels and whether their document is toxic: at most about `most`, half of them with a marked token, picked by a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            out = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _TOKEN.findall(text or "")
                for at in range(0, len(words), WINDOW):
                    part = words[at : at + WINDOW]
                    tags = [int(bool(label) and any(f in marks for f in marks_of(w.lower()))) for w in part]
                    out.append({"words": part, "tags": tags, "toxic": bool(label), "any": any(tags)})
            yield pa.RecordBatch.from_pylist(out, schema=_WINDOW_TYPE)

    tagged = rows.select("text", "label").mapInArrow(run, "words array<string>, tags array<int>, toxic boolean, any boolean")
    return [(r.words, r.tags, r.toxic) for part in ("any", "not any") for r in tagged.where(part).orderBy(F.xxhash64("words")).limit(most // 2).collect()]


def known_features(windows: list[tuple[list[str], list[int], bool]], marks: list[str]) -> list[str]:
    """The marks, and the commonest features that occur in at least LEAST_SEEN sequences."""
    seen: Counter = Counter()
    for words, *_ in windows:
        seen.update({f for w in set(words) for f in (*own_features(w), *side_features(w))})
    common = [f for f, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if n >= LEAST_SEEN]
    return list(dict.fromkeys([*marks, *common[:FEATURES]]))


def fit_crf(windows: list[tuple[list[str], list[int], bool]], known: list[str], passes: int = 2, rounds: int = 60, rate: float = 0.3, ridge: float = 1e-4, side_ridge: float = 3e-3) -> Model:
    """Maximise the conditional likelihood by Adam on whole batches; between passes, the tokens of toxic documents get the label that the model finds likelier. Features are summed once for each distinct token, then looked up by its number."""
    number = {f: i for i, f in enumerate(known)}
    n, k = len(windows), len(known)
    there, tags, toxic = np.zeros((n, WINDOW), dtype=bool), np.zeros((n, WINDOW), dtype=np.int64), np.array([w[2] for w in windows])
    vocabulary: dict[str, int] = {}
    at = np.zeros((n, WINDOW), dtype=np.int64)
    for i, (words, own, _) in enumerate(windows):
        there[i, : len(words)], tags[i, : len(own)] = True, own
        at[i, : len(words)] = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
    size = len(vocabulary)
    pairs = [(i, number[f]) for w, i in vocabulary.items() for f in own_features(w) if f in number]
    word, feature = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
    sides = np.array([[number.get(f, -1) for f in side_features(w)] for w in vocabulary], dtype=np.int64).reshape(-1, 2).T
    pull = np.array([side_ridge if f[0] in "<>" else ridge for f in known] + [ridge] * 7)
    both = there[:, 1:]
    w = np.zeros(k + 7)
    w[k] = -4.0
    for turn in range(passes):
        seen = np.array([[((tags[:, :-1] == a) & (tags[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)], dtype=float)
        begin = np.array([(tags[:, 0] == 0).sum(), (tags[:, 0] == 1).sum()], dtype=float)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for r in range(1, rounds + 1):
            own = np.bincount(word, weights=w[feature], minlength=size)
            after, before = (np.where(s >= 0, w[s], 0.0) for s in sides)
            score = w[k] + own[at]
            score[:, 1:] += after[at[:, :-1]]
            score[:, :-1] += before[at[:, 1:]] * both
            score *= there
            p, moved, _ = _forward_backward(np.stack([np.zeros_like(score), score], axis=-1), there, w[k + 1 : k + 5].reshape(2, 2), w[k + 5 :])
            miss = (tags - p) * there
            by_word = lambda where, x: np.bincount(where.ravel(), weights=x.ravel(), minlength=size)
            g = np.zeros_like(w)
            g[:k] = np.bincount(feature, weights=by_word(at, miss)[word], minlength=k) if k else 0
            for s, x in zip(sides, (by_word(at[:, :-1], miss[:, 1:]), by_word(at[:, 1:], miss[:, :-1] * both))):
                g[s[s >= 0]] += x[s >= 0]
            g[k:] = np.concatenate([[miss.sum()], (seen - moved).ravel(), begin - np.array([(1 - p[:, 0]).sum(), p[:, 0].sum()])])
            g = g / n - pull * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w + rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.999**r)) + 1e-9)
        if turn + 1 < passes:
            tags = ((p >= 0.5) & toxic[:, None] & there).astype(np.int64)
    return Model({f: x for f, x in zip(known, w[:k].tolist()) if abs(x) > 1e-3}, float(w[k]), w[k + 1 : k + 5].reshape(2, 2).tolist(), w[k + 5 :].tolist())


def _smallest(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in columns:
        out = []
        for text in column.to_pylist():
            s = shingles(word_hashes((text or "").lower().encode()))
            out.append(int(s.min().astype(np.int64)) if len(s) else None)
        yield pa.array(out, pa.int64())


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled_rows(docs, labels, "toxic", MODULUS, HELD, TRAIN_ROWS)
    rows = saved(rows.withColumn("smallest", F.arrow_udf(_smallest, "long")("text")).dropDuplicates(["smallest", "label"]).select("text", "label"), "toxic-rows")
    amount = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    n_toxic, n_clean = amount.get(1, 0), amount.get(0, 0)
    model = Model(top=[math.log((n_toxic + 1e-9) / (n_clean + 1e-9)) if n_toxic and n_clean else (20.0 if n_toxic else -20.0), 0.0, 0.0, 0.0, 0.0])
    if not n_toxic or not n_clean:
        return model
    marks = telling(rows, n_toxic, n_clean)
    if not marks:
        return model
    top = model.top
    windows = _windows(rows, set(marks), TRAIN_WINDOWS)
    model = fit_crf(windows, known_features(windows, marks))
    model.top = top

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in _small(batches):
            own = [tagger.summary(p) for p in tagger.marginals([x or "" for x in batch.column(0).to_pylist()])]
            yield pa.RecordBatch.from_arrays([*(pa.array([s[i] for s in own], pa.float64()) for i in range(4)), batch.column(1)], [*names, "label"])

    names = ["total", "most", "second", "share"]
    got = rows.select("text", "label").mapInArrow(summaries, "total double, most double, second double, share double, label int").toPandas()
    model.top = fit_logistic(got[names].to_numpy(), got["label"].to_numpy(dtype=float)).tolist()
    return model


def scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with the toxicity score of each whole text."""

    @F.arrow_udf("double")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(model)
        for column in columns:
            texts = column.to_pylist()
            yield pa.array([tagger.document(p) for at in range(0, len(texts), 200) for p in tagger.marginals([x or "" for x in texts[at : at + 200]])], pa.float64())

    return docs.withColumn(name, run("text"))


def spans(docs: DataFrame, model: Model, least: float = SPAN) -> DataFrame:
    """doc_id and the offending spans: start, end (code points, end exclusive), word, probability."""

    @F.arrow_udf("array<struct<start:int,end:int,word:string,probability:double>>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(model)
        for column in columns:
            texts = [x or "" for x in column.to_pylist()]
            out = []
            for text, p in zip(texts, tagger.marginals(texts)):
                out.append([{"start": m.start(), "end": m.end(), "word": m.group(), "probability": float(q)} for m, q in zip(_TOKEN.finditer(text), p) if q >= least])
            yield pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("word", pa.string()), ("probability", pa.float64())])))

    return docs.select("doc_id", run("text").alias("spans"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = scores(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", MODULUS) == HELD, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't toxic; all columns."""
    model = train(docs, table(spark, sf_dir, "labels"))
    name = free(docs, "toxicity")
    return scores(docs, model, name).where(F.col(name) < THRESHOLD).drop(name)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
