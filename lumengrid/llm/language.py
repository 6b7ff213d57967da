"""Language identification by hierarchical discrimination: first the language family, then the language within it.

Texts are lower-cased; runs of letters are words. A text's features are counts of the character 1-, 2- and 3-grams of its
words (with their borders) in CELLS hash cells; their square roots, scaled to unit length, are the vector. Families are
told apart by one linear support vector machine each (one against the rest); the languages of the chosen family by a
machine for each pair of them (one versus one), which vote; equal votes go to the larger sum of margins, then to the
first name. Languages that FAMILIES doesn't list are families of their own.

Training takes about PER_LANGUAGE rows of each language, picked by a hash of id and text. Spark makes the training set of
each machine (a row goes to each machine it takes part in) and fits the machines in tasks of their own: a
squared-hinge machine by Newton's method on the Gram matrix, whose size is the sample's. Every text is predicted whole;
very long ones piece by piece, whose counts add up.

Defined cases: null texts and texts without a letter are `und`, score 0; so is every text if no language can be learnt;
with one language all other texts get it; rows with a null lang or id aren't learnt from; copies count once; repeated rows
are predicted alike; ties see above; an empty table gives an empty result; only doc_id, text and (for training) lang are
read, so other columns can't clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, mix64, saved, table

#: Rows of a language to learn from, about; rows of either side of a family's machine, about.
PER_LANGUAGE, AGAINST = 800, 1600
CELLS = 1 << 13
GRAMS = (1, 2, 3)
#: Characters of a text that are held as numbers at a time.
PIECE = 1 << 20
#: How strongly weights are held down.
RIDGE = 1.0
#: How steeply a margin becomes a probability.
STEEP = 4.0
MODULUS, HELD = 3, 1
UNKNOWN = "und"

#: Families of languages by ISO 639-1 code (fixed values).
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af yi fo",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi bn pa gu mr ne or as ur si",
    "celtic": "ga gd cy br",
    "baltic": "lt lv",
    "semitic": "ar he am mt",
    "dravidian": "ta te kn ml",
    "iranian": "fa ps ku tg",
    "austronesian": "id ms tl jv mg",
    "sinitic": "zh",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], f"={lang}")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), dtype=bool, count=0x110000)


_STRIDE = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _piece(text: str, total: np.ndarray) -> bool:
    """Add the gram counts of a text; whether it has a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return False
    c = np.zeros(len(points) + 2, dtype=np.uint64)  # anything but letters is the border 0
    c[1:-1] = np.where(letter, points, 0)
    inside = c > 0
    h = np.zeros(len(c), dtype=np.uint64)
    some = inside.copy()
    for n in GRAMS:
        h = h[: len(c) - n + 1] + c[n - 1 :] * _STRIDE[n - 1] + np.uint64(n)
        if n > 1:  # a border may begin or end a gram, not lie within it
            some = inside[:-1] | inside[1:] if n == 2 else inside[1:-1]
        total += np.bincount((mix64(h[some[: len(h)]]) & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    return True


def counts(text: str | None, piece: int = PIECE) -> np.ndarray | None:
    """Counts of a text's grams by cell; None without letters. A very long text is cut at spaces, or inside a word that is longer than a piece."""
    total, found, at = np.zeros(CELLS), False, 0
    text = text or ""
    while at < len(text):
        end = min(len(text), at + piece)
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = cut + 1 if cut > at else end
        found = _piece(text[at:end], total) or found
        at = end
    return total if found else None


def vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the texts that have a letter, and which those are."""
    x, has = np.empty((len(texts), CELLS), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    n = 0
    for i, t in enumerate(texts):
        own = counts(t)
        if own is not None:
            x[n], has[i], n = own, True, n + 1
    x = x[:n]
    np.sqrt(x, out=x)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x, has


def fit_machine(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> np.ndarray:
    """Weights, the intercept last, of a linear support vector machine with squared hinge loss; y is 1 or -1, and both sides weigh alike. Newton's method in the sample's space: only rows within the margin take part in a step."""
    gram = (x @ x.T).astype(np.float64)
    gram += 1  # the intercept is a component that is always 1
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    beta, f = np.zeros(len(y)), np.zeros(len(y))
    active = np.ones(len(y), dtype=bool)
    for _ in range(rounds):
        k = np.flatnonzero(active)
        beta[:] = 0
        if len(k):
            own = gram[np.ix_(k, k)]
            own[np.arange(len(k)), np.arange(len(k))] += ridge / weight[k]
            beta[k] = np.linalg.solve(own, y[k])
        f = gram @ beta
        now = y * f < 1
        if (now == active).all():
            break
        active = now
    return np.append(x.T @ beta.astype(np.float32), beta.sum())


_MACHINE = "kind string, one string, two string"


@dataclass
class Model:
    """Machines for families and for pairs of languages: names, and weights by column."""

    families: list[str]
    rest: np.ndarray
    pairs: list[tuple[str, str]]
    versus: np.ndarray
    members: dict[str, list[str]]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        x, has = vectors(texts)
        if not self.families:
            return [(UNKNOWN, 0.0)] * len(texts)
        sure = lambda m: 1 / (1 + np.exp(-STEEP * np.clip(m, -8, 8)))
        top = x @ self.rest[:-1] + self.rest[-1] if len(self.families) > 1 else np.full((len(x), 1), 8.0)
        two = x @ self.versus[:-1] + self.versus[-1]
        out = iter(self._one(top[i], two[i], sure) for i in range(len(x)))
        return [next(out) if h else (UNKNOWN, 0.0) for h in has]

    def _one(self, top: np.ndarray, two: np.ndarray, sure) -> tuple[str, float]:
        best = int(np.argmax(top))
        langs = self.members[self.families[best]]
        votes, margins, least = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0), dict.fromkeys(langs, 8.0)
        for (a, b), m in zip(self.pairs, two.tolist()):
            if a in votes:
                votes[a if m >= 0 else b] += 1
                margins[a], margins[b] = margins[a] + m, margins[b] - m
                least[a], least[b] = min(least[a], m), min(least[b], -m)
        lang = min(langs, key=lambda c: (-votes[c], -margins[c], c))
        others = np.delete(top, best)
        lead = float(top[best] - others.max()) / 2 if len(others) else 8.0
        return lang, float(sure(lead) * sure(least[lang]))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, text, lang) of about so many rows of each language outside the held-out ones, written. A row's share depends on its language's number of rows, which are counted without reading texts: a number for each language."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).where("doc_id is not null and lang is not null").where(crc_mod("doc_id", MODULUS) != HELD)
    told = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.create_map(*[F.lit(x) for lang, n in sorted(told.items()) for x in (lang, min(1.0, per_language / n))]) if told else F.create_map(F.lit(""), F.lit(0.0))
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(1 << 30) < share[F.col("lang")]).where(F.col("text").rlike(r"\p{L}"))
    return saved(picked.withColumn("_key", F.xxhash64("text")).dropDuplicates(["lang", "_key"]).select("doc_id", "text", "lang"), "language-rows")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, against: int = AGAINST) -> Model:
    """Machines fitted in tasks, one group for each; what comes to the driver are their weights. A group holds what one machine learns from: about per_language rows of either language of a pair, or `against` of a family and of all others."""
    rows = sample(docs, per_language)
    amount = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    members: dict[str, list[str]] = {}
    for lang in sorted(amount):
        members.setdefault(family(lang), []).append(lang)
    families, total = sorted(members), sum(amount.values())
    size = {f: sum(amount[c] for c in members[f]) for f in families}
    jobs: list[tuple[str, str, str, str, int, float]] = []  # kind, one, two, a language that takes part, its side, the share of its rows
    for f in families if len(families) > 1 else []:
        jobs += [("family", f, "", c, 1, min(1.0, against / size[f])) for c in members[f]]
        jobs += [("family", f, "", c, -1, min(1.0, against / max(1, total - size[f]))) for g in families if g != f for c in members[g]]
    pairs = [p for f in families for p in itertools.combinations(members[f], 2)]
    jobs += [("pair", a, b, c, 1 if c == a else -1, 1.0) for a, b in pairs for c in (a, b)]
    machines: dict[tuple, np.ndarray] = {}
    if jobs:
        plan = rows.sparkSession.createDataFrame(jobs, f"{_MACHINE}, lang string, side int, share double")

        def fit(key: tuple, group: pa.Table) -> pa.Table:
            x, has = vectors(group.column("text").to_pylist())
            w = fit_machine(x, group.column("side").to_numpy()[has].astype(np.float64))
            return pa.table({**{n: pa.array([k.as_py()], pa.string()) for n, k in zip(("kind", "one", "two"), key)}, "weights": pa.array([w.astype("<f4").tobytes()], pa.binary())})

        parts = rows.join(F.broadcast(plan), "lang").where(F.pmod(F.xxhash64("doc_id", "one", "text"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
        fitted = parts.select("kind", "one", "two", "side", "text").groupBy("kind", "one", "two").applyInArrow(fit, f"{_MACHINE}, weights binary")
        machines = {(r.kind, r.one, r.two): np.frombuffer(r.weights, dtype="<f4") for r in fitted.collect()}
    stack = lambda names: np.column_stack([machines.get(n, np.zeros(CELLS + 1, np.float32)) for n in names]) if names else np.empty((CELLS + 1, 0), np.float32)
    return Model(families, stack([("family", f, "") for f in families] if len(families) > 1 else []), pairs, stack([("pair", *p) for p in pairs]), members)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """docs' doc_id with lang_pred and score."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            got = [p for at in range(0, len(column), 256) for p in model.predict(column.slice(at, 256).to_pylist())]
            yield pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["lang", "score"])

    return docs.select("doc_id", run("text").alias("_p")).select("doc_id", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    got = predicted(docs.select("doc_id", "text"), train(docs))
    return got.select("doc_id", F.coalesce(crc_mod("doc_id", MODULUS) == HELD, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11_language(spark, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))
