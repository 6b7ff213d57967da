"""BPE encoding and decoding with a minimal acyclic lexicon.

Spark counts the words of the corpus; the frequent ones, with the ids that exact merging gives them, are compiled
on the driver into a minimal acyclic automaton: equal suffixes share states, and an edge says how many words sort
before those behind it, so that a walk sums up to the word's number, which leads to its ids. The automaton is a file
that executors fetch once and their Python workers map into memory. Words it doesn't hold are merged exactly, in the
order of the merge ranks. The vocabulary's path is a parameter.

Defined cases: a null or empty text has no ids and decodes to an empty text; special tokens that stand in a text become
their ids, as in the library's default; rows repeat as they come and get equal results; a very long text is split into
words whole, its ids are written as text piece by piece; an empty table gives an empty result; only doc_id and text are
read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from .common import local_copy, put, saved, table

#: The lexicon holds the words that make up at least this share of all word occurrences; so it never holds more than 1 / FREQUENT words, and the driver compiles as many at most.
FREQUENT = 1 / (1 << 19)
#: Ids that are written as text in one step.
SPELLED = 1 << 17
#: Letters from which on a word is merged with a heap.
LONG_WORD = 200
#: Distinct words that one task remembers before it starts anew.
REMEMBERED = 1 << 17
#: Texts of these characters are composed already, and any Unicode version sees them alike, also in lower case; so does the pattern below, the vocabulary's own with its classes spelled out for such texts. Capitals whose lower case lies elsewhere are left out.
_RANGES = ((0x0, 0x233), (0x2010, 0x2027), (0x2030, 0x205E))
_PLAIN = {c for a, b in _RANGES for c in range(a, b + 1)}
_COMMON = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(_PLAIN) if all(ord(x) in _PLAIN for x in chr(c).lower())) + "]*")
_LETTER, _NUMBER, _SPACE = "a-zA-ZªµºÀ-ÖØ-öø-ȳ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merger:
    """Exact byte-pair merging of one word, from the vocabulary's file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.rank = {tuple(p.split(" ") if isinstance(p, str) else p): i for i, p in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.parting = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")") if self.special else None
        self.letters = byte_letters()
        self.words = Splitter(path)

    def merge(self, word: str) -> list[int]:
        parts = [self.letters[b] for b in word.encode()]
        parts[-1] += self.end
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        rank, worst = self.rank.get, len(self.rank)
        ranks = [rank(p, worst) for p in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < worst:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), worst)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), worst)
        return [self.ids[p] for p in parts]

    def _merge_long(self, parts: list[str]) -> list[int]:
        """The same merges from a heap of (rank, place), so that a huge word takes little more than linear time."""
        n, rank = len(parts), self.rank.get
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = a + b, ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (r := rank((parts[x], parts[y]))) is not None:
                    heappush(heap, (r, x, parts[x], parts[y]))
        return [self.ids[p] for p in parts if p]

    def pieces(self, text: str) -> list[tuple[int | None, str]]:
        """Special tokens (id, string) and what stands between them (None, text)."""
        if not self.parting or not any(s in text for s in self.special):
            return [(None, text)]
        return [(self.special.get(x), x) for x in self.parting.split(text) if x]


class Splitter:
    """The words of a text without special tokens: composed, in lower case, split by the vocabulary's pattern. Texts with rare characters go through the library's own normaliser and pattern, so that both follow one Unicode version."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.normal = Tokenizer.from_file(path).normalizer
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or _COMMON.fullmatch(text):
            return _WORD.findall(text.lower())
        return [w for w, _ in self.split.pre_tokenize_str(self.normal.normalize_str(text))]


class Lexicon:
    """A minimal acyclic automaton from words to numbers, and the ids of each number, in one mapped buffer of five arrays: keys (state << 8 | byte, sorted), targets, words skipped, id offsets, ids. The sign of a target tells a final state."""

    MAGIC = b"LEXICON1"

    def __init__(self, buffer):
        counts = np.frombuffer(buffer, dtype=np.int64, count=4, offset=8)
        at, parts = 40, []
        for n, kind in ((counts[0], np.int64), (counts[0], np.int32), (counts[0], np.int32), (counts[1] + 1, np.int32), (counts[2], np.int32)):
            parts.append(np.frombuffer(buffer, dtype=kind, count=int(n), offset=at))
            at += -(-int(n) * np.dtype(kind).itemsize // 8) * 8
        self.keys, self.targets, self.skips, self.offsets, self.all_ids = parts
        self.longest = int(counts[3])

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if it isn't held. All words walk the automaton together, a byte at a time."""
        out = np.full(len(words), -1, dtype=np.int64)
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        who = np.flatnonzero((length > 0) & (length <= self.longest))
        if not len(who) or not len(self.keys):
            return out
        letters = np.array([words[i] for i in who], dtype=f"S{self.longest}").view(np.uint8).reshape(len(who), self.longest)
        left = length[who]
        state, number, final = np.zeros(len(who), dtype=np.int64), np.zeros(len(who), dtype=np.int64), np.zeros(len(who), dtype=bool)
        for k in range(self.longest):
            key = state << 8 | letters[:, k]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            if not ok.all():
                at, who, letters, left, state, number, final = at[ok], who[ok], letters[ok], left[ok], state[ok], number[ok], final[ok]
            number = number + self.skips[at] + final  # a word that ends on the way sorts before
            target = self.targets[at]
            final, state = target < 0, np.abs(target).astype(np.int64)
            ends = left == k + 1
            out[who[ends & final]] = number[ends & final]
            go = ~ends
            who, letters, left, state, number, final = who[go], letters[go], left[go], state[go], number[go], final[go]
            if not len(who):
                break
        return out

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        return [None if n < 0 else self.all_ids[self.offsets[n] : self.offsets[n + 1]].tolist() for n in self.numbers(words).tolist()]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Build the automaton from its words in order; a state whose edges equal those of an earlier one is replaced by it."""
    ordered = sorted(w for w in entries if w)
    seen: dict[tuple, int] = {}
    edges: dict[int, list[tuple[int, int, bool, int]]] = {0: []}
    amount: dict[int, int] = {}
    path: list[list] = [[]]  # the open edges of each state along the current word: [byte, final, child]

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            own = tuple(tuple(e) for e in path.pop())
            if own not in seen:
                number = len(seen) + 1
                seen[own] = number
                amount[number] = sum(f + amount.get(c, 0) for _, f, c in own)
                edges[number] = own
            path[-1][-1][2] = seen[own]

    before = b""
    for w in ordered:
        same = len(os.path.commonprefix([before, w]))
        close(same)
        for b in w[same:]:
            path[-1].append([b, False, 0])
            path.append([])
        path[-2][-1][1] = True
        before = w
    close(0)
    edges[0] = [tuple(e) for e in path[0]]
    empty = seen.get((), 1)
    keys, targets, skips = [], [], []
    for state, own in edges.items():
        skipped = 0
        for b, final, child in own:
            keys.append(state << 8 | b), targets.append(-(child or empty) if final else child)
            skips.append(skipped)
            skipped += final + amount.get(child, 0)
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable") if keys else np.empty(0, dtype=np.int64)
    ids = [entries[w] for w in ordered]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64))).astype(np.int32)
    arrays = [np.array(keys, dtype=np.int64)[order], np.array(targets, dtype=np.int32)[order], np.array(skips, dtype=np.int32)[order], offsets, np.array([i for x in ids for i in x], dtype=np.int32)]
    out = [Lexicon.MAGIC, np.array([len(keys), len(ordered), len(arrays[4]), max(map(len, ordered), default=0)], dtype=np.int64).tobytes()]
    for a in arrays:
        raw = a.tobytes()
        out.append(raw + bytes(-len(raw) % 8))
    return b"".join(out)


class Spelling:
    """Writes ids as text, each followed by a space: one gather from a table of the ids' strings."""

    def __init__(self, strings: list[bytes]):
        self.length = np.array([len(x) + 1 for x in strings], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b" ".join(strings) + b" ", dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The text, and where each id's part ends."""
        length = self.length[ids]
        ends = np.cumsum(length)
        where = np.arange(int(ends[-1]) if len(ends) else 0)
        where += np.repeat(self.start[ids] - ends + length, length)
        return memoryview(self.flat[where]), ends


class Encoder:
    """Text to ids and back, through the lexicon and exact merging; remembers words as packed ids."""

    def __init__(self, merger: Merger, lexicon: Lexicon | None):
        self.merger, self.lexicon, self.known = merger, lexicon, {}
        most = max(merger.token)
        self.code = "H" if most < 1 << 16 else "I"
        self.numbers = Spelling([b"%d" % i for i in range(most + 1)])
        self.tokens = Spelling([merger.token.get(i, "").encode() for i in range(most + 1)])

    def learn(self, words: list[str]) -> None:
        found = self.lexicon.find([w.encode() for w in words]) if self.lexicon else [None] * len(words)
        for w, ids in zip(words, found):
            self.known[w] = array(self.code, self.merger.merge(w) if ids is None else ids).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        cut = [[(s, [] if s is not None else self.merger.words(x)) for s, x in self.merger.pieces(t)] for t in texts]
        self.learn(list(set(chain.from_iterable(own for pieces in cut for _, own in pieces)).difference(known)))
        out = []
        for pieces in cut:
            packed = b"".join(array(self.code, [special]).tobytes() if special is not None else b"".join(map(known.__getitem__, own)) for special, own in pieces)
            out.append(np.frombuffer(packed, dtype=self.code))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return bytes(self.tokens(ids)[0][:-1]).decode()

    def _long(self, spelling: Spelling, ids: np.ndarray) -> str:
        digest = hashlib.sha256()
        for at in range(0, len(ids), SPELLED):
            text, _ = spelling(ids[at : at + SPELLED])
            digest.update(text if at + SPELLED < len(ids) else text[:-1])
        return digest.hexdigest()

    def digests(self, rows: list[np.ndarray], spelling: Spelling) -> list[str]:
        """SHA-256 of each row's ids as text joined by spaces. Short rows are written together, huge ones piece by piece."""
        out: list[str] = []
        at = 0
        while at < len(rows):
            end, total = at, 0
            while end < len(rows) and total + len(rows[end]) <= SPELLED:
                total += len(rows[end])
                end += 1
            if end == at:
                out.append(self._long(spelling, rows[at]))
                at += 1
                continue
            text, ends = spelling(np.concatenate(rows[at:end]))
            n, start = 0, 0
            for r in rows[at:end]:
                n += len(r)
                stop = int(ends[n - 1]) if len(r) else start
                out.append(hashlib.sha256(text[start : max(start, stop - 1)]).hexdigest())
                start = stop
            at = end
        return out


@lru_cache(maxsize=1)
def _merger(path: str) -> Merger:
    """One for each Python worker, whatever the number of its tasks."""
    return Merger(path)


@lru_cache(maxsize=1)
def _encoder(path: str, lexicon: str) -> Encoder:
    return Encoder(_merger(path), Lexicon.mapped(lexicon))


def frequent_words(docs: DataFrame, path: str, share: float = FREQUENT) -> list[str]:
    """The words that make up at least `share` of all word occurrences, and some that make up at least half as much. All texts are counted. A task hands on, of each lot of words that it has counted, those with at least half that share of the lot; of a word, less than half the share of all occurrences is left out so, and therefore no word is missed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, seen = _merger(path), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                for text in batch.column(0).slice(at, 200).to_pylist():
                    for special, piece in merger.pieces(text or ""):
                        if special is None:
                            seen.update(merger.words(piece))
                    if len(seen) > REMEMBERED:
                        yield from out(seen)
                        seen = Counter()
        yield from out(seen)

    def out(seen: Counter) -> Iterator[pa.RecordBatch]:
        total = seen.total()
        kept = [(w, n) for w, n in seen.items() if 2 * n >= share * total]
        yield pa.RecordBatch.from_pydict({"word": pa.array([None, *(w for w, _ in kept)], pa.string()), "n": pa.array([total, *(n for _, n in kept)], pa.int64())})

    counted = saved(docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total = counted.where("word is null").agg(F.sum("n")).first()[0] or 0
    return [r.word for r in counted.where(F.col("word").isNotNull() & (F.col("n") * 2 >= total * share)).select("word").collect()]


def lexicon_file(spark: SparkSession, frequent: list[str], path: str) -> str:
    """Compile the words to a file in the shared folder; its URI."""
    merger = _merger(path)
    return put(spark, f"lexicon-{uuid.uuid4().hex}.bin", compile_lexicon({w.encode(): merger.merge(w) for w in frequent}))


def encoded(docs: DataFrame, path: str | None = None, frequent: float = FREQUENT, with_texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256; with_texts adds ids (array) and decoded."""
    path = path or default_path()
    uri = lexicon_file(docs.sparkSession, frequent_words(docs, path, frequent), path)
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_texts

    @F.arrow_udf(f"struct<{schema.replace(' long', ':long').replace(' string', ':string').replace(' array', ':array')}>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path, local_copy(uri))
        for column in columns:
            n, ids, decoded, all_ids, all_decoded = [], [], [], [], []
            for at in range(0, len(column), 200):
                rows = encoder.encode([x or "" for x in column.slice(at, 200).to_pylist()])
                n += map(len, rows)
                ids += encoder.digests(rows, encoder.numbers)
                decoded += encoder.digests(rows, encoder.tokens)
                if with_texts:
                    all_ids += [r.astype(np.int32) for r in rows]
                    all_decoded += map(encoder.decode, rows)
            arrays = [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string()), pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_decoded, pa.string())]
            yield pa.StructArray.from_arrays(arrays[: 3 + 2 * with_texts], ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 3 + 2 * with_texts])

    return docs.select("doc_id", run("text").alias("_e")).select("doc_id", "_e.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs)


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
