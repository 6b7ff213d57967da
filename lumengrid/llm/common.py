"""What the operators of this subpackage share: Arrow text access, word hashing, and written tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles at most, unless a single text is longer.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Where the session names none, a temporary one in local mode, as in tests; on a cluster that is an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


#: Paths of the tables and files that saved() and put() made in this process, oldest first.
_MADE: list[str] = []


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors, computes df once. The table stays until clear() or drop() removes it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a file to the shared folder; its URI."""
    path = f"{shared_dir(spark)}/{name}"
    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    with store.open_output_stream(at, compression=None) as out:
        out.write(data)
    _MADE.append(path)
    return path


def local_copy(uri: str) -> str:
    """In a task: a path by which a file that put() wrote can be mapped. Shared folders that are mounted are read in place; from other stores each executor fetches the file once. A new executor finds it too, unlike what SparkContext.addFile lists, which must never be deleted while the context lives."""
    store, at = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return at
    own = os.path.join(SparkFiles.getRootDirectory(), at.rpartition("/")[2])
    if not os.path.exists(own):
        part = f"{own}.{uuid.uuid4().hex}"
        with store.open_input_stream(at, compression=None) as src, open(part, "wb") as out:
            shutil.copyfileobj(src, out, 1 << 20)
        os.replace(part, own)
    return own


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def made() -> int:
    """How many tables there are; a point to clear() from."""
    return len(_MADE)


def clear(spark: SparkSession, since: int = 0, keep: int | None = None) -> None:
    """Delete the tables made from point `since` on and before point `keep`. Only for tables whose readers are done: results of operators read theirs when they are run."""
    end = len(_MADE) if keep is None else keep
    _remove(spark, _MADE[since:end])
    del _MADE[since:end]


def drop(df: DataFrame) -> None:
    """Delete the table that df reads, made by saved(), once nothing else reads it."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        own = [p for p in _MADE if p.rpartition("/")[2] == path.rpartition("/")[2]]
        _remove(df.sparkSession, own)
        for p in own:
            _MADE.remove(p)


#: Groups of at least LARGE rows, and of a share 1 / MANY of all rows, are joined by broadcasting their rows: at most MANY groups.
LARGE, MANY = 64, 100_000


def meet(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner") -> DataFrame:
    """rows joined to the row of their group (keys, its number of rows `size`, ...). No task receives a large group: large ones are few, whatever the data, so they are broadcast; all others go by key. With how="left", rows without a group stay."""
    groups = saved(groups, "groups")
    least = max(LARGE, -(-(groups.agg(F.sum(size)).first()[0] or 0) // MANY))
    large, small = groups.where(F.col(size) >= least), groups.where(F.col(size) < least)
    others = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(small, keys, how)
    return rows.join(F.broadcast(large), keys).unionByName(others)


def matched(rows: DataFrame, some: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows joined to `some` (one row for each value of keys; written already, as it is read more than once): broadcast if it has at most MANY rows, else by meet(), so that a frequent key burdens no task."""
    if some.count() <= MANY:
        return rows.join(F.broadcast(some), keys, how)
    size = free(rows, "size")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(size)).join(some, keys)
    return meet(rows, sizes, keys, size, how).drop(size)


def free(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept_rows(docs: DataFrame, decided: DataFrame, keys: list[str], mark) -> DataFrame:
    """The rows of docs that `decided` (doc_id, keys..., kept; narrow) keeps, row by row; mark() gives a frame with doc_id and text the columns `keys`, under new names. An id that never stays drops out by itself; only rows without an id, and those of an id with rows of both kinds, are looked up by their keys."""
    decided = saved(decided.select("doc_id", *keys, "kept"), "decided")
    some = decided.where("doc_id is not null").groupBy("doc_id").agg(F.bool_or("kept").alias("any"), F.bool_and("kept").alias("every"))
    gone = free(docs, "drop_id")
    drop = some.where("not any").select(F.col("doc_id").alias(gone))
    out = docs.join(drop, docs["doc_id"] == drop[gone], "left_anti")
    mixed = decided.join(some.where("any and not every"), "doc_id", "left_semi").unionByName(decided.where("doc_id is null")).where("not kept")
    names = [free(docs, f"drop_{k}") for k in keys]
    mixed = saved(mixed.select(F.col("doc_id").alias(gone), *[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct(), "mixed")
    if mixed.isEmpty():
        return out
    ids = mixed.where(F.col(gone).isNotNull()).select(gone).distinct()
    named = docs["doc_id"] == ids[gone]
    sure = out.where("doc_id is not null").join(ids, named, "left_anti")
    asked = mark(out.where("doc_id is null").unionByName(out.join(ids, named, "left_semi")), [free(docs, f"own_{k}") for k in keys])
    same = asked["doc_id"].eqNullSafe(mixed[gone])
    for k, n in zip(keys, names):
        same = same & (asked[free(docs, f"own_{k}")] == mixed[n])
    return sure.unionByName(asked.join(mixed, same, "left_anti").select(*docs.columns))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def steps(texts: list[bytes], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes together; a longer text stands alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = np.uint64(0xD1342543DE82EF95)
_POWER = np.ones(1 << 12, dtype=np.uint64)
np.multiply.accumulate(np.full((1 << 12) - 1, _FACTOR, dtype=np.uint64), out=_POWER[1:])


def _hash_piece(data: bytes, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = ~breaks[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    lengths = ends - starts
    where = np.flatnonzero(inside)
    offset = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = where - np.repeat(starts, lengths)
    if int(lengths.max()) > len(_POWER):  # a very long word: its position counts modulo the table, mixed with the lap
        lap = (place >> 12).astype(np.uint64)
        part = _BYTE[raw[where]] * (_POWER[place & 4095] ^ mix64(lap * np.uint64(3)))
    else:
        part = _BYTE[raw[where]] * _POWER[place]
    return mix64(np.add.reduceat(part, offset) + lengths.astype(np.uint64)), starts


#: Bytes that separate words: the white space \x20 and \x09-\x0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(text: bytes, breaks: np.ndarray = SPACES, most: int = STEP_BYTES) -> np.ndarray:
    """A 64-bit hash of each word of a text, in order. Very long texts go piece by piece, cut at a break, so that memory stays bounded."""
    if len(text) <= 2 * most:
        return _hash_piece(text, breaks)[0]
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + most)
        while end < len(text) and not breaks[text[end]]:
            end += 1
        out.append(_hash_piece(text[at:end], breaks)[0])
        at = end
    return np.concatenate(out)


def many_word_hashes(texts: list[bytes], breaks: np.ndarray = SPACES) -> list[np.ndarray]:
    """word_hashes of several texts in one vectorised pass."""
    if len(texts) == 1:
        return [word_hashes(texts[0], breaks)]
    joined = b" ".join(texts)
    hashes, starts = _hash_piece(joined, breaks)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    cut = np.searchsorted(starts, np.cumsum(lengths)[:-1])
    return np.split(hashes, cut)


def crc_mod(column: str, m: int):
    """crc32 of the id as text, modulo m."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, most: int) -> DataFrame:
    """(doc_id, text, label) of about `most` labelled documents outside the held-out rows, picked by a hash of the id. The picked ids are at most about `most` rows, so they are broadcast and no text is shuffled."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").where(crc_mod("doc_id", modulus) != held).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, most / max(1, own.count()))
    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked), "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, the intercept first, of a ridge logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w
