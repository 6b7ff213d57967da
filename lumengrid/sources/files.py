"""Small files on any file system that Spark reaches: documents, maps and pictures. Documents are written by the driver; maps and pictures by the tasks that made them."""

from __future__ import annotations

import io
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    store, p = _at(spark, path)
    return store.exists(p)


def read_json(spark: SparkSession, path: str):
    """A document, with or without a byte order mark."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0].removeprefix("﻿"))


def write_json(spark: SparkSession, path: str, document, backup: bool = False) -> None:
    """Write a document, its folder too; with backup, what was there stays beside it as <path>.bak."""
    store, p = _at(spark, path)
    if backup and store.exists(p):
        kept = _at(spark, path + ".bak")[1]
        store.delete(kept, False)
        store.rename(p, kept)
    out = store.create(p, True)
    out.write(bytearray(json.dumps(document, indent=4, ensure_ascii=False).encode()))
    out.close()


#: What folder() named in this process.
_MADE: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI in the one that all executors share (spark.checkpoint.dir; a temporary one in local mode if unset). clear() deletes it."""
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        sc.setCheckpointDir(shared)
    _MADE.append(f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to a shared folder and read back: computed once, and not again when an executor is lost."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete what folder() and written() made; for when results have been written or shown."""
    while _MADE:
        store, p = _at(spark, _MADE.pop())
        store.delete(p, True)


def target(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI or path, and the path in it."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def put(folder: str, name: str, data: bytes) -> None:
    store, base = target(folder)
    path = f"{base}/{name}"
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        out.write(data)


def write_files(rows: DataFrame, folder: str, encode: Callable[[dict], tuple[str, bytes]], keep: list[str]) -> DataFrame:
    """Write a file for each row, where the row lies; rows with `keep` and name, bytes. A repeated task writes the same names again."""
    schema = rows.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes = [], []
            for i in range(batch.num_rows):
                name, data = encode(batch.slice(i, 1).to_pylist()[0])
                put(folder, name, data)
                names.append(name), sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in keep), pa.array(names, pa.string()), pa.array(sizes, pa.int64())], [*keep, "name", "bytes"])

    return rows.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in schema), "name string, bytes long"]))


def npz(map_x: np.ndarray, map_y: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, map_x=map_x, map_y=map_y)
    return out.getvalue()
