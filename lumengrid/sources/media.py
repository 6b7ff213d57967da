"""Binary inputs: rectification maps, raw audio, frames, and listings of files. All bytes come through Spark's binaryFile reader."""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import SCHEMAS


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, length of files below a folder. Contents aren't read: only metadata columns are selected."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def frame_files(files: DataFrame) -> DataFrame:
    """scene, view, name, and the frame's place in its view (1-based, by name) from paths .../scene/view/name."""
    from pyspark.sql import Window

    parts = F.split("path", "/")
    rows = files.where(F.lower("name").rlike(r"\.(jpg|png)$")).select(F.element_at(parts, -3).alias("scene"), F.element_at(parts, -2).alias("view_id"), "name")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("scene", "view_id").orderBy("name")))


def videos_of(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each wanted (camera_id, name), the file of that name, else of the name in lower, else in upper suffix case."""
    parts = F.split("path", "/")
    have = files.select(F.element_at(parts, -2).alias("camera_id"), F.col("name").alias("found"), "path")
    joined = wanted.join(have, "camera_id").where(F.lower("name") == F.lower("found"))
    rank = F.when(F.col("name") == F.col("found"), 0).when(F.col("found").endswith(".mp4"), 1).otherwise(2)
    best = joined.groupBy("camera_id", "name").agg(F.min_by("path", F.struct(rank, "path")).alias("path"))
    return wanted.join(best, ["camera_id", "name"], "left")


def master_videos(files: DataFrame, review: DataFrame | None = None) -> DataFrame:
    """Videos by name without regard to case, each once; only scenes under review if given."""
    rows = files.where(F.lower("name").endswith(".mp4")).dropDuplicates(["name"])
    if review is not None:
        rows = rows.join(review.select(F.lower("scene").alias("_k")).distinct(), F.lower("name") == F.col("_k"), "left_semi")
    return rows.orderBy(F.lower("name"), "name")


def rect_maps(spark: SparkSession, path: str) -> DataFrame:
    """camera_id, h, w, map_x, map_y (32-bit floats, row by row) of .npz files named <camera>_rect_map.npz."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                maps = np.load(io.BytesIO(content))
                x, y = (np.ascontiguousarray(maps[k], dtype="<f4") for k in ("map_x", "map_y"))
                yield pa.RecordBatch.from_pylist([{"camera_id": path.rsplit("/", 1)[-1][:6], "h": x.shape[0], "w": x.shape[1], "map_x": x.tobytes(), "map_y": y.tobytes()}], schema=pa.schema([("camera_id", pa.string()), ("h", pa.int32()), ("w", pa.int32()), ("map_x", pa.binary()), ("map_y", pa.binary())]))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*_rect_map.npz").load(path)
    return files.select("path", "content").mapInArrow(run, SCHEMAS["rect_map"])


def raw_audio(spark: SparkSession, path: str, seconds: float = 10.0, rate: int = 48_000) -> DataFrame:
    """scene, camera_id, samples of raw 32-bit mono files .../camera/scene.f32; empty files have null samples. Only the analysed seconds are kept."""
    parts = F.split("path", "/")

    @F.arrow_udf("array<float>")
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        most = int(seconds * rate)
        for column in columns:
            yield pa.array([np.frombuffer(b, dtype="<f4", count=min(most, len(b) // 4)) if b and len(b) >= 4 else None for b in column.to_pylist()], pa.list_(pa.float32()))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.f32").load(path)
    return files.select(F.regexp_replace(F.element_at(parts, -1), r"\.f32$", "").alias("scene"), F.element_at(parts, -2).alias("camera_id"), decode("content").alias("samples"))


def images(spark: SparkSession, path: str) -> DataFrame:
    """path, h, w, data (BGR, 8 bits) by Spark's image source."""
    return spark.read.format("image").load(path).select(F.col("image.origin").alias("path"), F.col("image.height").alias("h"), F.col("image.width").alias("w"), F.col("image.data").alias("data"))


def png(image: np.ndarray, level: int = 1) -> bytes:
    """A PNG of a BGR image of 8 or 16 bits."""
    rows = np.ascontiguousarray(image[:, :, ::-1].astype(">u2" if image.dtype == np.uint16 else np.uint8))
    h, w = rows.shape[:2]
    raw = np.zeros((h, 1 + rows[0].nbytes), dtype=np.uint8)
    raw[:, 1:] = rows.view(np.uint8).reshape(h, -1)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, rows.itemsize * 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + chunk(b"IEND", b"")
