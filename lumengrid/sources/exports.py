"""Exported scenes on a file system: <root>/<scene>/view_00/000001.png, view_metadata.json, .in_progress, and <scene>/metadata.json.

Reading. Tasks list the folders of their scenes; the driver sees no path. Frames are opened by what is wanted of them:
`opened` reads exactly the files of a plan's rows, and the data source "frame_files" plans its partitions by scene and
view from its options or the filters pushed to it, so that what isn't asked for is neither listed nor opened.

Writing. The data source "frame_sink" commits in two phases. Task attempts write to folders of their own below
<root>/.parts/<job>/<attempt>; nothing appears in a scene's folder. Spark takes one attempt of each task, and the commit
writes down which. Only then publish() moves those attempts' files to their names, in tasks, each view under a marker
(.in_progress); settle() removes the markers once the views' documents are there. An attempt that is killed, a
speculative copy, and a failed job leave files below .parts only, which abort and recover() delete.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage

from ..functions.media import camera_of, view_id
from ..model import CAMERAS, cameras
from . import media
from .files import put, target

#: Names of an export's files (fixed values).
VIEW_DOCUMENT, SCENE_DOCUMENT, MARKER = "view_metadata.json", "metadata.json", ".in_progress"
VIEWS = [f"view_{i:02d}" for i in range(len(CAMERAS))]
PARTS = ".parts"

# ---------------------------------------------------------------- listing

_LISTED = pa.schema([("scene", pa.string()), ("view_id", pa.string()), ("name", pa.string()), ("place", pa.int32()), ("width", pa.int32()), ("height", pa.int32())])
LISTED = "scene string, view_id string, name string, place int, width int, height int"


def is_frame(name: str) -> bool:
    return name.lower().endswith((".jpg", ".png"))


def _names(store: fs.FileSystem, folder: str) -> list[tuple[str, bool]]:
    """(name, whether it is a folder) of what a folder holds, hidden names too, by name; nothing if it isn't there."""
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f.base_name, f.type == fs.FileType.Directory) for f in found)


def _size(store: fs.FileSystem, path: str) -> tuple[int | None, int | None]:
    """What a view's document tells of the frames' size; nothing if it can't be read."""
    try:
        with store.open_input_stream(path) as f:
            w, h = json.loads(f.read())["output_resolution"]
        return int(w), int(h)
    except (OSError, ValueError, KeyError, TypeError):
        return None, None


def _view_rows(store: fs.FileSystem, base: str, scene: str, view: str) -> Iterator[tuple]:
    yield scene, view, None, None, None, None
    place = 0
    for name, folder in _names(store, f"{base}/{scene}/{view}"):
        frame = is_frame(name) and not folder
        place += frame
        yield (scene, view, name, place if frame else None, *(_size(store, f"{base}/{scene}/{view}/{name}") if name == VIEW_DOCUMENT else (None, None)))


def _batches(rows: Iterator[tuple], most: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _LISTED)], schema=_LISTED)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _LISTED)], schema=_LISTED)


def scene_folders(spark: SparkSession, root: str, scene: str | None = None) -> DataFrame:
    """(scene) below root, listed by a task; hidden folders aren't scenes. With `scene`, that one, whether or not it is there."""
    if scene is not None:
        return spark.createDataFrame([(scene,)], "scene string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = target(root)
        for _ in batches:
            own = [n for n, folder in _names(store, base) if folder and not n.startswith(".")]
            for i in range(0, len(own), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(own[i : i + 20_000], pa.string())], ["scene"])

    return spark.range(1, numPartitions=1).mapInArrow(run, "scene string")


def listing(spark: SparkSession, root: str, scene: str | None = None) -> DataFrame:
    """All that scenes' folders hold, listed by tasks: a row for each scene (no view), for the scene's document, for each view (no name), and for each file of a view; `place` numbers a view's frames from 1 by name, and the view's document tells width and height."""

    def rows(scene: str) -> Iterator[tuple]:
        store, base = target(root)
        yield scene, None, None, None, None, None
        for name, folder in _names(store, f"{base}/{scene}"):
            if folder and name.startswith("view_"):
                yield from _view_rows(store, base, scene, name)
            elif name == SCENE_DOCUMENT:
                yield scene, None, name, None, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(r for batch in batches for s in batch.column(0).to_pylist() for r in rows(s))

    return scene_folders(spark, root, scene).repartition(_parts(spark), "scene").mapInArrow(run, LISTED)


def _parts(spark: SparkSession) -> int:
    """Partitions for work whose rows are few but heavy, which Spark would put together."""
    return 4 * spark.sparkContext.defaultParallelism


def inventory(listed: DataFrame) -> DataFrame:
    """A row for each scene and each of the 25 views: scene, camera_id, dir_exists, in_progress, has_view_metadata, frame_files, width, height. Counts are made where the listing lies."""
    grid = F.broadcast(cameras(listed.sparkSession).select(view_id(F.col("camera_id")).alias("view_id"), "camera_id"))
    per = listed.where("view_id is not null").groupBy("scene", "view_id").agg(F.lit(True).alias("dir_exists"), F.coalesce(F.bool_or(F.col("name") == MARKER), F.lit(False)).alias("in_progress"), F.coalesce(F.bool_or(F.col("name") == VIEW_DOCUMENT), F.lit(False)).alias("has_view_metadata"), F.count("place").cast("int").alias("frame_files"), F.max("width").alias("width"), F.max("height").alias("height"))
    every = listed.select("scene").distinct().join(grid, F.lit(True)).join(per, ["scene", "view_id"], "left")
    return every.fillna({"dir_exists": False, "in_progress": False, "has_view_metadata": False, "frame_files": 0}).drop("view_id")


def lacking(listed: DataFrame) -> DataFrame:
    """(scene, fault) of scenes without their document."""
    told = listed.groupBy("scene").agg(F.coalesce(F.bool_or(F.col("view_id").isNull() & (F.col("name") == SCENE_DOCUMENT)), F.lit(False)).alias("_told"))
    return told.where("not _told").select("scene", F.lit("missing_metadata").alias("fault"))


def frame_names(listed: DataFrame) -> DataFrame:
    """scene, camera_id, frame_index (from 0), view_id, name of all frames of the grid's views."""
    return listed.where(F.col("place").isNotNull() & F.col("view_id").isin(VIEWS)).select("scene", camera_of(F.substring("view_id", 6, 2).cast("int")).alias("camera_id"), (F.col("place") - 1).cast("int").alias("frame_index"), "view_id", "name")


# ---------------------------------------------------------------- frames


def _unfiltered(raw: np.ndarray, step: int) -> np.ndarray:
    """Bytes of a PNG's rows [h, 1 + n] without the row filters that their first bytes name; `step` bytes a pixel."""
    out = np.zeros((len(raw), raw.shape[1] - 1), dtype=np.uint8)
    above = np.zeros(out.shape[1], dtype=np.uint8)
    for y, row in enumerate(raw):
        kind, line = row[0], row[1:]
        if kind == 1:
            line = np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint64).astype(np.uint8).ravel()
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            line = line.astype(np.int64)
            for i in range(len(line)):
                a, b = (int(line[i - step]) if i >= step else 0), int(above[i])
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    c = int(above[i - step]) if i >= step else 0
                    guess = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                line[i] = (line[i] + guess) & 255
            line = line.astype(np.uint8)
        out[y] = above = line
    return out


def read_png(data: bytes) -> np.ndarray:
    """The 8-bit BGR image of a PNG of grey values or colours of 8 or 16 bits; an alpha channel is dropped."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, head = 8, [], None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        at += size + 12
    w, h, bits, colour, _, _, laced = head or (0, 0, 0, 0, 0, 0, 1)
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if laced or bits not in (8, 16) or channels is None:
        raise ValueError("this kind of PNG isn't read")
    step = channels * bits // 8
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8).reshape(h, 1 + w * step)
    image = _unfiltered(raw, step).reshape(h, w, channels, bits // 8)
    image = image[..., 0] if bits == 8 else np.rint((image[..., 0].astype(np.uint16) * 256 + image[..., 1]) / 257).astype(np.uint8)
    return np.ascontiguousarray(image[..., 2::-1] if channels > 2 else np.repeat(image[..., :1], 3, axis=2))


def _open(store: fs.FileSystem, path: str) -> bytes:
    with store.open_input_stream(path, compression=None) as f:
        return f.read()


def _decoded(store: fs.FileSystem, path: str) -> tuple[int | None, int | None, bytes | None, str | None]:
    try:
        image = read_png(_open(store, path))
        return image.shape[0], image.shape[1], image.tobytes(), None
    except (OSError, ValueError, zlib.error, struct.error) as e:
        return None, None, None, f"{type(e).__name__}: {e}"[:200]


#: Names of JPEGs that one pattern lists.
MOST_NAMES = 1000


def opened(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """The frames of `wanted` (scene, camera_id, frame_index, view_id, name) with h, w, data and, for one that can't be read, the reason. Each row's file is opened, by the task that holds the row, and no other. PNGs are decoded in the task; JPEGs by Spark's image source, which is given the wanted names only, up to MOST_NAMES different ones."""
    keys = ["scene", "camera_id", "frame_index"]
    png = F.lower("name").endswith(".png")
    kind = "scene string, camera_id string, frame_index int, h int, w int, data binary, reason string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = target(root)
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                h, w, data, reason = _decoded(store, f"{base}/{r['scene']}/{r['view_id']}/{r['name']}")
                yield pa.RecordBatch.from_pylist([{**{k: r[k] for k in keys}, "h": h, "w": w, "data": data, "reason": reason}], schema=pa.schema([("scene", pa.string()), ("camera_id", pa.string()), ("frame_index", pa.int32()), ("h", pa.int32()), ("w", pa.int32()), ("data", pa.binary()), ("reason", pa.string())]))

    own = wanted.select(*keys, "view_id", "name")
    out = own.where(png).repartition(_parts(spark), *keys).mapInArrow(run, kind)
    names = [r.name for r in own.where(~png).select("name").distinct().limit(MOST_NAMES + 1).collect()]  # a sampling plan asks for some names for each number of frames
    if not names:
        return out
    if len(names) > MOST_NAMES:  # then all are read, and the wanted ones kept
        names = ["*.[jJ][pP][gG]"]
    parts = F.split("path", "/")
    read = media.images(spark, f"{root}/*/view_*/{{{','.join(sorted(names))}}}")
    read = read.select(F.element_at(parts, -3).alias("scene"), F.element_at(parts, -2).alias("view_id"), F.element_at(parts, -1).alias("name"), "h", "w", "data")
    jpg = own.where(~png).join(read, ["scene", "view_id", "name"], "left")
    good = F.coalesce(F.col("h") > 0, F.lit(False))
    value = lambda c: F.when(good, F.col(c)).alias(c)
    return out.unionByName(jpg.select(*keys, value("h"), value("w"), value("data"), F.when(~good, F.lit("unreadable")).alias("reason")))


@dataclass
class _View(InputPartition):
    scene: str
    view: str
    share: int = 0
    shares: int = 1

    def __post_init__(self) -> None:
        super().__init__(None)


@dataclass
class _Wanted:
    """What filters leave: sets of scenes and views, and bounds or a set of frame numbers."""

    scenes: set | None = None
    views: set | None = None
    frames: set | None = None
    least: int = 0
    most: int | None = None

    def take(self, f: Filter) -> bool:
        """Whether the filter is met from now on."""
        if isinstance(f, IsNotNull):
            return len(f.attribute) == 1 and f.attribute[0] in ("scene", "view_id", "camera_id", "frame_index")  # never null
        if isinstance(f, (EqualTo, EqualNullSafe, In)) and len(f.attribute) == 1:
            values = set(f.value if isinstance(f, In) else [f.value])
            name = f.attribute[0]
            if name == "camera_id":
                name, values = "view_id", {VIEWS[CAMERAS.index(c)] for c in values if c in CAMERAS}
            at = {"scene": "scenes", "view_id": "views", "frame_index": "frames"}.get(name)
            if at is None:
                return False
            own = getattr(self, at)
            setattr(self, at, values if own is None else own & values)
            return True
        if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("frame_index",):
            self.least = max(self.least, f.value + isinstance(f, GreaterThan))
            return True
        if isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute == ("frame_index",):
            bound = f.value - isinstance(f, LessThan)
            self.most = bound if self.most is None else min(self.most, bound)
            return True
        return False

    def fits(self, frame: int) -> bool:
        return frame >= self.least and (self.most is None or frame <= self.most) and (self.frames is None or frame in self.frames)


class FrameReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.shares = options["path"], int(options.get("shares", 1))
        self.wanted = _Wanted()
        for name in ("scene", "camera_id", "frame_index"):
            if options.get(name):
                self.wanted.take(In((name,), tuple(json.loads(options[name]))))

    def partitions(self) -> list[_View]:
        """A partition for each wanted scene and view (and share of its frames). The root is listed only if no filter names scenes."""
        scenes = self.wanted.scenes
        if scenes is None:
            store, base = target(self.root)
            scenes = {n for n, folder in _names(store, base) if folder and not n.startswith(".")}
        views = [v for v in VIEWS if self.wanted.views is None or v in self.wanted.views]
        return [_View(s, v, i, self.shares) for s in sorted(x for x in scenes if x is not None) for v in views for i in range(self.shares)]

    def read(self, partition: _View) -> Iterator[pa.RecordBatch]:
        store, base = target(self.root)
        folder = f"{base}/{partition.scene}/{partition.view}"
        names = [n for n, inner in _names(store, folder) if is_frame(n) and not inner]
        camera = CAMERAS[VIEWS.index(partition.view)]
        for i, name in enumerate(names):
            if i % partition.shares == partition.share and self.wanted.fits(i):
                h, w, data, reason = _decoded(store, f"{folder}/{name}")
                yield pa.RecordBatch.from_pylist([{"scene": partition.scene, "view_id": partition.view, "camera_id": camera, "frame_index": i, "name": name, "h": h, "w": w, "data": data, "reason": reason}], schema=_FRAME)


class PushedFrameReader(FrameReader):
    """A reader that takes Spark's filters too."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if not self.wanted.take(f):
                yield f


_FRAME = pa.schema([("scene", pa.string()), ("view_id", pa.string()), ("camera_id", pa.string()), ("frame_index", pa.int32()), ("name", pa.string()), ("h", pa.int32()), ("w", pa.int32()), ("data", pa.binary()), ("reason", pa.string())])


class FrameFiles(DataSource):
    """spark.read.format("frame_files").load(root): all exported frames. The options scene, camera_id and frame_index (JSON lists) decide what is listed and opened, and `shares` splits a view's frames over so many tasks. With the option pushdown (and spark.sql.python.filterPushdown.enabled), filters on these columns do the same; Spark 4.1 then keeps the pruned partitions for later queries of the same loaded DataFrame, so load it anew for each."""

    @classmethod
    def name(cls) -> str:
        return "frame_files"

    def schema(self) -> str:
        return "scene string, view_id string, camera_id string, frame_index int, name string, h int, w int, data binary, reason string"

    def reader(self, schema) -> FrameReader:
        return (PushedFrameReader if self.options.get("pushdown") == "true" else FrameReader)(self.options)


def frame_files(spark: SparkSession, root: str, scenes: list[str] | None = None, cameras: list[str] | None = None, frames: list[int] | None = None, shares: int = 1) -> DataFrame:
    """Exported frames below root; of some scenes, cameras and frame numbers only, if given."""
    spark.dataSource.register(FrameFiles)
    asked = {"scene": scenes, "camera_id": cameras, "frame_index": frames}
    shared = {"shares": shares, "pushdown": spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")}
    return spark.read.format("frame_files").options(**shared, **{k: json.dumps(v) for k, v in asked.items() if v is not None}).load(root)


# ---------------------------------------------------------------- sink


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: the folder of its attempt, and by scene and view the number of frames and their size."""

    attempt: str = ""
    views: dict = field(default_factory=dict)


class FrameWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.root, self.job = options["path"], options["job"]
        self.level, self.bits = int(options.get("level", 1)), int(options.get("bits", 8))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Frames (scene, view_id, number, h, w, data) to PNGs in a folder that no other attempt writes to."""
        context = TaskContext.get()
        out = Written(f"{context.partitionId()}-{context.taskAttemptId()}")
        base = f"{self.root}/{PARTS}/{self.job}/{out.attempt}"
        for batch in iterator:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                image = np.frombuffer(r["data"], dtype="<u2" if self.bits == 16 else np.uint8).reshape(r["h"], r["w"], 3)
                put(base, f"{r['scene']}/{r['view_id']}/{r['number']:06d}.png", media.png(image, self.level))
                own = out.views.setdefault((r["scene"], r["view_id"]), [0, r["h"], r["w"]])
                own[0] += 1
                own[1], own[2] = max(own[1], r["h"]), max(own[2], r["w"])
        return out

    def commit(self, messages: list[Written | None]) -> None:
        """Write down the attempts that count, a line for each view of each; the file appears whole or not at all."""
        lines = [json.dumps({"attempt": m.attempt, "scene": s, "view_id": v, "n": n, "height": h, "width": w}, ensure_ascii=False) for m in messages if m is not None for (s, v), (n, h, w) in m.views.items()]
        folder = f"{self.root}/{PARTS}/{self.job}"
        put(folder, "committed.tmp", "\n".join(lines).encode())
        store, base = target(folder)
        store.move(f"{base}/committed.tmp", f"{base}/committed.json")

    def abort(self, messages: list[Written | None]) -> None:
        drop(f"{self.root}/{PARTS}/{self.job}")


class FrameSink(DataSource):
    """df.write.format("frame_sink").option("job", ...).mode("append").save(root) for rows (scene, view_id, number, h, w, data)."""

    @classmethod
    def name(cls) -> str:
        return "frame_sink"

    def schema(self) -> str:
        return "scene string, view_id string, number int, h int, w int, data binary"

    def writer(self, schema, overwrite: bool) -> FrameWriter:
        return FrameWriter(self.options)


def drop(folder: str) -> None:
    store, base = target(folder)
    if store.get_file_info(base).type == fs.FileType.Directory:
        store.delete_dir(base)


def write_frames(frames: DataFrame, root: str, job: str, bits: int = 8, level: int = 1) -> DataFrame:
    """Write frames (scene, view_id, number, h, w, data), first phase; what was committed: attempt, scene, view_id, n, height, width."""
    spark = frames.sparkSession
    spark.dataSource.register(FrameSink)
    frames.select("scene", "view_id", F.col("number").cast("int").alias("number"), "h", "w", "data").write.format("frame_sink").options(job=job, bits=bits, level=level).mode("append").save(root)
    return committed(spark, root, job)


def committed(spark: SparkSession, root: str, job: str) -> DataFrame:
    return spark.read.schema("attempt string, scene string, view_id string, n long, height int, width int").json(f"{root}/{PARTS}/{job}/committed.json")


def _move(store: fs.FileSystem, source: str, to: str) -> None:
    """Move a file; a copy of this task may have done so already."""
    try:
        store.move(source, to)
    except FileNotFoundError:
        if store.get_file_info(to).type != fs.FileType.File:
            raise


def publish(root: str, job: str, won: DataFrame) -> DataFrame:
    """Second phase: move the frames of attempts that count to their views' folders, under a marker; scene, view_id, frame_count, width, height. May be run again: what has been moved stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = target(root)
        for batch in batches:
            for r in batch.to_pylist():
                to, source = f"{r['scene']}/{r['view_id']}", f"{base}/{PARTS}/{job}/{r['attempt']}/{r['scene']}/{r['view_id']}"
                put(root, f"{to}/{MARKER}", b"")
                for name, _ in _names(store, source):
                    _move(store, f"{source}/{name}", f"{base}/{to}/{name}")
            yield batch

    rows = won.repartition(_parts(won.sparkSession), "scene", "view_id", "attempt").mapInArrow(run, won.schema)
    return rows.groupBy("scene", "view_id").agg(F.sum("n").cast("int").alias("frame_count"), F.max("width").alias("width"), F.max("height").alias("height"))


def settle(root: str, views: DataFrame) -> int:
    """Remove the markers of views (scene, view_id) that are complete; their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = target(root)
        for batch in batches:
            for r in batch.to_pylist():
                path = f"{base}/{r['scene']}/{r['view_id']}/{MARKER}"
                if store.get_file_info(path).type == fs.FileType.File:
                    store.delete_file(path)
            yield batch

    rows = views.select("scene", "view_id")
    return rows.mapInArrow(run, rows.schema).count()


def recover(spark: SparkSession, root: str) -> int:
    """Undo what jobs left that ended early: scenes that were being published and have no document, and all private files. Tasks delete the scenes; their number. No other job may write to root meanwhile."""
    store, base = target(root)
    undone = 0
    for job, folder in _names(store, f"{base}/{PARTS}"):
        if folder and store.get_file_info(f"{base}/{PARTS}/{job}/committed.json").type == fs.FileType.File:

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                own, at = target(root)
                for batch in batches:
                    half = [s for s in batch.column(0).to_pylist() if own.get_file_info(f"{at}/{s}").type == fs.FileType.Directory and own.get_file_info(f"{at}/{s}/{SCENE_DOCUMENT}").type != fs.FileType.File]
                    for s in half:
                        own.delete_dir(f"{at}/{s}")
                    yield pa.RecordBatch.from_arrays([pa.array(half, pa.string())], ["scene"])

            undone += committed(spark, root, job).select("scene").distinct().mapInArrow(run, "scene string").count()
    drop(f"{root}/{PARTS}")
    return undone
