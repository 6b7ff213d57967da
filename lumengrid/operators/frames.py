"""Frame processing: remap, crop, resize, colour lookup and bit depth, fused into one pass over frames.

The kernels are small NumPy functions inside tasks; Spark deals the frames out by camera, so that a camera's map is
loaded once for a group of its frames.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import SCHEMAS, Profile


def lanczos(t: np.ndarray) -> np.ndarray:
    """The eight Lanczos-4 weights of fractional positions, adding up to one."""
    d = t[..., None] - np.arange(-3, 5)
    w = np.sinc(d) * np.sinc(d / 4)
    return w / w.sum(axis=-1, keepdims=True)


#: Parts of a pixel to which positions are rounded, and rows of a map that are sampled together.
PARTS, TOGETHER = 32, 64
_WEIGHTS = lanczos(np.arange(PARTS) / PARTS).astype(np.float32)


def remap(image: np.ndarray, map_x: np.ndarray, map_y: np.ndarray) -> np.ndarray:
    """Sample an image at float positions, rounded to 1 / PARTS of a pixel, so that weights come from a table; outside it is black. Works through the map some rows at a time, so memory is that of the image and of these rows."""
    h, w, channels = image.shape
    rim = 8
    wide = w + 2 * rim
    padded = np.zeros((h + 2 * rim, wide, channels), dtype=np.float32)
    padded[rim:-rim, rim:-rim] = image
    flat = padded.reshape(-1, channels)
    out = np.empty((*map_x.shape, channels), dtype=np.uint8)
    for at in range(0, map_x.shape[0], TOGETHER):
        x, y = (np.rint(np.clip(np.nan_to_num(m[at : at + TOGETHER].astype(np.float64), nan=-1e6), -1e6, 1e6) * PARTS).astype(np.int64) for m in (map_x, map_y))
        near = (x >= -5 * PARTS) & (x < (w + 4) * PARTS) & (y >= -5 * PARTS) & (y < (h + 4) * PARTS)  # others see black only
        x, y = x[near], y[near]
        first = ((y // PARTS) - 3 + rim) * wide + (x // PARTS) - 3 + rim
        wx, wy = _WEIGHTS[x % PARTS], _WEIGHTS[y % PARTS]
        total = np.zeros((len(x), channels), dtype=np.float32)
        for j in range(8):
            line = np.zeros_like(total)
            for i in range(8):
                line += wx[:, i, None] * flat[first + (j * wide + i)]
            total += wy[:, j, None] * line
        band = np.zeros((*near.shape, channels), dtype=np.uint8)
        band[near] = np.clip(np.rint(total), 0, 255)
        out[at : at + TOGETHER] = band
    return out


def _area(n: int, m: int) -> np.ndarray:
    """Weights [m, n] by which n source cells cover m target cells."""
    edge = np.arange(m + 1) * (n / m)
    cover = np.minimum(edge[1:, None], np.arange(1, n + 1)) - np.maximum(edge[:-1, None], np.arange(n))
    return np.clip(cover, 0, None) * (m / n)


def resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Mean over the source area of each target pixel."""
    out = np.einsum("yh,hwc->ywc", _area(image.shape[0], height), image.astype(np.float64))
    out = np.einsum("xw,ywc->yxc", _area(image.shape[1], width), out)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def parse_cube(text: str) -> np.ndarray:
    """A .cube colour table as [blue, green, red, 3]."""
    rows, size = [], 0
    for line in text.splitlines():
        part = line.split()
        if part and part[0] == "LUT_3D_SIZE":
            size = int(part[1])
        elif len(part) == 3 and part[0].lstrip("+-").replace(".", "", 1)[:1].isdigit():
            rows.append([float(v) for v in part])
    if not size or len(rows) != size**3:
        raise ValueError(f"a colour table of size {size} needs {size**3} rows, got {len(rows)}")
    return np.array(rows).reshape(size, size, size, 3)


def look_up(image: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Colours of a BGR image through a table, by tetrahedral interpolation: along the channels in falling order of their fractions."""
    n = len(table) - 1
    pos = image[..., ::-1].astype(np.float64) / 255 * n
    base = np.minimum(np.floor(pos).astype(np.int64), n - 1)
    part = pos - base
    order = np.argsort(-part, axis=-1, kind="stable")
    ranked = np.take_along_axis(part, order, axis=-1)
    at = base.copy()
    pick = lambda p: table[p[..., 2], p[..., 1], p[..., 0]]
    out = pick(at) * (1 - ranked[..., :1])
    for k in range(3):
        np.put_along_axis(at, order[..., k : k + 1], np.take_along_axis(at, order[..., k : k + 1], -1) + 1, axis=-1)
        weight = ranked[..., k] - (ranked[..., k + 1] if k < 2 else 0)
        out += pick(at) * weight[..., None]
    return np.clip(np.rint(out[..., ::-1] * 255), 0, 255).astype(np.uint8)


def to_depth(image: np.ndarray, bits: int) -> np.ndarray:
    if bits == 8:
        return image if image.dtype == np.uint8 else np.clip(np.rint(image / 257), 0, 255).astype(np.uint8)
    if bits == 16:
        return image if image.dtype == np.uint16 else image.astype(np.uint16) * 257
    raise ValueError(f"unsupported bit depth {bits}")


def crop(image: np.ndarray, rect: dict) -> np.ndarray:
    out = image[rect["y"] : rect["y"] + rect["height"], rect["x"] : rect["x"] + rect["width"]]
    if not out.size or min(rect["x"], rect["y"]) < 0:
        raise ValueError(f"empty crop {rect}")
    return out


def process(image: np.ndarray, map_x: np.ndarray, map_y: np.ndarray, region: dict, release: dict, profile: Profile, table: np.ndarray | None) -> np.ndarray:
    """The fixed order: remap, common region, release crop, resize, colour, bit depth. Crops move no pixel, so the map is cropped, and only what is left of it is sampled."""
    maps = [crop(m, region) for m in (map_x, map_y)]
    inner = {**release, "x": release["x"] - region["x"], "y": release["y"] - region["y"]}
    out = remap(image, *(crop(m, inner) for m in maps))
    if profile.resize:
        out = resize(out, *profile.resize)
    if table is not None and profile.color_standardised:
        out = look_up(out, table)
    return to_depth(out, profile.bit_depth)


def export(frames: DataFrame, maps: DataFrame, region: dict, release: dict, profile: Profile, table: np.ndarray | None = None, spread: int = 16) -> DataFrame:
    """Frames (BGR) with their camera's map, processed.

    25 cameras are too few keys for a cluster, so a camera's frames are spread over `spread` shares, each of which gets
    a copy of the map; frames are shuffled once. A task keeps the maps that it used last.
    """
    share = F.pmod(F.col("frame_index"), F.lit(spread))
    copies = maps.select("camera_id", F.col("h").alias("mh"), F.col("w").alias("mw"), "map_x", "map_y", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_share"))
    joined = frames.withColumn("_share", share).join(copies.hint("shuffle_hash"), ["camera_id", "_share"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["camera_id"] not in held:
                    if len(held) > 3:
                        held.pop(next(iter(held)))
                    held[r["camera_id"]] = tuple(np.frombuffer(r[k], dtype="<f4").reshape(r["mh"], r["mw"]) for k in ("map_x", "map_y"))
                image = np.frombuffer(r["data"], dtype=np.uint8).reshape(r["h"], r["w"], 3)
                out = process(image, *held[r["camera_id"]], region, release, profile, table)
                yield pa.RecordBatch.from_pylist([{"scene": r["scene"], "camera_id": r["camera_id"], "frame_index": r["frame_index"], "pos_msec": r["pos_msec"], "h": out.shape[0], "w": out.shape[1], "data": out.astype("<u2" if out.dtype == np.uint16 else np.uint8).tobytes()}], schema=pa.schema([("scene", pa.string()), ("camera_id", pa.string()), ("frame_index", pa.int32()), ("pos_msec", pa.float64()), ("h", pa.int32()), ("w", pa.int32()), ("data", pa.binary())]))

    return joined.mapInArrow(run, SCHEMAS["frame"])


def border_lines(frames: DataFrame, black: int = 2, near: int = 8, band: int = 8) -> DataFrame:
    """scene, camera_id, frame_index, edge, line, black_ratio, near_ratio: the lines of a band along each edge; line 0 is the border itself for top and left, the last one for bottom and right. Only ratios leave a task, never pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                image = np.frombuffer(r["data"], dtype=np.uint8).reshape(r["h"], r["w"], 3)
                for edge, strip, axis in (("top", image[:band], 1), ("bottom", image[-band:], 1), ("left", image[:, :band], 0), ("right", image[:, -band:], 0)):
                    dark, grey = ((strip <= t).all(axis=2).mean(axis=axis) for t in (black, near))
                    out.extend({"scene": r["scene"], "camera_id": r["camera_id"], "frame_index": r["frame_index"], "edge": edge, "line": i, "black_ratio": float(d), "near_ratio": float(g)} for i, (d, g) in enumerate(zip(dark, grey)))
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("scene", pa.string()), ("camera_id", pa.string()), ("frame_index", pa.int32()), ("edge", pa.string()), ("line", pa.int32()), ("black_ratio", pa.float64()), ("near_ratio", pa.float64())]))

    return frames.mapInArrow(run, "scene string, camera_id string, frame_index int, edge string, line int, black_ratio double, near_ratio double")


def contact_sheet(frames: DataFrame, columns: int = 5) -> DataFrame:
    """scene, frame_index, h, w, data: the views of a frame side by side in camera order; one group is one frame's views, at most 25."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["camera_id"])
        own = [np.frombuffer(r["data"], dtype=np.uint8).reshape(r["h"], r["w"], 3) for r in rows]
        own += [np.zeros_like(own[0])] * (-len(own) % columns)
        sheet = np.vstack([np.hstack(own[i : i + columns]) for i in range(0, len(own), columns)])
        return pa.table({"scene": [rows[0]["scene"]], "frame_index": pa.array([rows[0]["frame_index"]], pa.int32()), "h": pa.array([sheet.shape[0]], pa.int32()), "w": pa.array([sheet.shape[1]], pa.int32()), "data": [sheet.tobytes()]})

    return frames.groupBy("scene", "frame_index").applyInArrow(run, "scene string, frame_index int, h int, w int, data binary")


def sheets(frames: DataFrame) -> DataFrame:
    """Contact sheets of every frame: all views, each row and each column of the grid (sheet: grid, row_A, col_1, ...); one group is a sheet's views, at most 25."""
    own = F.explode(F.array(F.lit("grid"), F.concat(F.lit("row_"), F.substring("camera_id", 5, 1)), F.concat(F.lit("col_"), F.substring("camera_id", 6, 1)))).alias("sheet")
    named = frames.select("scene", own, "camera_id", "frame_index", "h", "w", "data")
    out = contact_sheet(named.where("sheet not like 'col%'").withColumn("scene", F.concat_ws("\u0001", "scene", "sheet")), 5).unionByName(contact_sheet(named.where("sheet like 'col%'").withColumn("scene", F.concat_ws("\u0001", "scene", "sheet")), 1))
    parts = F.split("scene", "\u0001")
    return out.select(parts[0].alias("scene"), parts[1].alias("sheet"), "frame_index", "h", "w", "data")


def rectification_map(k: np.ndarray, rotation: np.ndarray, p: np.ndarray, width: int, height: int) -> tuple[np.ndarray, np.ndarray]:
    """The source pixel of each output pixel, without distortion: K R^-1 P^-1, as 32-bit floats."""
    m = k @ np.linalg.inv(rotation) @ np.linalg.inv(p)
    y, x = np.mgrid[0:height, 0:width].astype(np.float64)
    u, v, w = (m[i, 0] * x + m[i, 1] * y + m[i, 2] for i in range(3))
    return (u / w).astype("<f4"), (v / w).astype("<f4")


def _maps(r: dict) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(r[k], dtype="<f4").reshape(r["h"], r["w"]) for k in ("map_x", "map_y"))


def mask_words(maps: DataFrame, width: int, height: int, margin: float) -> DataFrame:
    """Words (camera_id, y, block, bits; see operators.roi) of the pixels that lie inside the source by a margin, made where the map lies, some rows at a time."""
    kind = "camera_id string, y int, block int, bits long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                x, y = _maps(r)
                blocks = -(-r["w"] // 64)
                for at in range(0, r["h"], 256):
                    u, v = x[at : at + 256], y[at : at + 256]
                    ok = np.zeros((len(u), blocks * 64), dtype=bool)
                    ok[:, : r["w"]] = (u >= margin) & (u <= width - 1 - margin) & (v >= margin) & (v <= height - 1 - margin)
                    bits = np.packbits(ok, axis=1, bitorder="little").view("<i8")
                    rows, places = np.divmod(np.arange(bits.size), blocks)
                    yield pa.RecordBatch.from_pydict({"camera_id": [r["camera_id"]] * bits.size, "y": pa.array(rows + at, pa.int32()), "block": pa.array(places, pa.int32()), "bits": pa.array(bits.ravel(), pa.int64())})

    return maps.mapInArrow(run, kind)


def rim_pixels(maps: DataFrame, crop: dict) -> DataFrame:
    """camera_id, y, x, map_x, map_y of the pixels on a crop's four edges."""
    x0, y0, x1, y1 = crop["x"], crop["y"], crop["x"] + crop["width"] - 1, crop["y"] + crop["height"] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                mx, my = _maps(r)
                xs, ys = np.arange(x0, x1 + 1), np.arange(y0, y1 + 1)
                at = np.unique(np.concatenate([np.stack([np.full_like(xs, y0), xs], 1), np.stack([np.full_like(xs, y1), xs], 1), np.stack([ys, np.full_like(ys, x0)], 1), np.stack([ys, np.full_like(ys, x1)], 1)]), axis=0)
                y, x = at.T
                yield pa.RecordBatch.from_pydict({"camera_id": [r["camera_id"]] * len(at), "y": pa.array(y, pa.int32()), "x": pa.array(x, pa.int32()), "map_x": pa.array(mx[y, x].astype(np.float64)), "map_y": pa.array(my[y, x].astype(np.float64))})

    return maps.mapInArrow(run, "camera_id string, y int, x int, map_x double, map_y double")


def rim_ratios(frames: DataFrame, black: int = 2, near: int = 8) -> DataFrame:
    """scene, camera_id, frame_index, edge, black_ratio, near_ratio of the outermost line of each edge."""
    return border_lines(frames, black, near, 1).drop("line")


def at_times(frames: DataFrame, samples: DataFrame) -> DataFrame:
    """The first frame of each camera at or after a sample's time (scene, segment_index, position, t), else the last one before. Only frame numbers are compared; a sample's frame then is fetched."""
    keys = ["scene", "segment_index", "position"]
    near = frames.select("scene", "camera_id", "frame_index", (F.col("pos_msec") / 1000).alias("at")).join(samples, "scene")
    late = F.col("at") >= F.col("t")
    picked = near.groupBy(*keys, "camera_id").agg(F.coalesce(F.min_by("frame_index", F.when(late, F.col("at"))), F.max_by("frame_index", F.when(~late, F.col("at")))).alias("frame_index"))
    return frames.join(picked.select("scene", "camera_id", "frame_index").distinct(), ["scene", "camera_id", "frame_index"], "left_semi")


def by_index(frames: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted frames (scene, camera_id, frame_index) with their data; those that aren't there have the reason read_failed."""
    rows = wanted.join(frames, ["scene", "camera_id", "frame_index"], "left")
    return rows.withColumn("reason", F.when(F.col("data").isNull(), "read_failed"))
