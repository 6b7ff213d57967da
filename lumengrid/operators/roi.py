"""Regions of interest: valid pixels, rectangles, crops and margins.

Pixel tables are long: camera_id, y, x, map_x, map_y. Masks are words: camera_id, y, block, bits, where bit i of the long
`bits` tells whether pixel x = 64 * block + i of row y is valid. Words of cameras are combined by bit_and, which Spark
aggregates partially; boxes are read from words; the largest rectangle is searched by bands of rows, in parallel. So no
task, group or driver holds an image.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import media


def valid(map_x: Column, map_y: Column, width: int, height: int, margin: float) -> Column:
    return map_x.between(float(margin), float(width - 1 - margin)) & map_y.between(float(margin), float(height - 1 - margin))


#: Pixels of a word, and rows of a band.
WORD, BAND = 64, 64


def words(pixels: DataFrame, width: int, height: int, margin: float) -> DataFrame:
    """Valid pixels as words (camera_id, y, block, bits); those of a pixel that occurs twice must both be valid."""
    ok = valid(F.col("map_x"), F.col("map_y"), width, height, margin)
    bit = F.expr(f"shiftleft(1L, cast(x % {WORD} as int))")
    here, bad = F.bit_or(F.when(ok, bit)), F.bit_or(F.when(~F.coalesce(ok, F.lit(False)), bit))
    zero = F.lit(0).cast("long")
    out = pixels.groupBy("camera_id", "y", F.expr(f"x div {WORD}").alias("block")).agg(here.alias("_in"), bad.alias("_out"))
    return out.select("camera_id", "y", "block", F.coalesce("_in", zero).bitwiseAND(F.bitwise_not(F.coalesce("_out", zero))).alias("bits"))


def common_words(masks: DataFrame) -> DataFrame:
    """(y, block, bits): the pixels that are valid in every camera."""
    return masks.groupBy("y", "block").agg(F.bit_and("bits").alias("bits"))


def common_mask(pixels: DataFrame, width: int, height: int, margin: float) -> DataFrame:
    """(y, x, ok): whether a pixel is valid in every camera."""
    return pixels.groupBy("y", "x").agg(F.bool_and(valid(F.col("map_x"), F.col("map_y"), width, height, margin)).alias("ok"))


def blind_cameras(masks: DataFrame) -> DataFrame:
    """Cameras without a valid pixel; any is an error."""
    return masks.groupBy("camera_id").agg(F.bit_or("bits").alias("any")).where("any = 0").select("camera_id")


def bounding_box(common: DataFrame) -> DataFrame:
    """The box around the set bits of words, by the length of their binary texts without and with the zeros at the end; nulls without a set bit."""
    some = common.where("bits <> 0")
    low, high = F.expr(f"block * {WORD} + length(bin(bits)) - length(rtrim('0', bin(bits)))"), F.expr(f"block * {WORD} + length(bin(bits)) - 1")
    box = some.agg(F.min(low).alias("x"), F.min("y").alias("y"), (F.max(high) + 1 - F.min(low)).alias("width"), (F.max("y") + 1 - F.min("y")).alias("height"))
    return box.select(*[F.col(c).cast("int").alias(c) for c in ("x", "y", "width", "height")])


def intersection(rects: DataFrame) -> DataFrame:
    """The intersection of all rectangles (x, y, w, h); its width or height isn't positive if they have none."""
    x, y = F.max("x"), F.max("y")
    return rects.agg(x.alias("x"), y.alias("y"), (F.min(F.col("x") + F.col("w")) - x).alias("width"), (F.min(F.col("y") + F.col("h")) - y).alias("height"))


def crops(rects: DataFrame) -> DataFrame:
    """Rectangles (struct rect) with their 16:9 crop and what must hold of it."""
    out = rects.withColumn("crop", media.crop_16_9(F.col("rect")))
    return out.withColumns({"crop_inside": media.inside(F.col("crop"), F.col("rect")), "crop_exact": media.is_16_9(F.col("crop"))})


def margins(pixels: DataFrame, crop: dict, width: int, height: int) -> DataFrame:
    """The least distance to the source's border on each edge of a crop, per camera and edge, per camera, and over all (nulls mark the sums)."""
    x0, y0 = crop["x"], crop["y"]
    x1, y1 = x0 + crop["width"] - 1, y0 + crop["height"] - 1
    safety = F.least(F.col("map_x"), F.col("map_y"), F.lit(width - 1) - F.col("map_x"), F.lit(height - 1) - F.col("map_y"))
    edges = F.array_compact(F.array(F.when(F.col("y") == y0, F.lit("top")), F.when(F.col("y") == y1, F.lit("bottom")), F.when(F.col("x") == x0, F.lit("left")), F.when(F.col("x") == x1, F.lit("right"))))
    rim = pixels.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).where(F.col("x").isin(x0, x1) | F.col("y").isin(y0, y1))
    return rim.select("camera_id", F.explode(edges).alias("edge"), safety.alias("safety")).rollup("camera_id", "edge").agg(F.min("safety").alias("min_margin"))


def rectangle(mask: np.ndarray, above: np.ndarray | None = None) -> tuple[int, int, int, int] | None:
    """(x, y, width, height) of a largest all-true rectangle: the first found from the top, then the left, at the largest area. Bars of true pixels stand on each row; a bar reaches as far as its neighbours are at least as high. above: for each column, how many true pixels stand right above the mask; then y may be negative."""
    height, width = mask.shape
    bars = np.zeros(width + 1, dtype=np.int64)
    if above is not None:
        bars[:-1] = above
    best, found = 0, None
    for y in range(height):
        bars[:-1] = (bars[:-1] + 1) * mask[y]
        open_at: list[int] = []
        for x, now in enumerate(bars.tolist()):
            while open_at and bars[open_at[-1]] > now:
                tall = int(bars[open_at.pop()])
                left = open_at[-1] + 1 if open_at else 0
                if tall * (x - left) > best:
                    best, found = tall * (x - left), (left, y - tall + 1, x - left, tall)
            open_at.append(x)
    return found


def _unpacked(group: pa.Table, first: int, band: int) -> np.ndarray:
    """The rows of a band [band, 64 * blocks] from its words; what has no word is false."""
    y, block, bits = (group.column(c).to_numpy() for c in ("y", "block", "bits"))
    out = np.zeros((band, (int(block.max()) + 1) * WORD), dtype=bool)
    set_ = np.unpackbits(bits.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    for k, (row, b) in enumerate(zip(y - first, block)):
        out[row, b * WORD : (b + 1) * WORD] = set_[k]
    return out


def largest_rectangle(common: DataFrame, band: int = BAND) -> DataFrame:
    """One row x, y, width, height (nulls if no pixel is set): the first largest rectangle of set bits, by its bottom row, then its right edge.

    Each band of `band` rows tells of each column how many set pixels end at its bottom, and whether all are set. A column's
    bands, in order, tell how many set pixels stand right above each band, however far they reach; with these, a band
    finds every rectangle whose bottom row it has.
    """
    size = band
    rows = common.select(F.expr(f"y div {size}").cast("int").alias("band"), F.col("y").cast("int").alias("y"), F.col("block").cast("int").alias("block"), "bits")

    def columns(key: tuple, group: pa.Table) -> pa.Table:
        band = key[0].as_py()
        mask = _unpacked(group, band * size, size)
        upward = np.cumprod(mask[::-1], axis=0, dtype=np.int64).sum(axis=0)
        return pa.table({"band": pa.array([band] * mask.shape[1], pa.int32()), "x": pa.array(np.arange(mask.shape[1]), pa.int32()), "n": pa.array(upward, pa.int32())})

    ends = rows.groupBy("band").applyInArrow(columns, "band int, x int, n int")
    # bands that follow each other without a gap; among them the last one before that isn't all set, and the whole ones since
    order = Window.partitionBy("x").orderBy("band")
    run = ends.withColumn("_new", F.when(F.col("band") - 1 == F.lag("band").over(order), F.lit(0)).otherwise(F.lit(1))).withColumn("_new", F.sum("_new").over(order))
    short = F.when(F.col("n") < size, F.struct("band", "n"))
    earlier = Window.partitionBy("x", "_new").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    last, first = F.last(short, ignorenulls=True).over(earlier), F.min("band").over(earlier)
    above = F.when(last.isNotNull(), last["n"] + (F.col("band") - last["band"] - 1) * size).otherwise(F.coalesce((F.col("band") - first) * size, F.lit(0)))
    above = run.select("band", "x", above.cast("long").alias("bits"))
    both = rows.select("band", "y", "block", "bits").unionByName(above.where("bits > 0").select("band", F.lit(None).cast("int").alias("y"), F.col("x").alias("block"), "bits"))

    def solve(key: tuple, group: pa.Table) -> pa.Table:
        band = key[0].as_py()
        carried = group.filter(pc.is_null(group.column("y")))
        mask = _unpacked(group.filter(pc.is_valid(group.column("y"))), band * size, size)
        bars = np.zeros(mask.shape[1], dtype=np.int64)
        at = carried.column("block").to_numpy()
        bars[at[at < len(bars)]] = carried.column("bits").to_numpy()[at < len(bars)]
        got = rectangle(mask, bars)
        found = [] if got is None else [(got[0], got[1] + band * size, got[2], got[3])]
        return pa.table({**{n: pa.array([f[i] for f in found], pa.int32()) for i, n in enumerate(("x", "y", "width", "height"))}, "band": pa.array([band] * len(found), pa.int32())})

    solved = both.groupBy("band").applyInArrow(solve, "x int, y int, width int, height int, band int")
    best = solved.agg(F.max_by(F.struct("x", "y", "width", "height"), F.struct(F.col("width").cast("long") * F.col("height"), -F.col("band"))).alias("r"))
    return best.select("r.x", "r.y", "r.width", "r.height")


def verdict(samples: DataFrame, black: float = 0.01, near: float = 0.03) -> DataFrame:
    """Status of a sampled region: fail without samples or with any above black, warning with any above near, else pass."""
    n = lambda c: F.count_if(c)
    dark, grey = F.col("black_ratio") > black, (F.col("black_ratio") <= black) & (F.col("near_ratio") > near)
    status = F.when((F.count(F.lit(1)) == 0) | (n(dark) > 0), "fail").when(n(grey) > 0, "warning").otherwise("pass")
    return samples.agg(status.alias("status"), n(dark).alias("n_fail"), n(grey).alias("n_warning"))
