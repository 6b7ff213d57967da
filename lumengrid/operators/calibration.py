"""Calibration quality: common frames, error statistics, rotation modes, risks, and closed-form geometry.

Detections are rows: camera_id, frame_index, detected, cx, cy, area, score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..model import LIMITS, REFERENCE, Limits


def common_frames(detections: DataFrame, least: int = 5) -> DataFrame:
    """Per other camera, the frames that it shares with the reference camera; cameras with fewer than `least` drop out."""
    seen = detections.where("detected").select("camera_id", "frame_index").distinct()
    ref = seen.where(F.col("camera_id") == REFERENCE).select("frame_index")
    shared = seen.where(F.col("camera_id") != REFERENCE).join(ref, "frame_index")
    return shared.groupBy("camera_id").agg(F.count(F.lit(1)).alias("n_common"), F.min("frame_index").alias("first_frame"), F.max("frame_index").alias("last_frame")).where(F.col("n_common") >= least)


def _grid_vectors(corners: Column, columns: Column) -> tuple[Column, Column]:
    """Unit vectors along a board's rows and columns, from flat corners [x, y, x, y, ...] row by row: mean steps, which are ends less beginnings. Null if either has no length."""
    rows = (F.size(corners) / 2 / columns).cast("int")
    at = lambda r, c, k: F.element_at(corners, ((r * columns + c) * 2 + k + 1).cast("int"))
    total = lambda n, f: F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda s, i: s + f(i))
    along = [total(rows, lambda r, k=k: at(r, columns - 1, k) - at(r, F.lit(0), k)) for k in (0, 1)]
    down = [total(columns, lambda c, k=k: at(rows - 1, c, k) - at(F.lit(0), c, k)) for k in (0, 1)]
    size = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1])
    unit = lambda v, n: F.when(size(v) / n >= 1e-8, F.array(v[0] / size(v), v[1] / size(v)))
    return unit(along, rows * (columns - 1)), unit(down, columns * (rows - 1))


def described(found: DataFrame) -> DataFrame:
    """Corner lists (camera_id, frame_index, board, corners; flat, row by row) to detections: detected, reason, centre, area of the box around the corners, and how well the board's best orientation agrees with the reference camera's first one (two unit vectors, so at most 2). Corners that are null couldn't be read; an empty list has no board."""
    c, n = F.col("corners"), F.size("corners")
    columns = F.size(F.filter("board", lambda x, i: (i % 2 == 1) & (x == F.col("board")[1])))
    part = lambda k: F.filter(c, lambda x, i: i % 2 == k)
    shape = found.withColumn("_columns", columns)
    x, y = _grid_vectors(c, F.col("_columns"))
    grid = (n > 0) & (F.col("_columns") > 1) & (n > 2 * F.col("_columns"))
    rows = shape.withColumns({"_x": F.when(grid, x), "_y": F.when(grid, y), "_square": n == 2 * F.col("_columns") * F.col("_columns")})
    ref = rows.where((F.col("camera_id") == REFERENCE) & F.col("_x").isNotNull() & F.col("_y").isNotNull()).orderBy("frame_index").limit(1).select(F.col("_x").alias("_rx"), F.col("_y").alias("_ry"))
    rows = rows.join(F.broadcast(ref), F.lit(True), "left")  # one row
    dot2 = lambda a, b: a[0] * b[0] + a[1] * b[1]
    xx, xy, yx, yy = (dot2(F.col(a), F.col(b)) for a in ("_x", "_y") for b in ("_rx", "_ry"))
    straight = [xx + yy, -xx - yy, yy - xx, xx - yy]  # turned by 0 and 180 degrees, and mirrored
    turned = [yx - xy, xy - yx, yx + xy, -yx - xy]  # by 90 and 270 degrees: only a square board has these
    score = F.greatest(F.array_max(F.array(*straight)), F.when(F.col("_square"), F.array_max(F.array(*turned))))
    reason = F.when(c.isNull(), "read_failed").when(n == 0, "checkerboard_not_found").when(F.col("_x").isNull() | F.col("_y").isNull(), "orientation_align_failed")
    rows = rows.withColumn("reason", reason)
    good = F.col("reason").isNull()
    mean = lambda k: F.when(good, F.aggregate(part(k), F.lit(0.0), lambda s, v: s + v) / (n / 2))
    extent = lambda k: F.array_max(part(k)) - F.array_min(part(k))
    return rows.select("camera_id", "frame_index", good.alias("detected"), "reason", mean(0).alias("cx"), mean(1).alias("cy"), F.when(good, extent(0) * extent(1)).alias("area"), F.when(good, score).alias("score"))


def detection_summary(detections: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Per camera: sampled and detected frames, their rate, and ranges of centre, area and score. Cameras of `expected` without a row appear with 0."""
    d = F.col("detected")
    over = {f"{f.__name__}_{c}": f(F.when(d, F.col(c))) for c in ("cx", "cy", "area", "score") for f in (F.min, F.max)}
    out = detections.groupBy("camera_id").agg(F.count(F.lit(1)).alias("n_sampled"), F.count_if(d).alias("n_detected"), *[v.alias(k) for k, v in over.items()])
    out = out.withColumn("rate", F.when(F.col("n_sampled") > 0, F.col("n_detected") / F.col("n_sampled")).otherwise(F.lit(0.0)))
    return out if expected is None else expected.select("camera_id").join(out, "camera_id", "left").fillna(0, ["n_sampled", "n_detected"]).fillna(0.0, ["rate"])


def corner_errors(corners: DataFrame) -> DataFrame:
    """(camera_id, frame_index, dx, dy) per corner to mean and max distance per frame."""
    d = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
    return corners.groupBy("camera_id", "frame_index").agg(F.avg(d).alias("mean_error"), F.max(d).alias("max_error"))


def mono_summary(frames: DataFrame, least: int = 4) -> DataFrame:
    """Per camera, statistics of frame errors; a camera with fewer than `least` frames has insufficient points."""
    out = stats.summary(frames, "mean_error", ["camera_id"])
    return out.withColumn("status", F.when(F.col("n") < least, "insufficient_points").otherwise("ok"))


def worst_frames(frames: DataFrame, n: int = 5) -> DataFrame:
    w = Window.partitionBy("camera_id").orderBy(F.desc("mean_error"), "frame_index")
    return frames.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def residual_summary(residuals: DataFrame) -> DataFrame:
    """(mode, camera_id, residual) to statistics per mode and camera, and per mode (camera null)."""

    def of(by: list[str]) -> DataFrame:
        own = residuals.groupBy(*by).agg(F.count("residual").alias("n"), F.max("residual").alias("max")).alias("o")
        q = stats.quantiles(residuals, "residual", by, {"median": 0.5, "p95": 0.95}).alias("q")
        same = [F.col(f"o.{b}").eqNullSafe(F.col(f"q.{b}")) for b in by]
        return own.join(q, same, "left").select("o.mode", *(["o.camera_id"] if len(by) > 1 else [F.lit(None).cast("string").alias("camera_id")]), "n", "median", "p95", "max")

    return of(["mode", "camera_id"]).unionByName(of(["mode"]))


def rotation_mode(direct_p95: Column, inverse_p95: Column) -> Column:
    """The mode whose residuals are at least a fifth lower."""
    return F.when(direct_p95.isNull() | inverse_p95.isNull(), "unknown").when(direct_p95 <= inverse_p95 * F.lit(0.8), "direct").when(inverse_p95 <= direct_p95 * F.lit(0.8), "inverse").otherwise("no_change_recommended")


def recommend(summary: DataFrame) -> DataFrame:
    """The recommended rotation mode from the totals of residual_summary()."""
    p95 = lambda m: F.max(F.when(F.col("mode") == m, F.col("p95")))
    total = summary.where("camera_id is null").agg(p95("direct").alias("direct_p95"), p95("inverse").alias("inverse_p95"))
    return total.withColumn("rotation_mode", rotation_mode(F.col("direct_p95"), F.col("inverse_p95")))


def distortion(coefficients: DataFrame) -> DataFrame:
    """(camera_id, d array) to count, least, largest and Euclidean norm."""
    d = F.col("d")
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return coefficients.select("camera_id", F.size(d).cast("long").alias("n"), F.array_min(d).alias("min"), F.array_max(d).alias("max"), norm.alias("norm"))


def risks(detections: DataFrame, mono: DataFrame, stereo: DataFrame, mode: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """(level, camera_id, reason) from the four summaries."""
    few = F.when(F.col("n_detected") < limits.least_detections, "fail").when(F.col("rate") < limits.detection_rate, "warning")
    a = detections.select(few.alias("level"), "camera_id", F.when(F.col("n_detected") < limits.least_detections, "detected_frames_less_than_5").otherwise("detection_rate_below_30_percent").alias("reason")).where("level is not null")
    b = mono.where(F.col("p95") > limits.mono_p95).select(F.lit("warning").alias("level"), "camera_id", F.lit("mono_reprojection_p95_gt_2px").alias("reason"))
    c = stereo.where(F.col("stereo_error") > limits.stereo_p95).select(F.lit("warning").alias("level"), "camera_id", F.lit("stereo_error_gt_2px").alias("reason"))
    d = mode.where(F.col("rotation_mode").isin("direct", "inverse")).select(F.lit("warning").alias("level"), F.lit(None).cast("string").alias("camera_id"), F.lit("rotation_direction_significant_difference").alias("reason"))
    return a.unionByName(b).unionByName(c).unionByName(d)


def board_points(spark, columns: int = 8, rows: int = 8, square_mm: float = 25.0) -> DataFrame:
    """The points of one board in its plane, row by row."""
    return boards_points(spark.createDataFrame([(columns, rows, float(square_mm))], "columns int, rows int, square_mm double"), [])


def boards_points(boards: DataFrame, keys: list[str]) -> DataFrame:
    """Boards (keys..., columns, rows, square_mm) to the points of each in its plane, row by row."""
    each = boards.where("columns > 0 and rows > 0").select(*keys, "columns", "square_mm", F.explode(F.sequence(F.lit(0), F.expr("columns * rows - 1"))).alias("corner"))
    return each.select(*keys, "corner", (F.expr("corner % columns") * F.col("square_mm")).alias("x"), (F.expr("corner div columns") * F.col("square_mm")).alias("y"), F.lit(0.0).alias("z"))


def orientation(grid: Column, n: int, flip: bool, turns: int) -> Column:
    """An n x n row-major array mirrored left to right if asked, then turned counter-clockwise `turns` times."""
    index = [[r * n + c for c in range(n)] for r in range(n)]
    if flip:
        index = [row[::-1] for row in index]
    for _ in range(turns % 4):
        index = [list(row) for row in zip(*index)][::-1]
    flat = F.array(*[F.lit(v + 1) for row in index for v in row])
    return F.transform(flat, lambda i: F.element_at(grid, i))


def orientations(grid: Column, n: int) -> Column:
    """All eight orientations of a square grid, unturned first."""
    return F.array(*[orientation(grid, n, flip, t) for flip in (False, True) for t in range(4)])


def best_candidate(scores: Column) -> Column:
    """0-based index of the first largest score of an array."""
    return F.array_position(scores, F.array_max(scores)) - 1


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _m(m, r: int, c: int) -> Column:
    return F.lit(float(m[r][c]))


def rectify_point(u: Column, v: Column, k, rot, p) -> tuple[Column, Column]:
    """P R K^-1 [u, v, 1] without distortion, for an upper triangular K without skew: plain column arithmetic."""
    x, y = (u - _m(k, 0, 2)) / _m(k, 0, 0), (v - _m(k, 1, 2)) / _m(k, 1, 1)
    a, b, c = (_m(rot, i, 0) * x + _m(rot, i, 1) * y + _m(rot, i, 2) for i in range(3))
    return _m(p, 0, 0) * (a / c) + _m(p, 0, 2), _m(p, 1, 1) * (b / c) + _m(p, 1, 2)


def rectify_map(x: Column, y: Column, k, rot, p) -> tuple[Column, Column]:
    """The source pixel of an output pixel: K R^T P^-1, as 32-bit floats."""
    a, b = (x - _m(p, 0, 2)) / _m(p, 0, 0), (y - _m(p, 1, 2)) / _m(p, 1, 1)
    i, j, w = (_m(rot, 0, n) * a + _m(rot, 1, n) * b + _m(rot, 2, n) for n in range(3))
    return (_m(k, 0, 0) * (i / w) + _m(k, 0, 2)).cast("float"), (_m(k, 1, 1) * (j / w) + _m(k, 1, 2)).cast("float")


def virtual_matrix(fx: Column, fy: Column, cx: Column, cy: Column, roi: Column, width: int, height: int) -> Column:
    """The shared matrix that fills the image with a region, and its scale."""
    scale = F.least(F.lit(float(width)) / roi["width"], F.lit(float(height)) / roi["height"])
    return F.struct((fx * scale).alias("fx"), (fy * scale).alias("fy"), ((cx - roi["x"]) * scale).alias("cx"), ((cy - roi["y"]) * scale).alias("cy"), scale.alias("scale"))


def optimal_matrix(k, width: int, height: int, alpha: float = 0.0) -> tuple[list, tuple[int, int, int, int]]:
    """The best matrix without distortion, and its valid rectangle: nothing bends, so the inner and the outer rectangle are the image, and every alpha gives K."""
    if not 0 <= alpha <= 1:
        raise ValueError(f"alpha {alpha} isn't between 0 and 1")
    return k, (0, 0, width, height)
