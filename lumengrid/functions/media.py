"""Scalar expressions on camera ids, scene names, times, rectangles and samples. rint() rounds half to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def view_index(camera: Column) -> Column:
    """CAM_B4 to 8; null for ids outside the grid."""
    ok = camera.rlike("^CAM_[A-E][1-5]$")
    return F.when(ok, (F.ascii(F.substring(camera, 5, 1)) - 65) * 5 + F.substring(camera, 6, 1).try_cast("int") - 1).cast("int")


def camera_of(index: Column) -> Column:
    """8 to CAM_B4."""
    i = index.cast("int")
    return F.concat(F.lit("CAM_"), F.chr(F.floor(i / 5).cast("int") + 65), (i % 5 + 1).cast("string"))


def view_id(camera: Column) -> Column:
    return F.format_string("view_%02d", view_index(camera))


def scene_id(video: Column) -> Column:
    """A file name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(video, r"(?<=.)\.[^.]*$", "")


def segment_scene(scene: Column, index: Column, count: Column) -> Column:
    """The exported scene's name: as it is for one segment, otherwise with _segNN from 1."""
    return F.when(count > 1, F.format_string("%s_seg%02d", scene, (index + 1).cast("int"))).otherwise(scene)


def offset_class(offset_ms: Column, warn: float, fail: float) -> Column:
    return F.when(F.abs(offset_ms) >= fail, "abs_fail").when(F.abs(offset_ms) >= warn, "abs_warn")


def clip_frame(clap: Column, offset_ms: Column, delay: Column, fps: Column) -> Column:
    """The frame that a clip starts with."""
    return F.rint((clap + offset_ms / 1000 + delay) * fps).cast("long")


def clip_start(frame: Column, fps: Column) -> Column:
    return frame * (1 / fps)


def phase_error_ms(cut: Column, clap: Column, offset_ms: Column, delay: Column) -> Column:
    return (cut - (clap + offset_ms / 1000 + delay)) * 1000


def lag_to_ms(lag: Column, rate: int) -> Column:
    return lag / rate * 1000


def lag_to_frames(lag: Column, rate: int, fps: float) -> Column:
    return F.rint(lag / rate * F.lit(fps)).cast("long")


def saved_peak(clap: Column, offset_ms: Column, rate: int) -> Column:
    """The sample of a stored offset."""
    return F.rint((clap + offset_ms / 1000) * rate).cast("long")


def even_samples(n: Column, k: Column) -> Column:
    """k frame indices spread evenly over n frames, both ends included; halves round to even."""
    step = (n - 1).cast("double") / (k - 1)
    spread = F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0)).cast("int")), lambda i: F.rint(F.when(i == k - 1, (n - 1).cast("double")).otherwise(i * step)).cast("int"))))
    return F.when((n <= 0) | (k <= 0), F.array().cast("array<int>")).when(k == 1, F.array(F.lit(0))).otherwise(spread)


def strided_samples(n: Column, start_s: Column, interval_s: Column, fps: Column, most: Column | None = None) -> Column:
    """Frame indices from int(start * fps) by max(1, int(interval * fps)); at most `most` of them."""
    first, step = F.floor(start_s * fps).cast("int"), F.greatest(F.lit(1), F.floor(interval_s * fps).cast("int"))
    all_ = F.when(first > n - 1, F.array().cast("array<int>")).otherwise(F.sequence(first, (n - 1).cast("int"), step))
    return all_ if most is None else F.slice(all_, F.lit(1), most.cast("int"))


def position_time(start: Column, end: Column, position: Column) -> Column:
    """The time of position start, middle or end of a segment; the end keeps a little distance."""
    length = end - start
    last = F.greatest(start, end - F.least(F.lit(0.05), length * F.lit(0.01)))
    return F.when(position == "start", start).when(position == "middle", start + length * F.lit(0.5)).when(position == "end", last)


def to_8_bit(v: Column) -> Column:
    return F.least(F.greatest(F.rint(v / 257), F.lit(0)), F.lit(255)).cast("int")


def to_16_bit(v: Column) -> Column:
    return (v * 257).cast("int")


def rect(x: Column, y: Column, width: Column, height: Column) -> Column:
    return F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), width.cast("int").alias("width"), height.cast("int").alias("height"))


def crop_16_9(r: Column) -> Column:
    """The largest centred exact 16:9 rectangle with sides in steps of 16 and 9; null if there is none."""
    scale = F.least(F.floor(r["width"] / 16), F.floor(r["height"] / 9)).cast("int")
    w, h = scale * 16, scale * 9
    return F.when(scale > 0, rect(r["x"] + F.floor((r["width"] - w) / 2), r["y"] + F.floor((r["height"] - h) / 2), w, h))


def inside(inner: Column, outer: Column) -> Column:
    return (inner["x"] >= outer["x"]) & (inner["y"] >= outer["y"]) & (inner["x"] + inner["width"] <= outer["x"] + outer["width"]) & (inner["y"] + inner["height"] <= outer["y"] + outer["height"])


def is_16_9(r: Column) -> Column:
    return r["width"] * 9 == r["height"] * 16


def relative_crop(crop: Column, roi: Column) -> Column:
    """A crop in the coordinates of a region; null if it starts outside."""
    x, y = crop["x"] - roi["x"], crop["y"] - roi["y"]
    return F.when((x >= 0) & (y >= 0), rect(x, y, crop["width"], crop["height"]))


def colour_standardisation(on: Column, policy: Column, source: Column, target: Column, lut: Column, path: Column, checksum: Column, version: Column) -> Column:
    """The metadata of the colour step; its fields are null when it is off."""
    keep = lambda c: F.when(on, c.cast("string"))
    return F.struct(on.alias("enabled"), keep(policy).alias("policy_name"), keep(source).alias("source_color_space"), keep(target).alias("target_color_space"), keep(lut).alias("lut_file"), keep(path).alias("lut_path"), keep(checksum).alias("lut_checksum"), keep(version).alias("lut_asset_version"))
