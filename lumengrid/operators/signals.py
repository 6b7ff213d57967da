"""Audio alignment: cross-correlation of a template with each camera's signal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import REFERENCE


def correlate(target: np.ndarray, template: np.ndarray) -> np.ndarray:
    """The valid cross-correlation by FFT."""
    n = 1 << int(len(target) + len(template) - 1).bit_length()
    full = np.fft.irfft(np.fft.rfft(target, n) * np.conj(np.fft.rfft(template, n)), n)
    return full[: len(target) - len(template) + 1]


def match(target: np.ndarray, template: np.ndarray, peak_in_template: int | None = None) -> int | None:
    """The sample of the clap in a target: the best place of the normalised template, then the loudest sample within. None if the template is silent or longer than the target."""
    template = np.asarray(template, dtype=np.float64)
    spread = template.std()
    if spread < 1e-8 or len(template) > len(target):
        return None
    at = int(np.argmax(correlate(np.asarray(target, dtype=np.float64), (template - template.mean()) / spread)))
    return at + int(np.argmax(np.abs(target[at : at + len(template)])))


def align(audio: DataFrame, regions: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """(scene, camera_id, samples) and template regions (scene, start, end) on the reference camera to (scene, camera_id, peak).

    The template is joined to its scene's cameras, so each camera is a task's row of its own; manual peaks win.
    """

    @F.arrow_udf("long")
    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for target, template in columns:
            out = [match(np.asarray(t.values), np.asarray(p.values)) if t.is_valid and p.is_valid else None for t, p in zip(target, template)]
            yield pa.array(out, pa.int64())

    ref = audio.where(F.col("camera_id") == REFERENCE).join(regions, "scene").select("scene", F.slice("samples", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")).alias("template"))
    found = audio.join(ref, "scene").select("scene", "camera_id", run("samples", "template").alias("peak"))
    if manual is None:
        return found
    fixed = manual.select("scene", "camera_id", F.col("peak").alias("fixed"))
    return found.join(fixed, ["scene", "camera_id"], "left").select("scene", "camera_id", F.coalesce("fixed", "peak").alias("peak"))


def template_lags(vectors: DataFrame, start: int, length: int) -> DataFrame:
    """(vec_id, embedding): the lag at which a slice of each vector fits it best, by dot products in built-in functions; the first at ties."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    template = F.slice(F.col("e"), start + 1, length)
    score = lambda k: F.aggregate(F.zip_with(template, F.slice(F.col("e"), k + 1, length), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scores = F.transform(F.sequence(F.lit(0), F.size("e") - length), score)
    return vectors.select("vec_id", e.alias("e")).select("vec_id", scores.alias("s")).select("vec_id", (F.array_position("s", F.array_max("s")) - 1).cast("int").alias("lag"))
