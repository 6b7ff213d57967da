"""Our extension: medians and deviations of offsets that are kept up to date as manifests arrive, a scene or camera at a time.

The state of a key is a map from value to count, which merges by adding up, so its size is that of the distinct values
and not of the rows. Each micro-batch updates the keys that it touches and gives their new figures, which equal those of
one batch over all rows so far; a query restarted from its checkpoint goes on from its state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

FIGURES = "n long, median double, mad double, least double, most double"


def weighted_median(values: np.ndarray, counts: np.ndarray) -> float:
    """The median of sorted values, each as often as its count: the mean of the two in the middle."""
    upto = np.cumsum(counts)
    n = int(upto[-1])
    low, high = values[np.searchsorted(upto, [(n - 1) // 2 + 1, n // 2 + 1])]
    return float((low + high) / 2)


def figures(values: np.ndarray, counts: np.ndarray) -> tuple[int, float, float, float, float]:
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    median = weighted_median(values, counts)
    far = np.abs(values - median)
    order = np.argsort(far, kind="stable")
    return int(counts.sum()), median, weighted_median(far[order], counts[order]), float(values[0]), float(values[-1])


class ValueCounts(StatefulProcessor):
    """Rows (key, offset_ms) to the key's figures after them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "value double", "n long")

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import pandas as pd

        for part in rows:
            for value, n in part["offset_ms"].value_counts().items():
                have = self.counts.getValue((value,)) if self.counts.containsKey((value,)) else (0,)
                self.counts.updateValue((value,), (int(have[0]) + int(n),))
        state = [(v[0], n[0]) for v, n in self.counts.iterator()]
        if state:
            values, counts = np.array([v for v, _ in state], dtype=np.float64), np.array([n for _, n in state], dtype=np.int64)
            yield pd.DataFrame([(key[0], *figures(values, counts))], columns=["key", "n", "median", "mad", "least", "most"])

    def close(self) -> None:
        pass


def incremental(offsets: DataFrame, by: str) -> DataFrame:
    """A stream of offsets (by, offset_ms) to the figures of each key that a micro-batch touches: key, n, median, mad, least, most. Needs the state store of RocksDB (see keep_figures)."""
    given = offsets.where(F.col("offset_ms").isNotNull() & ~F.isnan("offset_ms") & F.col(by).isNotNull()).select(F.col(by).cast("string").alias("key"), F.col("offset_ms").cast("double").alias("offset_ms"))
    return given.groupBy("key").transformWithStateInPandas(statefulProcessor=ValueCounts(), outputStructType=f"key string, {FIGURES}", outputMode="Update", timeMode="None")


def keep_figures(offsets: DataFrame, by: str, table: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the figures as a table of changes: each micro-batch writes the keys that it touched below batch=<its number>, once, however often it is tried."""
    spark = offsets.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def keep(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{table}/batch={batch}")

    out = incremental(offsets, by).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).outputMode("update")
    return (out.trigger(availableNow=True) if available_now else out).start()


def latest(spark: SparkSession, table: str) -> DataFrame:
    """The newest figures of each key."""
    rows = spark.read.schema(f"key string, {FIGURES}, batch long").option("basePath", table).parquet(table)
    newest = Window.partitionBy("key").orderBy(F.desc("batch"))
    return rows.withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r", "batch")
