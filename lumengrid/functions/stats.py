"""Robust statistics as window columns and aggregates; all stay in built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: From MAD to the standard deviation of a normal distribution, and the least spread (fixed values).
MAD_TO_SIGMA, LEAST_SIGMA = 1.4826, 1e-6


def with_robust_z(df: DataFrame, value: str, by: str, prefix: str) -> DataFrame:
    """df with {prefix}_median, {prefix}_mad and {prefix}_z within each `by`. Medians are aggregates, counted where the rows lie; only a row per group is shuffled and joined back."""
    med, mad, dev = f"{prefix}_median", f"{prefix}_mad", f"_{prefix}_deviation"
    rows = df.join(df.groupBy(by).agg(F.median(value).alias(med)), by).withColumn(dev, F.abs(F.col(value) - F.col(med)))
    rows = rows.join(rows.groupBy(by).agg(F.median(dev).alias(mad)), by)
    sigma = F.greatest(F.col(mad) * F.lit(MAD_TO_SIGMA), F.lit(LEAST_SIGMA))
    return rows.withColumn(f"{prefix}_z", F.col(dev) / sigma).drop(dev)


def spread(df: DataFrame, value: str, by: str) -> DataFrame:
    """Per group: n, median, min, max, range, MAD."""
    first = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.median(value).alias("median_ms"), F.min(value).alias("min_ms"), F.max(value).alias("max_ms"), (F.max(value) - F.min(value)).alias("range_ms"))
    mad = df.join(first.select(by, "median_ms"), by).groupBy(by).agg(F.median(F.abs(F.col(value) - F.col("median_ms"))).alias("mad_ms"))
    return first.join(mad, by)


#: Bounds by which a large group's values are cut. Groups of more distinct values than DISTINCT are large; a row for each of at most MANY large groups is broadcast.
BOUNDS, DISTINCT, MANY = 64, 200_000, 10_000


def quantiles(df: DataFrame, value: str, by: list[str], wanted: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group (by..., names of `wanted`), for groups of any size; groups without a value have no row.

    A first job estimates the numbers of distinct values and counts the large groups, mostly none. All others are one
    aggregate, whose tasks count values where the rows lie.
    """
    given = df.where(F.col(value).isNotNull())
    large = given.groupBy(*by).agg(F.approx_count_distinct(value).alias("_d")).where(F.col("_d") > DISTINCT).select(*[F.col(b).alias(f"_l{i}") for i, b in enumerate(by)])
    n = large.limit(MANY + 1).count()
    if not n:
        return _counted(given, value, by, wanted)
    near = F.broadcast if n <= MANY else lambda few: few
    same = [F.col(b).eqNullSafe(F.col(f"_l{i}")) for i, b in enumerate(by)]
    small = _counted(given.join(near(large), same, "left_anti"), value, by, wanted)
    return small.unionByName(_by_bounds(given.join(near(large), same, "left_semi"), value, by, wanted, near))


def _counted(given: DataFrame, value: str, by: list[str], wanted: dict[str, float]) -> DataFrame:
    out = given.groupBy(*by).agg(F.percentile(F.col(value).cast("double"), F.array(*map(F.lit, wanted.values()))).alias("_q"))
    return out.select(*by, *[F.col("_q")[i].alias(name) for i, name in enumerate(wanted)])


def _by_bounds(df: DataFrame, value: str, by: list[str], wanted: dict[str, float], near) -> DataFrame:
    """Quantiles of large groups. Values are counted first. Approximate quantiles cut each group's values into some BOUNDS ranges, the counts of which tell exactly in which range a rank lies; only that range is ordered. So no task holds a group. near: how a row for each group is joined."""
    keys = [f"_k{i}" for i in range(len(by))]
    counts = df.groupBy(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    bounds = counts.groupBy(*keys).agg(F.percentile_approx("_v", [i / BOUNDS for i in range(1, BOUNDS)], F.lit(1000)).alias("_b"), F.sum("_n").alias("_total"))
    told = counts.join(near(bounds.withColumnsRenamed({k: f"b{k}" for k in keys})), [F.col(k).eqNullSafe(F.col(f"b{k}")) for k in keys]).drop(*[f"b{k}" for k in keys])
    cut = told.withColumn("_r", F.size(F.filter("_b", lambda x: x < F.col("_v"))))
    sizes = cut.groupBy(*keys, "_r").agg(F.sum("_n").alias("_m"), F.first("_total").alias("_total"))
    before = F.coalesce(F.sum("_m").over(Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ask = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(end).alias("end"), (F.ceil if end else F.floor)((F.col("_total") - 1) * F.lit(q)).cast("long").alias("rank"), F.lit(q).alias("q")) for name, q in wanted.items() for end in (0, 1)])).alias("_a")
    asked = sizes.withColumn("_before", before).select(*keys, "_r", "_m", "_before", "_total", ask).where("_a.rank >= _before and _a.rank < _before + _m")
    asked = asked.groupBy(*keys, "_r").agg(F.first("_before").alias("_before"), F.collect_list("_a").alias("_a"))
    here = cut.select(*keys, "_r", "_v", "_n").join(near(asked.withColumnsRenamed({k: f"a{k}" for k in [*keys, "_r"]})), [F.col(k).eqNullSafe(F.col(f"a{k}")) for k in [*keys, "_r"]])
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    found = here.withColumn("_upto", upto).select(*keys, "_v", "_n", "_upto", F.explode("_a").alias("_a")).where("_a.rank >= _upto - _n and _a.rank < _upto")
    at = lambda name, end: F.max(F.when((F.col("_a.name") == name) & (F.col("_a.end") == end), F.col("_v")))
    part = lambda name: F.max(F.when((F.col("_a.name") == name) & (F.col("_a.end") == 0), (F.col("_total") - 1) * F.col("_a.q") - F.col("_a.rank")))
    found = found.join(near(bounds.select(*[F.col(k).alias(f"t{k}") for k in keys], "_total")), [F.col(k).eqNullSafe(F.col(f"t{k}")) for k in keys])
    out = found.groupBy(*keys).agg(*[(at(n, 0) + (at(n, 1) - at(n, 0)) * part(n)).alias(n) for n in wanted])
    return out.withColumnsRenamed(dict(zip(keys, by)))


def summary(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Per group: n, mean, median, p95 (interpolated), max; a group without values has 0 and nulls."""
    v = F.col(value)
    return df.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.percentile(v, F.lit(0.95)).alias("p95"), F.max(v).alias("max"))


def longest_run(mask: Column) -> Column:
    """The longest run of true values in an array of booleans; null counts as false."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(s, x):
        now = F.when(F.coalesce(x, F.lit(False)), s["now"] + 1).otherwise(F.lit(0))
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))

    return F.aggregate(mask, start, step, lambda s: s["most"])


def longest_run_rows(df: DataFrame, by: list[str], order: list[str], flag: str, name: str) -> DataFrame:
    """The longest run of true flags in each group's row order: gaps and islands, for groups too long for an array."""
    w, v = Window.partitionBy(*by).orderBy(*order), Window.partitionBy(*by, flag).orderBy(*order)
    runs = df.withColumn("_island", F.row_number().over(w) - F.row_number().over(v)).groupBy(*by, flag, "_island").agg(F.count(F.lit(1)).alias("_n"))
    return runs.groupBy(*by).agg(F.coalesce(F.max(F.when(F.col(flag), F.col("_n"))), F.lit(0)).cast("long").alias(name))


def first_peak(signal: Column) -> Column:
    """0-based index of the first largest absolute value of an array."""
    size = F.transform(signal, lambda x: F.abs(x))
    return F.array_position(size, F.array_max(size)) - 1
