"""Time series per pixel: statistics, virtual dates, interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import no_nan

#: The nine statistics, in their fixed order.
STATISTICS = ("min", "p10", "p25", "p50", "p75", "p90", "max", "mean", "std")
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)


def statistics(series: DataFrame, keys: list[str], value: str, wanted: tuple[str, ...] = STATISTICS) -> DataFrame:
    """Statistics of value per key, NaN and NULL left out: one shuffle, one pass."""
    v = no_nan(F.col(value).cast("double"))
    q = F.percentile(v, F.array(*map(F.lit, QUANTILES)))
    every = series.groupBy(*keys).agg(F.min(v).alias("min"), q.alias("_q"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))
    picked: dict[str, Column] = {f"p{round(100 * p)}": F.get("_q", k) for k, p in enumerate(QUANTILES)}
    return every.select(*keys, *((picked[s] if s in picked else F.col(s)).alias(s) for s in wanted))


def statistics_wide(series: DataFrame, keys: list[str], feature: str, features: list[str], value: str) -> DataFrame:
    """One row a key with a column for each feature and statistic, feature by feature."""
    long = statistics(series, [*keys, feature], value)
    picks = [F.first(F.when(F.col(feature) == f, F.col(s)), ignorenulls=True).alias(f"{s} {f}") for f in features for s in STATISTICS]
    return long.groupBy(*keys).agg(*picks)


def grid(bounds: DataFrame, keys: list[str], start: str, end: str, step: int) -> DataFrame:
    """keys, t (from 1), date: from start on every step days, end included if it is hit."""
    days = F.sequence(F.col(start), F.col(end), F.make_interval(days=F.lit(step)))
    return bounds.select(*keys, F.posexplode(days).alias("_k", "date")).select(*keys, (F.col("_k") * step + 1).cast("int").alias("t"), F.col("date").cast("date").alias("date"))


def with_base(grid: DataFrame, base: DataFrame, keys: list[str]) -> DataFrame:
    """keys, t, role: grid days and the base day of each key; 'base' where it is off the grid, 'arop' where it is on it.

    A negative base day is before the grid: its image is taken as it is, not interpolated.
    """
    on = grid.select(*keys, "t", F.lit(False).alias("_b")).unionByName(base.where("t >= 0").select(*keys, "t", F.lit(True).alias("_b")))
    marks = on.groupBy(*keys, "t").agg(F.count("*").alias("_n"), F.bool_or("_b").alias("_b"))
    role = F.when(~F.col("_b"), "grid").when(F.col("_n") > 1, "arop").otherwise("base")
    return marks.select(*keys, "t", role.alias("role"))


def interpolate(observations: DataFrame, keys: list[str], t: str, value: str, days: Column, min_obs: int = 3) -> DataFrame:
    """keys, t, value (double): linear in time between valid observations, held at both ends; 0 for fewer than min_obs.

    observations: one row a key and day; NULL values are clouded or missing.
    The series of a key becomes one sorted array, so that a key costs one
    shuffled row and every grid day is arithmetic on that row: no union with the
    grid, no window, no second sort.
    """
    valid = F.when(F.col(value).isNotNull(), F.struct(F.col(t).alias("t"), F.col(value).cast("double").alias("v")))
    series = observations.groupBy(*keys).agg(F.sort_array(F.collect_list(valid)).alias("_s"))
    before = lambda d: F.try_element_at(F.filter("_s", lambda o: o["t"] <= d), F.lit(-1))
    after = lambda d: F.get(F.filter("_s", lambda o: o["t"] >= d), 0)
    around = F.transform(days, lambda d: F.struct(d.alias("t"), before(d).alias("a"), after(d).alias("b")))
    rows = series.select(*keys, (F.size("_s") >= min_obs).alias("_ok"), F.explode(around).alias("_g"))
    a, b, d = F.col("_g.a"), F.col("_g.b"), F.col("_g.t")
    line = (b["v"] - a["v"]) / (b["t"] - a["t"]) * (d - a["t"]) + a["v"]
    at = F.when(a.isNull(), b["v"]).when(b.isNull() | (a["t"] == b["t"]), a["v"]).otherwise(line)
    return rows.select(*keys, d.alias("t"), F.when(F.col("_ok"), at).otherwise(F.lit(0.0)).alias("value"))


def valid_observations(pixels: DataFrame, group_keys: list[str], nodata: int, compat: bool = False, first_band: str | None = None) -> DataFrame:
    """pixels plus valid: not under a cloud (clm > 0) and no nodata in any band of the group (compat: in first_band only)."""
    bad = F.col("value") == nodata
    if compat:
        bad = bad & (F.col("band") == first_band)
    flags = pixels.groupBy(*group_keys).agg((F.max("clm") > 0).alias("_cloud"), F.bool_or(bad).alias("_bad"))
    return pixels.join(flags, group_keys).withColumn("valid", ~F.coalesce("_cloud", F.lit(False)) & ~F.col("_bad")).drop("_cloud", "_bad")


def descriptions(features: DataFrame, feature: str = "feature") -> DataFrame:
    """position, description: 'statistic feature' for each feature and statistic, feature by feature in sorted order."""
    ordered = features.select(F.sort_array(F.collect_set(feature)).alias("f")).select(F.posexplode("f").alias("i", "f"))
    stats = F.array(*map(F.lit, STATISTICS))
    return ordered.select("i", "f", F.posexplode(stats).alias("k", "s")).select((F.col("i") * len(STATISTICS) + F.col("k")).cast("int").alias("position"), F.concat_ws(" ", "s", "f").alias("description"))
