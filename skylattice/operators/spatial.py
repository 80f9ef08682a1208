"""Grids: resampling, high-pass convolution, fusion, mosaics.

The high-pass kernel is -1 everywhere but at its centre, so a convolution is a
box sum and one more pixel.  Box sums are separable: two running windows, over
the columns of a row and then over the rows of a column, cost the same for any
kernel, where a join with kernel offsets would multiply the rows by its area.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import nearest

#: Kernel size, centre gain and weight by resolution ratio (from, below); fixed values.
KERNELS = ((1.0, 2.5, 5, 24, 0.25), (2.5, 3.5, 7, 48, 0.5), (3.5, 5.5, 9, 80, 0.5), (5.5, 7.5, 11, 120, 0.65), (7.5, 9.5, 13, 168, 1.0), (9.5, float("inf"), 15, 336, 1.35))


@dataclass(frozen=True)
class Kernel:
    size: int
    gain: int
    weight: float

    @property
    def shift(self) -> int:
        """How far the kernel's centre is from its middle: sizes 7, 11 and 15 have half-even rounded centres."""
        return round(self.size / 2) - self.size // 2


def kernel_for(ratio: float) -> Kernel:
    for low, high, size, gain, weight in KERNELS:
        if low < ratio < high or low == ratio and low != 1.0:
            return Kernel(size, gain, weight)
    raise ValueError("the ratio of resolutions must be above 1")


def resample_nearest(pixels: DataFrame, keys: list[str], source: tuple[int, int], target: tuple[int, int]) -> DataFrame:
    """pixels (keys, y, x, ...) on another grid, sizes as (rows, columns).

    Going up, each source pixel is copied to its block of targets; going down,
    the pixels that some target hits stay.  Either way nothing is joined.
    """
    rest = [c for c in pixels.columns if c not in (*keys, "y", "x")]

    def targets(c: str, n: int, m: int):
        first = F.ceil(F.col(c) * F.lit(m) / F.lit(n)).cast("int")
        last = (F.ceil((F.col(c) + 1) * F.lit(m) / F.lit(n)) - 1).cast("int")
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    rows = pixels.select(*keys, *rest, "x", F.explode(targets("y", source[0], target[0])).alias("y"))
    return rows.select(*keys, *rest, "y", F.explode(targets("x", source[1], target[1])).alias("x"))


def reflected(pixels: DataFrame, keys: list[str], rows: int, columns: int, pad: int) -> DataFrame:
    """pixels and their mirror images up to pad beyond each edge (the edge itself is repeated)."""
    if pad > min(rows, columns):
        raise ValueError("the kernel reaches beyond the mirrored raster")

    def places(c: str, n: int):
        at = F.col(c)
        here = F.array(at)
        low = F.when(at < pad, F.array(-1 - at)).otherwise(F.array().cast("array<int>"))
        high = F.when(at >= n - pad, F.array(2 * n - 1 - at)).otherwise(F.array().cast("array<int>"))
        return F.concat(here, low, high)

    rest = [c for c in pixels.columns if c not in (*keys, "y", "x")]
    up = pixels.select(*keys, *rest, "x", F.explode(places("y", rows)).alias("y"))
    return up.select(*keys, *rest, "y", F.explode(places("x", columns)).alias("x"))


def high_pass(pixels: DataFrame, keys: list[str], rows: int, columns: int, kernel: Kernel, water: str | None = None) -> DataFrame:
    """keys, y, x, hpf: the high-pass image of column value. With a water column also hpf_strict, NULL where water is under the kernel."""
    c, shift = kernel.size // 2, kernel.shift
    wide = reflected(pixels.select(*keys, "y", "x", "value", *([water] if water else [])), keys, rows, columns, c)
    along = Window.partitionBy(*keys, "y").orderBy("x")
    down = Window.partitionBy(*keys, "x").orderBy("y")
    wet = F.when(F.col(water), 1).otherwise(0) if water else F.lit(0)
    x = wide.select(*keys, "y", "x", F.sum("value").over(along.rowsBetween(-c, c)).alias("_b"), F.sum(wet).over(along.rowsBetween(-c, c)).alias("_w"), (F.lag("value", shift).over(along) if shift else F.col("value")).alias("_c"))
    x = x.where(F.col("x").between(0, columns - 1))
    x = x.select(*keys, "y", "x", F.sum("_b").over(down.rowsBetween(-c, c)).alias("_b"), F.sum("_w").over(down.rowsBetween(-c, c)).alias("_w"), (F.lag("_c", shift).over(down) if shift else F.col("_c")).alias("_c"))
    hpf = (kernel.gain + 1) * F.col("_c") - F.col("_b")
    strict = [F.when(F.col("_w") == 0, hpf).alias("hpf_strict")] if water else []
    return x.where(F.col("y").between(0, rows - 1)).select(*keys, "y", "x", hpf.alias("hpf"), *strict)


def fuse(pan: DataFrame, multi: DataFrame, keys: list[str], rows: int, columns: int, ratio: float = 2.0) -> DataFrame:
    """keys, band, y, x, value: the bands of multi sharpened by pan.

    pan: keys, y, x, value, water (boolean); multi: keys, band, y, x, value, on
    the same grid.  The detail of a band is weighted by the ratio of deviations
    (sample deviations, water left out), and its level corrected literally as
    mean(F) * (std(L) / std0(F)) off and mean(L) on.
    """
    kernel = kernel_for(ratio)
    detail = high_pass(pan, keys, rows, columns, kernel, "water")
    mask = pan.select(*keys, "y", "x", "water")
    gain = detail.groupBy(*keys).agg(F.stddev_samp("hpf_strict").alias("_sh"))
    both = multi.join(detail.join(mask, [*keys, "y", "x"]), [*keys, "y", "x"])
    dry = F.when(~F.col("water"), F.col("value"))
    low = both.groupBy(*keys, "band").agg(F.stddev_samp(dry).alias("_sl"), F.avg(dry).alias("_ml"))
    weight = low.join(gain, keys).select(*keys, "band", "_sl", "_ml", (F.col("_sl") / F.col("_sh") * kernel.weight).alias("_g"))
    raw = both.join(weight, [*keys, "band"]).withColumn("_f", F.col("value") + F.col("hpf") * F.col("_g"))
    dry_f = F.when(~F.col("water"), F.col("_f"))
    level = raw.groupBy(*keys, "band").agg(F.avg(dry_f).alias("_mf"), F.stddev_pop(dry_f).alias("_sf"))
    out = raw.join(level, [*keys, "band"])
    return out.select(*keys, "band", "y", "x", (F.col("_f") - F.col("_mf") * (F.col("_sl") / F.col("_sf")) + F.col("_ml")).alias("value"))


#: Which band sharpens which; the other bands pass as they are. Fixed values.
PAIRS = (("B4", "B5"), ("B4", "B6"), ("B8", "B7"), ("B8", "B8A"))
PASSED = ("B2", "B3", "B4", "B8", "B11", "B12")


def masked_gain(pixels: DataFrame, keys: list[str], low: str, high: str, mask: str) -> DataFrame:
    """Ratio of the sample deviations of two columns where mask is false."""
    free = lambda c: F.when(~F.col(mask), F.col(c))
    s = pixels.groupBy(*keys).agg(F.stddev_samp(free(low)).alias("_l"), F.stddev_samp(free(high)).alias("_h"))
    return s.select(*keys, F.when(F.col("_h") != 0, F.col("_l") / F.col("_h")).alias("gain"))


def strip_counts(pixels: DataFrame, strip: str, flag: str) -> DataFrame:
    """Pixels and flagged pixels of each strip."""
    return pixels.groupBy(strip).agg(F.count("*").alias("n"), F.count_if(F.col(flag)).alias("n_flagged"))


def extent(bounds: DataFrame, cell: float = 10.0) -> DataFrame:
    """west, south, east, north of all bounds, and columns and rows of their grid (half-even rounding)."""
    box = bounds.agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))
    size = lambda a, b: F.bround((F.col(b) - F.col(a)) / cell, 0).cast("int")
    return box.select("*", size("west", "east").alias("columns"), size("south", "north").alias("rows"))


def intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Common window of two bounds of a key; disjoint ones are left out."""
    p, q = a.alias("p"), b.alias("q")
    both = p.join(q, F.col(f"p.{key}") == F.col(f"q.{key}")).select(F.col(f"p.{key}").alias(key), *(F.greatest(f"p.{c}", f"q.{c}").alias(c) for c in ("west", "south")), *(F.least(f"p.{c}", f"q.{c}").alias(c) for c in ("east", "north")))
    return both.where("west < east and south < north")


def placed(pixels: DataFrame, west: float, north: float, cell: float = 10.0) -> DataFrame:
    """Adds gx, gy: the cell of coordinates px, py on a mosaic's grid."""
    return pixels.withColumn("gx", F.bround((F.col("px") - west) / cell, 0).cast("int")).withColumn("gy", F.bround((north - F.col("py")) / cell, 0).cast("int"))


def mosaic(cells: DataFrame, keys: list[str], empty_grid: DataFrame | None = None) -> DataFrame:
    """keys, class, prob: per cell the class (not 0) of the greatest probability (above 0), the lower source_rank where they tie.

    One aggregation with a map-side combine; no window over the cells.
    """
    best = F.max_by(F.struct("class", "prob"), F.struct(F.col("prob"), -F.col("source_rank")))
    out = cells.where((F.col("class") != 0) & (F.col("prob") > 0)).groupBy(*keys).agg(best.alias("_x")).select(*keys, "_x.class", "_x.prob")
    if empty_grid is not None:
        out = empty_grid.select(*keys).distinct().join(out, keys, "left").fillna(0, ["class", "prob"])
    return out
