"""Scalar expressions of the engine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_nan(value: Column) -> Column:
    """NULL for NaN: max, avg and deviations then skip it, as clipping and percentiles do."""
    return F.nanvl(value, F.lit(None).cast("double"))


def unit_clip(value: Column) -> Column:
    """Clipped to [0, 1]; NaN and NULL stay missing (least and greatest alone would make NaN a 1)."""
    return F.when(no_nan(value).isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def normalize(value: Column, scale: float = 10000.0) -> Column:
    """value / scale, clipped to [0, 1]."""
    return unit_clip(value.cast("double") / F.lit(float(scale)))


def normalized_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b), -1 where the sum is 0, moved from [-1, 1] to [0, 1] and clipped."""
    total = a + b
    return unit_clip((F.when(total != 0, (a - b) / total).otherwise(F.lit(-1.0)) + 1) / 2)


#: Spectral indices by their band pairs.
INDICES = {"NDVI": ("B8", "B4"), "NDWI": ("B3", "B8"), "NDBI": ("B11", "B8")}


def spectral_indices(wanted: tuple[str, ...] = ("NDVI", "NDWI", "NDBI")) -> dict[str, Column]:
    """Index columns over band columns, in the given order."""
    return {k: normalized_difference(F.col(INDICES[k][0]), F.col(INDICES[k][1])) for k in wanted}


def classifier_fill(value: Column, fill: float = 65535.0) -> Column:
    """NaN, infinity and NULL to the fill value, before a classifier."""
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(bad, F.lit(fill)).otherwise(value)


def day_ordinal(date: Column, start: Column) -> Column:
    """Days from start, the first being 1."""
    return F.datediff(date, start) + 1


def date_of(ordinal: Column, start: Column) -> Column:
    """The reverse of day_ordinal."""
    return F.date_add(start, (ordinal - 1).cast("int"))


def row_strip(y: Column, rows: int, parts: int) -> Column:
    """Strip of a row; the last one takes the rows left over."""
    return F.least(F.floor(y / (rows // parts)).cast("int"), F.lit(parts - 1))


def nearest(target: Column, source_size: int, target_size: int) -> Column:
    """Source index of a target index, nearest-neighbour."""
    return F.floor(target * source_size / target_size).cast("int")


def utm_zone(wkt: Column) -> Column:
    """Digits after 'zone ' in a CRS text."""
    return F.regexp_extract(wkt, r"zone (\d+)", 1)


def hms(seconds: Column) -> Column:
    """h:mm:ss of a number of seconds, within a day."""
    s = F.pmod(F.floor(seconds).cast("bigint"), F.lit(86400))
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600).cast("int"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("int"), F.pmod(s, F.lit(60)).cast("int"))


def comma_list(text: Column) -> Column:
    """Items of a comma list, without the blanks around them."""
    return F.transform(F.split(text, ","), lambda x: F.trim(x))


def joined_name(*parts: Column) -> Column:
    """A file name from its parameters."""
    return F.concat_ws("_", *parts)


def natural_key(name: Column) -> list[Column]:
    """Sort keys that put S2_9_2 before S2_10_1: runs of text and numbers of any length in turn."""
    runs = lambda k: F.regexp_extract_all(name, F.lit(r"(\D*)(\d*)"), F.lit(k))
    bare = lambda n: F.regexp_replace(n, r"^0+(?=\d)", "")
    number = lambda n: F.when(n == "", "").otherwise(F.concat(F.lpad(F.length(bare(n)).cast("string"), 6, "0"), bare(n)))
    return [F.zip_with(runs(1), runs(2), lambda t, n: F.struct(t.alias("text"), number(n).alias("number")))]


def top_k(scores: Column, k: int) -> Column:
    """The k best (score, index) of an array, best first; of equal scores the higher index first."""
    pairs = F.transform(scores, lambda x, i: F.struct(x.alias("score"), i.alias("index")))
    return F.slice(F.sort_array(pairs, asc=False), 1, k)


def percent(probability: Column) -> Column:
    """100 p as an integer, cut off."""
    return F.floor(probability * 100).cast("int")


def any_of(value: Column, parts: list[str]) -> Column:
    """Does the text contain one of the parts?"""
    return reduce(lambda a, b: a | b, (value.contains(p) for p in parts), F.lit(False))

