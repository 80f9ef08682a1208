"""Merging: duplicate acquisitions, sea and other fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import NODATA


def merge_duplicates(pixels: DataFrame, date_keys: list[str], acquisition: str, pixel_keys: list[str], nodata: Column, value: str) -> DataFrame:
    """One value for each date and pixel: of the acquisitions of a date, in the order of their nodata counts (then of their names), the first that has data, else the base's own nodata.

    Any number of acquisitions of a date fold in one aggregation per pixel; the
    nodata counts are one row an acquisition.
    """
    ranked = pixels.withColumn("_nodata", nodata)
    counts = ranked.groupBy(*date_keys, acquisition).agg(F.count_if("_nodata").alias("_count"))
    rows = ranked.join(counts, [*date_keys, acquisition])
    order = F.struct(F.col("_nodata").cast("int"), F.col("_count"), F.col(acquisition))
    base = F.struct(F.col("_count"), F.col(acquisition))
    return rows.groupBy(*date_keys, *pixel_keys).agg(F.min_by(value, order).alias(value), F.min_by(acquisition, base).alias("base"), F.min_by(acquisition, order).alias("taken_from"))


def nodata_count(pixels: DataFrame, keys: list[str], nodata: Column) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.count_if(nodata).alias("n_nodata"), F.count("*").alias("n"))


def is_sea(flag: Column, sea_value: int = 1) -> Column:
    """Masks come in two polarities: 1 is sea for image processing, 0 for prediction maps."""
    return flag == sea_value


def fill_virtual(value: Column, sea: Column) -> Column:
    """Sea and pixels without a fit are 0 on virtual dates."""
    return F.when(sea | value.isNull(), F.lit(0)).otherwise(value)


def fill_sharpened(value: Column, sea: Column) -> Column:
    """Below 0 is 0, then sea (and what could not be computed) is nodata."""
    return F.when(sea | value.isNull(), F.lit(NODATA)).when(value < 0, F.lit(0)).otherwise(value)


def fill_prediction(rows: DataFrame, sea: Column) -> DataFrame:
    """Sea gets label 0 at 100 percent, twice, however the pixels are laid out."""
    out = rows
    for column, at_sea in (("label", 0), ("prob", 100), ("label2", 0), ("prob2", 100)):
        out = out.withColumn(column, F.when(sea, F.lit(at_sea)).otherwise(F.col(column)))
    return out
