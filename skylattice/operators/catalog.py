"""Scene catalogue: names to columns, completeness, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_of
from ..schema import BANDS_10M, BANDS_20M


def parse_scene(path: Column) -> Column:
    """struct(scene_id, date, tile) of a scene folder's name, fields split by '_': the second begins with the date, the fourth is T and the tile."""
    name = F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
    fields = F.split(name, "_")
    date = F.to_date(F.get(F.split(F.get(fields, 1), "-"), 0), "yyyyMMdd")
    return F.struct(name.alias("scene_id"), date.alias("date"), F.substring(F.get(fields, 3), 2, 20).alias("tile"))


def band_of(path: Column) -> Column:
    """Band (or mask) of a file from the last field of its name: exact, so that B8 is never taken for B8A."""
    base = F.regexp_extract(path, r"([^/]+)\.tif$", 1)
    return F.when(base.rlike("_CLM_R[12]$"), F.regexp_extract(base, r"(CLM_R[12])$", 1)).otherwise(F.element_at(F.split(base, "_"), -1))


def scene_list(files: DataFrame) -> DataFrame:
    """tile, date, scene_id, path of each folder with '_L2A_' in its name that directly holds a .tif. files: column path."""
    rows = files.where(F.col("path").endswith(".tif")).select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("path"))
    rows = rows.where(F.element_at(F.split("path", "/"), -1).contains("_L2A_")).distinct()
    return rows.withColumn("s", parse_scene(F.col("path"))).select("s.tile", "s.date", "s.scene_id", "path")


def matching_files(files: DataFrame, parts: list[str]) -> DataFrame:
    """.tif files whose path has one of the parts, once each."""
    return files.where(F.col("path").endswith(".tif") & any_of(F.col("path"), parts)).select("path").distinct()


def band_subset(files: DataFrame, bands: tuple[str, ...] = BANDS_10M + BANDS_20M) -> DataFrame:
    """Files of the given bands."""
    return files.where(F.col("band").isin(*bands))


def exactly_one(files: DataFrame, key: str, pattern: str) -> DataFrame:
    """The one file of each key that matches; a job fails on none or several."""
    found = files.groupBy(key).agg(F.count_if(F.col("path").rlike(pattern)).alias("n"), F.min(F.when(F.col("path").rlike(pattern), F.col("path"))).alias("path"))
    checked = F.when(F.col("n") == 1, F.col("path")).otherwise(F.raise_error(F.concat(F.lit("files that match for "), F.col(key).cast("string"), F.lit(": "), F.col("n").cast("string"))).cast("string"))
    return found.select(key, checked.alias("path"))


def first_match(files: DataFrame, key: str, pattern: str) -> DataFrame:
    """The first path, in order, of each key that matches."""
    return files.where(F.col("path").rlike(pattern)).groupBy(key).agg(F.min("path").alias("path"))


def in_range(rows: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows dated from start to end, both included: a range that prunes partitions and row groups."""
    return rows.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def complete(items: DataFrame, keys: list[str], item: str, wanted: list[str]) -> DataFrame:
    """Keys that have every wanted item, with the number of rows."""
    rows = items.where(F.col(item).isin(*wanted))
    return rows.groupBy(*keys).agg(F.count_distinct(item).alias("k"), F.count("*").alias("n")).where(F.col("k") == len(set(wanted))).drop("k")


def missing(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Expected keys that were not observed."""
    return expected.join(observed.select(*keys).distinct(), keys, "left_anti")


def duplicates(rows: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Keys that occur at least so often."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def same_count(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose row counts differ between two inputs, with both counts: empty if the inputs agree."""
    a = left.groupBy(*keys).agg(F.count("*").alias("n_left"))
    b = right.groupBy(*keys).agg(F.count("*").alias("n_right"))
    both = a.join(b, keys, "full").fillna(0, ["n_left", "n_right"])
    return both.where("n_left <> n_right")


def with_fallback_mask(tiles: DataFrame, masks: DataFrame, allowed: list[str]) -> DataFrame:
    """Mask flags of each pixel; a tile without a mask counts as all 0 if it is allowed to lack one, else the job fails."""
    out = tiles.join(masks, ["tile", "y", "x"], "left")
    absent = F.raise_error(F.concat(F.lit("no mask for tile "), F.col("tile"))).cast("int")
    return out.withColumn("flag", F.when(F.col("flag").isNotNull(), F.col("flag")).when(F.col("tile").isin(*allowed), F.lit(0)).otherwise(absent))
