"""The processing chains, from tables of pixels to maps."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import catalog, features, merge, metrics, ml, spatial, temporal
from ..schema import BANDS_10M, BANDS_20M, NODATA
from . import jobs


def virtual_dates(pixels: DataFrame, clouds: DataFrame, sea: DataFrame, start: str, output_start: str, output_end: str, interval: int, bands: tuple[str, ...] = BANDS_10M, min_obs: int | None = None, compat: bool = False) -> DataFrame:
    """tile, band, y, x, t, value: clear observations interpolated onto a regular grid of dates.

    pixels: tile, date, band, y, x, value; clouds: tile, date, y, x, clm; sea:
    tile, y, x, flag (1: sea).  Dates that lack a band are dropped for their
    tile.  Sea pixels leave before the shuffle and come back as 0.
    """
    least = min_obs if min_obs is not None else (2 * len(bands) + 1 if set(bands) <= set(BANDS_20M) else 3)
    rows = pixels.where(F.col("band").isin(*bands))
    whole = catalog.complete(rows.select("tile", "date", "band").distinct(), ["tile", "date"], "band", list(bands)).select("tile", "date")
    rows = rows.join(whole, ["tile", "date"], "left_semi").join(clouds, ["tile", "date", "y", "x"], "left")
    wet = sea.where(merge.is_sea(F.col("flag")))
    land = rows.join(wet.select("tile", "y", "x"), ["tile", "y", "x"], "left_anti")
    flagged = temporal.valid_observations(land, ["tile", "date", "y", "x"], NODATA, compat, bands[0])
    origin = F.lit(start).cast("date")
    first = C.day_ordinal(F.lit(output_start).cast("date"), origin)
    last = C.day_ordinal(F.lit(output_end).cast("date"), origin)
    series = flagged.select("tile", "band", "y", "x", C.day_ordinal(F.col("date"), origin).alias("t"), F.when(F.col("valid"), F.col("value")).alias("value"))
    out = temporal.interpolate(series, ["tile", "band", "y", "x"], "t", "value", F.sequence(first, last, F.lit(interval)), least)
    out = out.withColumn("value", F.col("value").cast("int"))  # cut off, as an integer cell does
    names = F.explode(F.array(*map(F.lit, bands))).alias("band")
    empty = wet.select("tile", names, "y", "x").select("*", F.explode(F.sequence(first, last, F.lit(interval))).alias("t"), F.lit(0).alias("value"))
    return out.unionByName(empty)


def sharpened(cube: DataFrame, water: DataFrame, sea: DataFrame, rows: int, columns: int, ratio: float = 2.0) -> DataFrame:
    """tile, t, band, y, x, value: 20 m bands sharpened by their 10 m partners, the others as they are; sea is nodata."""
    keys = ["tile", "t"]
    wet = water.select("tile", "y", "x", (F.col("flag") == 1).alias("water"))
    parts = [cube.where(F.col("band").isin(*spatial.PASSED)).select(*keys, "band", "y", "x", F.col("value").cast("double").alias("value"))]
    for pan_band in sorted({p for p, _ in spatial.PAIRS}):
        wanted = [m for p, m in spatial.PAIRS if p == pan_band]
        pan = cube.where(F.col("band") == pan_band).join(wet, ["tile", "y", "x"], "left").select(*keys, "y", "x", "value", F.coalesce("water", F.lit(False)).alias("water"))
        parts.append(spatial.fuse(pan, cube.where(F.col("band").isin(*wanted)), keys, rows, columns, ratio))
    out = features.vstack(*parts).join(sea.select("tile", "y", "x", "flag"), ["tile", "y", "x"], "left")
    at_sea = F.coalesce(merge.is_sea(F.col("flag")), F.lit(False))
    return out.select(*keys, "band", "y", "x", merge.fill_sharpened(F.col("value").cast("int"), at_sea).alias("value"))


def temporal_features(cube: DataFrame, bands: list[str], indices: tuple[str, ...] = ("NDVI", "NDWI", "NDBI")) -> DataFrame:
    """tile, y, x and nine statistics of each band and index over time (columns 'statistic feature')."""
    keys = ["tile", "y", "x"]
    wide = cube.groupBy(*keys, "t").pivot("band", bands).agg(F.first("value"))
    wide = wide.select(*keys, "t", *(C.normalize(F.col(b)).alias(b) for b in bands))
    wide = wide.withColumns(C.spectral_indices(indices))
    names = [*bands, *indices]
    long = wide.select(*keys, F.explode(F.array(*(F.struct(F.lit(n).alias("feature"), F.col(n).alias("v")) for n in names))).alias("f")).select(*keys, "f.feature", "f.v")
    return temporal.statistics_wide(long, keys, "feature", names, "v")


def train_and_evaluate(table: DataFrame, labels: DataFrame, columns: list[str], estimator=None):
    """(model, overall metrics, metrics of each class): trained on split 'train', evaluated on 'test'."""
    rows = features.for_classifier(features.labelled(table, labels, ["tile", "y", "x"], columns), columns)
    model = ml.released((estimator or ml.random_forest()).fit(rows.where("split = 'train'")))
    tested = model.transform(rows.where("split = 'test'")).select(F.col("label").alias("gt"), F.col("prediction").cast("int").alias("pred"))
    counts = metrics.confusion(tested)
    counts = rows.sparkSession.createDataFrame(counts.collect(), counts.schema)  # classes squared rows: the test rows are scored once
    seen = rows.where("split = 'train'").select(F.col("label").alias("class"))
    return model, metrics.overall(counts), metrics.per_class(counts, seen)


def class_map(model, table: DataFrame, columns: list[str], sea: DataFrame) -> DataFrame:
    """tile, y, x, label, prob, label2, prob2; here sea is 0 in the mask."""
    rows = features.for_classifier(table, columns).join(sea, ["tile", "y", "x"], "left")
    rows = rows.withColumn("sea", F.coalesce(merge.is_sea(F.col("flag"), 0), F.lit(False)))
    return ml.predict_map(model, rows, ["tile", "y", "x"], sea="sea", missing="missing")


def mosaic(maps: DataFrame, rank: Column, west: float = 300000.0, north: float = 4720000.0) -> DataFrame:
    """gx, gy, class, prob of maps with map coordinates px, py; where probabilities tie the lower rank wins."""
    cells = spatial.placed(maps, west, north).select("gx", "gy", F.col("label").alias("class"), "prob", rank.alias("source_rank"))
    return spatial.mosaic(cells, ["gx", "gy"])


#: Folders of a table of strips, whatever the number of strips, and their column.
STRIP_FOLDERS, STRIP_FOLDER = 64, "strip_folder"


def write_strips(rows: DataFrame, path: str, keys: tuple[str, ...] = ("tile", "strip")) -> None:
    """Replaces the strips that rows has and no others; one writer at a time.

    Strips are dealt to a bounded number of folders by the hash of their keys, so
    the number of files does not grow with that of the strips.  Folders that rows
    has strips of are written anew, with what they held of other strips.
    """
    spark = rows.sparkSession
    where = F.pmod(F.hash(*keys), F.lit(STRIP_FOLDERS)).alias(STRIP_FOLDER)
    put = lambda df: df.hint("rebalance", F.col(STRIP_FOLDER)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(STRIP_FOLDER).parquet(path)
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "*=*")
    if not made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(made):
        put(rows.select("*", where))
        return
    old = spark.read.parquet(path)
    if dict(old.dtypes) != dict([*rows.dtypes, (STRIP_FOLDER, "int")]):
        raise ValueError(f"the table has the columns {old.dtypes}, the new strips have {rows.dtypes}")
    staged = f"{path.rstrip('/')}/_new"  # rows are made once; a name that readers of the table pass over
    rows.select("*", where).write.mode("overwrite").parquet(staged)
    try:
        new = spark.read.parquet(staged)
        strips = new.select(STRIP_FOLDER, *keys).distinct()
        same = reduce(and_, (old[k].eqNullSafe(strips[k]) for k in (STRIP_FOLDER, *keys)))
        touched = [r[0] for r in new.select(STRIP_FOLDER).distinct().collect()]
        put(old.where(F.col(STRIP_FOLDER).isin(touched)).join(strips, same, "left_anti").unionByName(new))
    finally:
        jobs.clean_up(spark, staged, confirmed=True)
