"""New observations as they arrive: daily valid counts and completeness, with late scenes up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def observations(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream of the observation files of a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def daily(stream: DataFrame, time: str, keys: list[str], value: str, late: str = "2 days") -> DataFrame:
    """Per day and keys: observations and their mean; a day is final once the watermark has passed it."""
    rows = stream.withWatermark(time, late)
    return rows.groupBy(F.window(time, "1 day").alias("day"), *keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(F.to_date("day.start").alias("day"), *keys, "n", "mean")
