"""Feature tables and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import classifier_fill, normalize


def labelled(features: DataFrame, labels: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Features of labelled pixels (label above 0, from 0 on), without those that miss any of columns."""
    out = features.join(labels.where("label > 0").withColumn("label", F.col("label") - 1), keys)
    good = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns), F.lit(True))
    return out.where(good)


def stack(series: DataFrame, keys: list[str], feature: str, wanted: list[str], value: str) -> DataFrame:
    """A column for each wanted feature: with the list given, no pass over the data looks for it."""
    return series.groupBy(*keys).pivot(feature, wanted).agg(F.sum(value))


def auxiliary(rows: DataFrame, value: str, norm: float) -> DataFrame:
    """value / norm clipped to [0, 1], in training and in prediction alike."""
    return rows.withColumn(value, normalize(F.col(value), norm))


def vstack(*parts: DataFrame) -> DataFrame:
    """All rows of the parts, columns by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def for_classifier(rows: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    """A vector of the columns with missing values filled, and missing: was the first one missing? Its label is 0 then."""
    first = F.col(columns[0]).cast("double")
    missing = first.isNull() | F.isnan(first) | (F.abs(first) == float("inf"))
    filled = F.array(*(classifier_fill(F.col(c).cast("double")) for c in columns))
    return rows.withColumn("missing", missing).withColumn(output, array_to_vector(filled))
