"""Classification metrics from one confusion table.

The pairs are counted once; everything else works on at most classes squared
rows.  Classes are keyed by their codes, never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(rows: DataFrame, gt: str = "gt", pred: str = "pred") -> DataFrame:
    """gt, pred, n of the pairs that occur."""
    return rows.groupBy(F.col(gt).alias("gt"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def filled(counts: DataFrame) -> DataFrame:
    """gt, pred, n with a 0 for the pairs of known classes that do not occur."""
    classes = counts.select(F.col("gt").alias("c")).unionByName(counts.select(F.col("pred").alias("c"))).distinct()
    grid = classes.select(F.col("c").alias("gt")).crossJoin(classes.select(F.col("c").alias("pred")))  # classes, not rows
    return grid.join(counts, ["gt", "pred"], "left").fillna(0, ["n"])


def with_margins(counts: DataFrame) -> DataFrame:
    """gt, pred, n with sums where gt or pred is NULL."""
    return counts.cube("gt", "pred").agg(F.sum("n").alias("n"))


def overall(counts: DataFrame) -> DataFrame:
    """n, accuracy, kappa, error_rate."""
    rows = counts.groupBy(F.col("gt").alias("c")).agg(F.sum("n").alias("r"))
    columns = counts.groupBy(F.col("pred").alias("c")).agg(F.sum("n").alias("k"))
    chance = rows.join(columns, "c").agg(F.sum(F.col("r").cast("double") * F.col("k").cast("double")).alias("pe"))
    total = counts.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0)).alias("ok"))
    both = total.crossJoin(chance)  # one row each
    po, pe = F.col("ok") / F.col("n"), F.col("pe") / (F.col("n").cast("double") * F.col("n").cast("double"))
    return both.select("n", po.alias("accuracy"), F.when(pe != 1, (po - pe) / (1 - pe)).alias("kappa"), (1 - po).alias("error_rate"))


def per_class(counts: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """class, ua, pa (percent, 2 decimals), f1, support.

    A class without predictions (or without truth) has 0; with seen (a column
    class of what training had), a class that only one side has is NULL.
    """
    hits = counts.groupBy(F.col("gt").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0)).alias("hit"))
    said = counts.groupBy(F.col("pred").alias("class")).agg(F.sum("n").alias("said"))
    out = hits.join(said, "class", "full").fillna(0, ["support", "hit", "said"])
    share = lambda a, b: F.when(F.col(b) == 0, F.lit(0.0)).otherwise(F.col(a) / F.col(b))
    ua, pa = share("hit", "said"), share("hit", "support")
    if seen is not None:
        out = out.join(seen.select("class").distinct().withColumn("_t", F.lit(True)), "class", "full").fillna(0, ["support", "hit", "said"])
        both = F.col("_t").isNotNull() & ((F.col("support") > 0) | (F.col("said") > 0))
        ua, pa = F.when(both, ua), F.when(both, pa)
    f1 = F.when(ua + pa > 0, 2 * ua * pa / (ua + pa)).otherwise(F.when(ua.isNotNull(), F.lit(0.0)))
    return out.select("class", F.round(ua * 100, 2).alias("ua"), F.round(pa * 100, 2).alias("pa"), F.round(f1, 6).alias("f1"), F.col("support").cast("long").alias("support"))


def label_sets(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """column, side: labels that only one of the two has ('left' or 'right')."""
    x, y = a.select(column).distinct(), b.select(column).distinct()
    left = x.join(y, column, "left_anti").withColumn("side", F.lit("left"))
    return left.unionByName(y.join(x, column, "left_anti").withColumn("side", F.lit("right")))


def named(rows: DataFrame, nomenclature: DataFrame, code: str = "label") -> DataFrame:
    """rows with the abbreviation of their code; the nomenclature is a small dimension that the planner broadcasts by its size."""
    return rows.join(nomenclature.withColumnRenamed("code", code), code)


def matrix(counts: DataFrame, classes: list[int]) -> DataFrame:
    """The wide matrix: a row for each true class, a column for each of classes."""
    return counts.groupBy("gt").pivot("pred", classes).agg(F.sum("n")).fillna(0)
