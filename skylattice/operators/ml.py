"""Classifiers and what is made of their probabilities."""

from __future__ import annotations

from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import percent, top_k


def random_forest(trees: int = 100, depth: int = 30, seed: int = 1, **options) -> RandomForestClassifier:
    """A forest with square-root feature subsets and leaves of one row; 30 is the deepest that the library grows."""
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", minInstancesPerNode=1, seed=seed, **options)


def perceptron_head(inputs: int, hidden: int, classes: int, seed: int = 1, rounds: int = 60) -> MultilayerPerceptronClassifier:
    """A dense head over precomputed embeddings, in place of the last layers of a frozen network."""
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", layers=[inputs, hidden, classes], seed=seed, maxIter=rounds)


def save(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def released(model):
    """The model without its training summary, which would take the session along into the tasks that score."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def best_two(probabilities: Column, classes: list[int] | None = None) -> list[Column]:
    """label, prob, label2, prob2: the two best classes as map labels (from 1), probabilities in percent cut off; of equal ones the higher index first."""
    two = top_k(probabilities, 2)
    name = lambda i: (F.get(F.array(*map(F.lit, classes)), i) if classes else i) + 1
    first, second = F.get(two, 0), F.get(two, 1)
    return [name(first["index"]).cast("int").alias("label"), percent(first["score"]).alias("prob"), name(second["index"]).cast("int").alias("label2"), percent(second["score"]).alias("prob2")]


def predict_map(model, rows: DataFrame, keys: list[str], sea: str | None = None, missing: str | None = None) -> DataFrame:
    """keys, label, prob, label2, prob2 of each row.

    Only land goes through the model; sea comes back as label 0 at 100 percent.
    Where the first feature was missing the labels are 0.
    """
    land = rows if sea is None else rows.where(~F.col(sea))
    scored = released(model).transform(land).withColumn("_p", vector_to_array("probability"))
    out = scored.select(*keys, *best_two(F.col("_p")), *([missing] if missing else []))
    if missing:
        out = out.withColumns({c: F.when(F.col(missing), 0).otherwise(F.col(c)) for c in ("label", "label2")}).drop(missing)
    if sea is None:
        return out
    at_sea = rows.where(sea).select(*keys, *(F.lit(v).cast("int").alias(c) for c, v in (("label", 0), ("prob", 100), ("label2", 0), ("prob2", 100))))
    return out.unionByName(at_sea)


def argmax(values: Column) -> Column:
    """Index of the first greatest element, from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
