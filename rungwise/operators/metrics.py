"""Counts, accuracies, losses and the mean gradient as aggregations."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, functions as F

from rungwise.functions import losses
from rungwise.operators.columns import is_correct


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows and share predicted right in one pass; null on an empty table."""
    hit = F.coalesce(is_correct(label, prediction), F.lit(False)).cast("double")
    return df.agg(F.count("*").alias("rows"), F.avg(hit).alias("accuracy"))


def evaluator_accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> float:
    """The same share through the ML evaluator."""
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName="accuracy"
    ).evaluate(df)


def class_count(df: DataFrame, label: str, approximate: bool = False) -> DataFrame:
    """Number of different labels; a sketch when ``approximate``."""
    count = F.approx_count_distinct(label) if approximate else F.count_distinct(label)
    return df.agg(count.alias("classes"))


def dataset_shape(df: DataFrame, part: str, array: str) -> DataFrame:
    """Rows and array lengths of each part, in one pass."""
    length = F.size(array)
    return df.groupBy(part).agg(
        F.count("*").alias("rows"), F.min(length).alias("min_length"), F.max(length).alias("max_length")
    )


def xent_smoothed(df: DataFrame, probabilities: str, label: str, classes: int, smoothing: float = 0.2) -> DataFrame:
    loss = losses.xent_smoothed(F.col(probabilities), F.col(label), classes, smoothing)
    return df.agg(F.avg(loss).alias("loss"))


def xent_logits(df: DataFrame, scores: str, label: str) -> DataFrame:
    return df.agg(F.avg(losses.xent_logits(F.col(scores), F.col(label))).alias("loss"))


def mse_arrays(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.agg(F.avg(losses.squared_error(F.col(left), F.col(right))).alias("mse"))


def mean_gradient(df: DataFrame, array: str, probabilities: str, label: str, classes: int) -> DataFrame:
    """(class, position, gradient): mean of (p[class] - [label = class]) * x[position].

    A softmax layer's gradient over all rows. Rows are exploded by position
    only, with one average per class beside each other, and merged inside
    every task: the shuffle carries one row per position and task.
    """
    residuals = [
        (F.get(probabilities, F.lit(c)) - (F.col(label) == c).cast("double")).alias(f"r{c}")
        for c in range(classes)
    ]
    cells = df.select(*residuals, F.posexplode_outer(array).alias("position", "x"))
    cells = cells.filter(F.col("position").isNotNull())
    x = F.col("x").cast("double")
    means = cells.groupBy("position").agg(
        *[F.avg(F.col(f"r{c}") * x).alias(f"g{c}") for c in range(classes)]
    )
    by_class = F.array(*[F.col(f"g{c}") for c in range(classes)])
    return means.select(F.posexplode(by_class).alias("class", "gradient"), "position")
