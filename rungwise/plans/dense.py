"""Dense classifiers: a multilayer perceptron and data-parallel softmax training."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rungwise.functions import losses
from rungwise.plans.network import network_fit
from rungwise.plans.prepare import FEATURES, INDEXED_LABEL


def array_examples(df: DataFrame, array: str, label: str) -> DataFrame:
    """Array rows under the names the estimators use."""
    return df.withColumns(
        {FEATURES: array_to_vector(F.col(array).cast("array<double>")), INDEXED_LABEL: F.col(label)}
    )


def mlp_fit(
    df: DataFrame, inputs: int, classes: int, hidden: tuple[int, ...] = (64,), seed: int = 42, iterations: int = 50
) -> MultilayerPerceptronClassificationModel:
    """A dense network on the whole table (sigmoid layers, L-BFGS)."""
    return MultilayerPerceptronClassifier(
        labelCol=INDEXED_LABEL,
        featuresCol=FEATURES,
        layers=[inputs, *hidden, classes],
        seed=seed,
        maxIter=iterations,
    ).fit(df)


class SoftmaxModel:
    """A softmax layer: classes x (inputs + 1) weights, the last column the bias."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def score(self, df: DataFrame, array: str, output: str = "probability", prediction: str = "prediction") -> DataFrame:
        """Add class probabilities and the most likely class (the first of equals); null for a null array."""
        rows = F.lit([[float(v) for v in row[:-1]] for row in self.weights])
        bias = F.lit([float(row[-1]) for row in self.weights])

        def logit(weights: Column, own: Column) -> Column:
            products = F.zip_with(weights, F.col(array), lambda w, x: w * x.cast("double"))
            return own + F.aggregate(products, F.lit(0.0), lambda total, v: total + v)

        logits = F.when(F.col(array).isNotNull(), F.zip_with(rows, bias, logit))
        scored = df.withColumn(output, losses.softmax(logits))
        first = F.array_position(output, F.array_max(output)) - 1
        return scored.withColumn(prediction, first.cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per class; replaces what ``path`` had."""
        rows = [(k, [float(v) for v in row]) for k, row in enumerate(self.weights)]
        spark.createDataFrame(rows, "class int, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SoftmaxModel:
        return cls(np.array([r["weights"] for r in spark.read.parquet(path).orderBy("class").collect()]))


def softmax_roundtrip(df: DataFrame, model: SoftmaxModel, array: str, path: str) -> DataFrame:
    """Save, load, score again in one pass: (rows, differing), and ``differing`` must be 0."""
    model.save(df.sparkSession, path)
    again = SoftmaxModel.load(df.sparkSession, path)
    twice = again.score(model.score(df, array, "_p", "_first"), array, "_q", "_second")
    same = F.col("_p").eqNullSafe(F.col("_q")) & F.col("_first").eqNullSafe(F.col("_second"))
    return twice.agg(F.count("*").alias("rows"), F.count_if(~same).alias("differing"))


def softmax_fit(
    train: DataFrame,
    valid: DataFrame,
    key: str,
    array: str,
    label: str,
    inputs: int,
    classes: int,
    epochs: int = 3,
    batch_size: int = 64,
    replicas: int = 1,
    **settings,
) -> tuple[SoftmaxModel, DataFrame]:
    """Mini-batch training of a softmax layer; returns the model and the history.

    A network without hidden layers, see ``network_fit``. A batch holds ``batch_size * replicas``
    rows: steps follow one another, so let the replicas grow with the cluster.
    """
    network, history = network_fit(
        train, valid, key, array, label, inputs, classes, hidden=(), epochs=epochs, batch_size=batch_size * replicas, **settings
    )
    return SoftmaxModel(network.flat.reshape(classes, inputs + 1)), history
