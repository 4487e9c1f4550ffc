"""Counts, accuracies, losses and the mean gradient."""

from __future__ import annotations

from pyspark.sql import functions as F

from rungwise.checks.inputs import (
    CELLS,
    CLASSES,
    GRID,
    RULED_ORDERS,
    SCORED,
    hash_sql,
    ruled_orders,
    scored_images,
    table,
)
from rungwise.checks.registry import query
from rungwise.functions import images, losses
from rungwise.operators import metrics
from rungwise.operators.columns import filter_correct
from rungwise.operators.splits import split_part


@query(
    "row_count",
    f"""WITH {RULED_ORDERS}
    SELECT 'all' AS part, count(*) AS rows FROM ruled
    UNION ALL SELECT 'correct', count(*) FROM ruled WHERE label = prediction""",
)
def row_count(spark, sf_dir):
    df = ruled_orders(spark, sf_dir)
    every = metrics.row_count(df).withColumn("part", F.lit("all"))
    correct = metrics.row_count(filter_correct(df, "label")).withColumn("part", F.lit("correct"))
    return every.unionByName(correct)


@query(
    "accuracy",
    f"""WITH {RULED_ORDERS}
    SELECT count(*) AS rows, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM ruled""",
)
def accuracy(spark, sf_dir):
    return metrics.accuracy(ruled_orders(spark, sf_dir), "label").withColumn("accuracy", F.round("accuracy", 6))


@query(
    "evaluator_accuracy",
    f"""WITH {RULED_ORDERS}
    SELECT round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM ruled""",
)
def evaluator_accuracy(spark, sf_dir):
    share = metrics.evaluator_accuracy(ruled_orders(spark, sf_dir), "label")
    return spark.createDataFrame([(round(share, 6),)], "accuracy double")


@query("class_count", "SELECT count(DISTINCT label) AS classes FROM embeddings")
def class_count(spark, sf_dir):
    return metrics.class_count(table(spark, sf_dir, "embeddings"), "label")


@query(
    "dataset_shape",
    f"""SELECT CASE WHEN {hash_sql("vec_id")} < 0.7 * 4294967296 THEN 'train' ELSE 'test' END AS part,
           count(*) AS rows, CAST(min(len(embedding)) AS INTEGER) AS min_length,
           CAST(max(len(embedding)) AS INTEGER) AS max_length
    FROM embeddings GROUP BY 1""",
)
def dataset_shape(spark, sf_dir):
    parts = split_part(table(spark, sf_dir, "embeddings"), "vec_id")
    return metrics.dataset_shape(parts, "part", "embedding")


@query(
    "xent_smoothed",
    f"""WITH {SCORED},
    per_row AS (
        SELECT vec_id, -sum((CAST(class = label AS INTEGER) * 0.8 + 0.02) * ln(greatest(p, 1e-7))) AS loss
        FROM scored GROUP BY vec_id)
    SELECT round(avg(loss), 6) AS loss FROM per_row""",
)
def xent_smoothed(spark, sf_dir):
    df = scored_images(spark, sf_dir).withColumn("p", losses.softmax(F.col("scores")))
    return metrics.xent_smoothed(df, "p", "label", CLASSES, 0.2).select(F.round("loss", 6).alias("loss"))


@query(
    "xent_logits",
    f"""WITH {SCORED},
    per_row AS (
        SELECT vec_id, ln(sum(exp(score))) - sum(CASE WHEN class = label THEN score END) AS loss
        FROM scored GROUP BY vec_id)
    SELECT round(avg(loss), 6) AS loss FROM per_row""",
)
def xent_logits(spark, sf_dir):
    df = scored_images(spark, sf_dir)
    return metrics.xent_logits(df, "scores", "label").select(F.round("loss", 6).alias("loss"))


@query(
    "mse_arrays",
    f"""WITH {CELLS}
    SELECT round(avg((a.x::DOUBLE - b.x::DOUBLE) * (a.x::DOUBLE - b.x::DOUBLE)), 6) AS mse
    FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND b.position = a.position // 8 * 8 + 7 - a.position % 8""",
)
def mse_arrays(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    mirrored = df.withColumn("mirrored", images.flip(F.col("embedding"), GRID))
    return metrics.mse_arrays(mirrored, "embedding", "mirrored").select(F.round("mse", 6).alias("mse"))


@query(
    "mean_gradient",
    f"""WITH {CELLS}
    SELECT CAST(c AS INTEGER) AS class, position,
           round(avg((0.1::DOUBLE - CASE WHEN label = c THEN 1 ELSE 0 END) * x::DOUBLE), 6) + 0.0 AS gradient
    FROM cells, range(10) AS k(c) GROUP BY c, position""",
)
def mean_gradient(spark, sf_dir):
    even = F.array_repeat(F.lit(1.0 / CLASSES), CLASSES)
    df = table(spark, sf_dir, "embeddings").withColumn("p", even)
    gradient = metrics.mean_gradient(df, "embedding", "p", "label", CLASSES)
    return gradient.withColumn("gradient", F.round("gradient", 6))
