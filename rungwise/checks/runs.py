"""Run-log and history analytics; the events table stands in for the logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from rungwise.checks.inputs import table
from rungwise.checks.registry import query
from rungwise.operators import runs


def log(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")


@query(
    "scale_factor",
    """SELECT event_id, user_id, value AS dt,
           round(value / first_value(value) OVER (PARTITION BY user_id ORDER BY ts), 6) AS scale
    FROM events""",
)
def scale_factor(spark, sf_dir):
    scaled = runs.scale_factor(log(spark, sf_dir), "user_id", "ts", "value")
    return scaled.select("event_id", "user_id", F.col("value").alias("dt"), F.round("scale", 6).alias("scale"))


@query(
    "dataset_size",
    """SELECT event_id AS m, value AS dt, event_id * 32561 * 14 * 32 AS size_bits,
           event_id * 1272824 / 1000000 AS size_mb
    FROM events""",
)
def dataset_size(spark, sf_dir):
    df = log(spark, sf_dir).select(F.col("event_id").alias("m"), F.col("value").alias("dt"))
    return runs.dataset_size(df, "m")


@query(
    "node_comparison",
    """SELECT CAST(user_id % 5 AS INTEGER) AS nodes, max_by(value, event_id) AS last_dt
    FROM events GROUP BY 1""",
)
def node_comparison(spark, sf_dir):
    df = log(spark, sf_dir).withColumn("nodes", (F.col("user_id") % 5).cast("int"))
    return runs.node_comparison(df, "nodes", "event_id", "value")


@query(
    "accuracy_by_size",
    "SELECT user_id, event_id * 1272824 / 1000000 AS size_mb, value / 1000 AS accuracy FROM events",
)
def accuracy_by_size(spark, sf_dir):
    df = log(spark, sf_dir).withColumn("a", F.col("value") / 1000)
    return runs.accuracy_by_size(df, "user_id", "event_id", "a")


@query(
    "history_long",
    """WITH history AS (
        SELECT event_id AS epoch, value / 1000 AS accuracy, value / 2000 AS val_accuracy, 1 - value / 1000 AS loss
        FROM events)
    SELECT epoch, 'accuracy' AS metric, accuracy AS value FROM history
    UNION ALL SELECT epoch, 'val_accuracy', val_accuracy FROM history
    UNION ALL SELECT epoch, 'loss', loss FROM history""",
)
def history_long(spark, sf_dir):
    value = F.col("value")
    history = log(spark, sf_dir).select(
        F.col("event_id").alias("epoch"),
        (value / 1000).alias("accuracy"),
        (value / 2000).alias("val_accuracy"),
        (1 - value / 1000).alias("loss"),
    )
    return runs.history_long(history, "epoch", ["accuracy", "val_accuracy", "loss"])


@query(
    "best_checkpoint",
    """WITH steps AS (
        SELECT event_id, user_id, value,
               max(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
        FROM events)
    SELECT event_id, user_id, value, value = max(value) OVER (PARTITION BY user_id) AS kept
    FROM steps QUALIFY best IS NULL OR value > best""",
)
def best_checkpoint(spark, sf_dir):
    # ts is unique; its microseconds are the numeric step.
    step = F.unix_micros(F.col("ts").cast("timestamp")).alias("step")
    df = log(spark, sf_dir).select("event_id", "user_id", "value", step)
    return runs.best_checkpoint(df, "user_id", "step", "value").select("event_id", "user_id", "value", "kept")
