"""Splits, folds, order and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from rungwise import session
from rungwise.checks.inputs import hash_sql, table
from rungwise.checks.registry import query
from rungwise.operators import splits

ORDER_HASH = hash_sql("o_orderkey")


def order_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")


@query("random_split", "SELECT count(*) AS total_rows, 0::BIGINT AS in_both, 0::BIGINT AS in_neither FROM orders")
def random_split(spark, sf_dir):
    df = order_keys(spark, sf_dir)
    train, test = splits.random_split(df, [0.7, 0.3], seed=42)
    whole = df.select("o_orderkey", F.lit(0).alias("times"))
    parts = [part.select("o_orderkey", F.lit(1).alias("times")) for part in (train, test)]
    seen = whole.union(parts[0]).union(parts[1]).groupBy("o_orderkey").agg(F.sum("times").alias("times"))
    return seen.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("times") > 1).alias("in_both"),
        F.count_if(F.col("times") == 0).alias("in_neither"),
    )


@query(
    "hash_split",
    f"""SELECT o_orderkey, CASE WHEN {ORDER_HASH} < 0.7 * 4294967296 THEN 'train' ELSE 'test' END AS part
    FROM orders""",
)
def hash_split(spark, sf_dir):
    train, test = splits.hash_split(order_keys(spark, sf_dir).select("o_orderkey"), "o_orderkey")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    "two_thirds_split",
    f"""SELECT o_orderkey, CASE WHEN {ORDER_HASH} < 4294967296 * 2.0 / 3.0 THEN 'train' ELSE 'test' END AS part
    FROM orders""",
)
def two_thirds_split(spark, sf_dir):
    train, test = splits.two_thirds_split(order_keys(spark, sf_dir).select("o_orderkey"), "o_orderkey")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    "head_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= 5000 THEN 'valid' ELSE 'train' END AS part
    FROM orders""",
)
def head_split(spark, sf_dir):
    valid, train = splits.head_split(order_keys(spark, sf_dir).select("o_orderkey"), "o_orderkey", 5000)
    return valid.withColumn("part", F.lit("valid")).union(train.withColumn("part", F.lit("train")))


@query(
    "kfold_assign",
    f"SELECT o_orderkey, CAST(floor({hash_sql("o_orderkey", draw=splits.FOLD_DRAW)} * 5 / 4294967296) AS INTEGER) AS fold FROM orders",
)
def kfold_assign(spark, sf_dir):
    return splits.kfold_assign(order_keys(spark, sf_dir).select("o_orderkey"), "o_orderkey")


@query(
    "shuffle_rows",
    f"""SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY {hash_sql("o_orderkey", 42)}) AS position
    FROM orders""",
)
def shuffle_rows(spark, sf_dir):
    return splits.shuffle_rows(order_keys(spark, sf_dir), "o_orderkey", seed=42)


@query(
    "batch_assign",
    f"""SELECT o_orderkey, (row_number() OVER (ORDER BY {hash_sql("o_orderkey", 42)}) - 1) // 64 AS batch_id
    FROM orders""",
)
def batch_assign(spark, sf_dir):
    return splits.batch_assign(
        order_keys(spark, sf_dir).select("o_orderkey"), "o_orderkey", batch_size=64, seed=42
    )


@query(
    "cache_table",
    "SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY ALL",
)
def cache_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice")
    with session.cached(orders) as kept:
        sums = kept.groupBy("o_orderpriority").agg(
            F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value")
        )
        rows = sums.collect()  # one row per priority, taken while the rows are kept
    return spark.createDataFrame(rows, sums.schema)
