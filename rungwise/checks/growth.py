"""Unions and copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from rungwise.checks.inputs import table
from rungwise.checks.registry import query
from rungwise.operators import growth


@query(
    "union_all",
    """SELECT c_custkey, c_nationkey, c_acctbal FROM customer
    UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT c_custkey, c_nationkey, c_acctbal FROM customer""",
)
def union_all(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return growth.union_all(customers, suppliers, customers)


@query(
    "bag_multiply",
    """SELECT c_custkey, count(*) AS copies, min(c_acctbal) = max(c_acctbal) AS same, 30 AS last_copy
    FROM customer, range(31) GROUP BY c_custkey""",
)
def bag_multiply(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    copies = growth.bag_multiply(customers, 31, copy="copy")
    return copies.groupBy("c_custkey").agg(
        F.count("*").alias("copies"),
        (F.min("c_acctbal") == F.max("c_acctbal")).alias("same"),
        F.max("copy").alias("last_copy"),
    )


@query(
    "scaling_ladder",
    """SELECT CAST(i + 1 AS INTEGER) AS m, (i + 1) * (SELECT count(*) FROM customer) AS rows
    FROM range(0, 200, 10) AS r(i)""",
)
def scaling_ladder(spark, sf_dir):
    rungs = growth.scaling_ladder(table(spark, sf_dir, "customer").select("c_custkey"), max_m=200, step=10)
    return growth.union_all(*[df.agg(F.lit(m).alias("m"), F.count("*").alias("rows")) for m, df in rungs])
