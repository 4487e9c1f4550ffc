"""Stand-in inputs derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rungwise.functions.hashing import FOLD, LOW_32, MIX, hash_constant
from rungwise.functions.images import Shape
from rungwise.operators.census import label_threshold
from rungwise.operators.columns import feature_layout
from rungwise.operators.splits import hash_split
from rungwise.plans.prepare import apply_features, fit_features

GRID = Shape(8, 8, 1)
CLASSES = 10
THRESHOLD = 250000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sql(key: str, seed: int = 0, draw: int = 0) -> str:
    """``row_hash`` of a key that is not null."""
    folded = f"xor(({key}) & {LOW_32}, ((({key}) >> 32) & {LOW_32}) * {FOLD} & {LOW_32})"
    value = f"xor({folded}, {hash_constant(seed, draw)})"
    for _ in range(2):
        value = f"(xor({value}, ({value}) >> 16) * {MIX} & {LOW_32})"
    return f"xor({value}, {value} >> 16)"


def amount_sql(key: str, limit: float, seed: int = 0, draw: int = 0) -> str:
    return f"(({hash_sql(key, seed, draw)}::DOUBLE / 4294967296.0::DOUBLE * 2.0::DOUBLE - 1.0::DOUBLE) * {limit!r}::DOUBLE)"


# Orders with gaps: nulls in a number and in a string, and unknowns.
def gapped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 13 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(key % 11 == 0, "?").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_totalprice") > THRESHOLD, ">250K").otherwise("<=250K").alias("label"),
    )


GAPPED_ORDERS = """gapped AS (
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 11 = 0 THEN '?' ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN o_totalprice > 250000 THEN '>250K' ELSE '<=250K' END AS label
    FROM orders)"""


# Orders with a 0/1 label and a rule in place of a model's prediction.
def ruled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") > THRESHOLD).cast("int").alias("label"),
        (F.col("o_orderkey") % 3 == 0).cast("double").alias("prediction"),
    )


RULED_ORDERS = """ruled AS (
    SELECT o_orderkey,
           CAST(o_totalprice > 250000 AS INTEGER) AS label,
           CAST(o_orderkey % 3 = 0 AS INTEGER)::DOUBLE AS prediction
    FROM orders)"""


# Orders beside their customer: text, numbers, label last.
def small_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    columns = ["o_orderkey", "o_orderstatus", "c_nationkey", "o_orderpriority", "c_acctbal", "c_mktsegment"]
    return label_threshold(joined, "o_totalprice", THRESHOLD).select(*columns, "label")


SMALL_CENSUS = """census AS (
    SELECT o_orderkey, o_orderstatus, c_nationkey, o_orderpriority, c_acctbal, c_mktsegment,
           CASE WHEN o_totalprice > 250000 THEN '>250K' ELSE '<=250K' END AS label
    FROM orders JOIN customer ON o_custkey = c_custkey)"""


def rank_sql(source: str, column: str) -> str:
    """Category to rank: falling frequency, then rising value."""
    return (
        f"(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS rank"
        f" FROM {source} GROUP BY {column})"
    )


# The census shape in full: 8 nominal and 6 continuous features and the label.
def wide_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))

    def tag(prefix: str, number: Column) -> Column:
        return F.concat(F.lit(prefix), number.cast("string"))

    day = F.col("o_orderdate")
    features = joined.select(
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
        "o_orderpriority",
        "c_mktsegment",
        tag("N", F.col("c_nationkey")).alias("nation"),
        tag("M", F.month(day)).alias("order_month"),
        tag("D", F.dayofweek(day)).alias("order_weekday"),
        tag("Q", F.quarter(day)).alias("order_quarter"),
        tag("B", F.col("o_custkey") % 42).alias("customer_band"),
        "c_acctbal",
        F.year(day).alias("order_year"),
        F.dayofmonth(day).alias("order_day"),
        F.dayofyear(day).alias("order_yearday"),
        F.col("o_custkey").cast("double").alias("customer_number"),
        F.floor(F.col("o_totalprice") / 100000.0).alias("price_step"),
    )
    return label_threshold(features, "o_totalprice", THRESHOLD).drop("o_totalprice")


def census_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test, feature names): parts split on the order key, then prepared."""
    raw = wide_census(spark, sf_dir)
    layout = feature_layout(raw, key="o_orderkey")
    train, test = hash_split(raw, "o_orderkey")
    model = fit_features(train, layout)
    train, test = (apply_features(model, part, layout, ["o_orderkey"]) for part in (train, test))
    return train, test, layout.features


# Embeddings as 8x8 images with integer pixels in 0..255.
def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    def level(v: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(255), F.floor((v.cast("double") + 1.0) * 127.5)))

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: level(v).cast("int")).alias("pixels"), "label"
    )


CELLS = """cells AS (
    SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS position, embedding[i] AS x,
           CAST(greatest(0, least(255, floor((embedding[i]::DOUBLE + 1.0::DOUBLE) * 127.5::DOUBLE))) AS INTEGER) AS pixel
    FROM embeddings, range(1, 65) AS r(i))"""


# Scores: every tenth value of an embedding belongs to one class and adds to its score.
def scored_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    def score(of_class: Column) -> Column:
        own = F.filter("embedding", lambda _, i: i % CLASSES == of_class)
        return F.aggregate(own, F.lit(0.0), lambda total, v: total + v.cast("double"))

    classes = F.array(*[F.lit(c) for c in range(CLASSES)])
    return table(spark, sf_dir, "embeddings").withColumn("scores", F.transform(classes, score))


SCORED = """summed AS (
    SELECT vec_id, label, CAST((i - 1) % 10 AS INTEGER) AS class, sum(embedding[i]::DOUBLE) AS score
    FROM embeddings, range(1, 65) AS r(i) GROUP BY vec_id, label, (i - 1) % 10),
scored AS (
    SELECT *, exp(score) / sum(exp(score)) OVER (PARTITION BY vec_id) AS p FROM summed)"""
