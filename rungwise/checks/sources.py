"""Scans and sinks, written to and read back from the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from rungwise.checks.inputs import table, wide_census
from rungwise.checks.registry import query
from rungwise.operators.columns import feature_layout
from rungwise.operators.splits import hash_split
from rungwise.plans import dense, prepare, trees
from rungwise.plans.scorers import TableScorer, scorer_roundtrip
from rungwise.session import cached, scratch_path
from rungwise.sources import runlogs, tables


@query(
    "csv_scan_infer",
    """SELECT CAST(p_partkey AS INTEGER) AS _c0, p_name AS _c1, p_brand AS _c2, p_type AS _c3, p_size AS _c4,
           p_retailprice AS _c5
    FROM part""",
)
def csv_scan_infer(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "part").write.csv(path)
    return tables.csv_scan_infer(spark, path)


@query(
    "csv_scan_schema",
    """SELECT p_partkey, p_name, CASE WHEN p_partkey % 11 = 0 THEN '?' ELSE p_brand END AS p_brand, p_type, p_size,
           CASE WHEN p_partkey % 50 <> 0 THEN p_retailprice END AS p_retailprice
    FROM part""",
)
def csv_scan_schema(spark, sf_dir):
    # Comma and blank between fields, "?" for unknown, and a price that is no number.
    path = scratch_path(spark, "csv")
    key = F.col("p_partkey")
    line = F.concat_ws(
        ", ",
        key,
        "p_name",
        F.when(key % 11 == 0, "?").otherwise(F.col("p_brand")),
        "p_type",
        "p_size",
        F.when(key % 50 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string")),
    )
    table(spark, sf_dir, "part").select(line.alias("line")).write.text(path)
    schema = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return tables.csv_scan_schema(spark, path, schema)


PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


# Every line in one of two tables: prices and sizes that are no numbers and lines that end early, beside good ones.
@query(
    "csv_scan_checked",
    """SELECT p_partkey, CASE WHEN p_partkey % 77 = 0 THEN '(fields)' WHEN p_partkey % 35 = 0 THEN 'p_size'
                              WHEN p_partkey % 50 = 0 THEN 'p_retailprice' END AS failing,
           CASE WHEN p_partkey % 77 <> 0 AND p_partkey % 35 <> 0 AND p_partkey % 50 <> 0 AND p_partkey % 9 <> 0 THEN p_retailprice END AS price
    FROM part""",
)
def csv_scan_checked(spark, sf_dir):
    path, key = scratch_path(spark, "csv"), F.col("p_partkey")
    price = F.when(key % 50 == 0, "n/a").when(key % 9 == 0, "").otherwise(F.col("p_retailprice").cast("string"))
    line = F.concat_ws(", ", key, "p_name", "p_brand", "p_type", F.when(key % 35 == 0, "large").otherwise(F.col("p_size").cast("string")), price)
    short = F.when(key % 77 == 0, F.concat_ws(", ", key, "p_name")).otherwise(line)
    table(spark, sf_dir, "part").select(short.alias("line")).write.text(path)
    good, bad = tables.csv_scan_checked(spark, path, PART_SCHEMA)
    of_line = F.split("line", ",")[0].cast("bigint").alias("p_partkey")
    return good.select("p_partkey", F.lit(None).cast("string").alias("failing"), F.col("p_retailprice").alias("price")).unionByName(
        bad.select(of_line, "failing", F.lit(None).cast("double").alias("price"))
    )


@query("preview_rows", "SELECT * FROM part ORDER BY p_partkey LIMIT 5")
def preview_rows(spark, sf_dir):
    return tables.preview_rows(table(spark, sf_dir, "part"), "p_partkey", 5)


EVENT_LOG = """SELECT event_type AS run, CAST(event_id AS INTEGER) AS m, value AS dt, event_id % 100 / 100 AS a"""


@query("runlog_append", f"{EVENT_LOG} FROM events")
def runlog_append(spark, sf_dir):
    path = scratch_path(spark, "runlog")
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"),
        F.col("event_id").cast("int").alias("m"),
        F.col("value").alias("dt"),
        ((F.col("event_id") % 100) / 100).alias("a"),
    )
    for part in hash_split(log, "m"):
        runlogs.runlog_append(part, path)
    return runlogs.runlog_read(spark, path)


@query(
    "runlog_scan",
    """SELECT CAST(event_id AS INTEGER) AS m, value AS dt, event_id % 100 / 100 AS a,
           600 AS max_m, CAST(user_id % 5 AS INTEGER) AS nodes, 8 AS cpus
    FROM events""",
)
def runlog_scan(spark, sf_dir):
    path = scratch_path(spark, "runlogs")
    name = F.format_string("ladder_600_%d_8.csv", F.col("user_id") % 5)
    log = table(spark, sf_dir, "events").select(
        name.alias("log"),
        F.col("event_id").cast("int").alias("m"),
        F.col("value").alias("dt"),
        ((F.col("event_id") % 100) / 100).alias("a"),
    )
    runlogs.runlog_append(log, path, run="log")
    return runlogs.runlog_scan(spark, f"{path}/*")


# Every key is written, then the even ones again: they replace themselves and nothing else.
@query(
    "runlog_commit",
    """SELECT event_type AS run, CAST(user_id % 4 AS INTEGER) AS m,
              CASE WHEN user_id % 2 = 0 THEN count(*)::DOUBLE ELSE -1 END AS dt, 0.5::DOUBLE AS a
    FROM events GROUP BY event_type, user_id % 4, user_id % 2""",
)
def runlog_commit(spark, sf_dir):
    path, m = scratch_path(spark, "commits"), F.col("user_id") % 4
    log = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run"), m.cast("int").alias("m")).agg(
        F.count("*").cast("double").alias("dt"), F.lit(0.5).alias("a")
    )
    runlogs.runlog_commit(log.withColumn("dt", F.lit(-1.0)), path)
    runlogs.runlog_commit(log.filter("m % 2 = 0"), path)
    return runlogs.runlog_read(spark, path).select("run", "m", "dt", "a")


@query("model_roundtrip", "SELECT count(*) AS rows, 0::BIGINT AS differing FROM orders")
def model_roundtrip(spark, sf_dir):
    raw = wide_census(spark, sf_dir)
    layout = feature_layout(raw, key="o_orderkey")
    train, _ = hash_split(raw, "o_orderkey")
    features = prepare.fit_features(train, layout)
    ready = prepare.apply_features(features, train, layout, ["o_orderkey"])
    with cached(trees.spread_rows(ready)) as rows:
        tree = trees.tree_fit(rows)
    scorer = TableScorer.of(features, tree, layout)
    return scorer_roundtrip(raw, scorer, prepare.scorer(features, tree), scratch_path(spark, "model"))


@query("softmax_roundtrip", "SELECT count(*) AS rows, 0::BIGINT AS differing FROM embeddings")
def softmax_roundtrip(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    train, valid = hash_split(df, "vec_id")
    model, _ = dense.softmax_fit(train, valid, "vec_id", "embedding", "label", 64, 10, epochs=1, batch_size=100_000)
    return dense.softmax_roundtrip(df, model, "embedding", scratch_path(spark, "softmax"))
