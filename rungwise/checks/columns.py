"""Projection, filter, indexing and the documented preparation steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from rungwise.checks.inputs import (
    GAPPED_ORDERS,
    RULED_ORDERS,
    SMALL_CENSUS,
    gapped_orders,
    rank_sql,
    ruled_orders,
    small_census,
    table,
)
from rungwise.checks.registry import query
from rungwise.operators import census, columns, indexing
from rungwise.plans import prepare


@query(
    "fill_missing_numeric",
    f"""WITH {GAPPED_ORDERS}
    SELECT o_orderkey, o_orderstatus, coalesce(o_totalprice, 0) AS o_totalprice, o_orderpriority, label
    FROM gapped""",
)
def fill_missing_numeric(spark, sf_dir):
    return columns.fill_missing_numeric(gapped_orders(spark, sf_dir))


@query(
    "feature_layout",
    f"""WITH {SMALL_CENSUS}
    SELECT o_orderkey, o_orderstatus AS f0_o_orderstatus_index, o_orderpriority AS f1_o_orderpriority_index,
           c_mktsegment AS f2_c_mktsegment_index, c_nationkey AS f3_c_nationkey, c_acctbal AS f4_c_acctbal,
           label AS label_label
    FROM census""",
)
def feature_layout(spark, sf_dir):
    df = small_census(spark, sf_dir)
    layout = columns.feature_layout(df, key="o_orderkey")
    sources = layout.text + layout.numeric
    laid_out = [F.col(c).alias(f"f{i}_{name}") for i, (c, name) in enumerate(zip(sources, layout.features))]
    return df.select("o_orderkey", *laid_out, F.col(layout.label).alias(f"label_{layout.label}"))


@query(
    "cast_integer",
    """SELECT c_custkey, c_nationkey, CAST(trunc(c_acctbal) AS INTEGER) AS c_acctbal, c_mktsegment
    FROM customer""",
)
def cast_integer(spark, sf_dir):
    df = table(spark, sf_dir, "customer").drop("c_name")
    return columns.cast_integer(df, ["c_nationkey", "c_acctbal"])


@query("select_columns", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def select_columns(spark, sf_dir):
    named = columns.select_columns(
        table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderpriority", "o_totalprice"], "train"
    )
    return named.select("train.o_orderkey", "train.o_orderpriority", "train.o_totalprice")


@query("drop_column", f"WITH {SMALL_CENSUS} SELECT * EXCLUDE (label) FROM census")
def drop_column(spark, sf_dir):
    return columns.drop_column(small_census(spark, sf_dir), "label")


@query("filter_correct", f"WITH {RULED_ORDERS} SELECT * FROM ruled WHERE label = prediction")
def filter_correct(spark, sf_dir):
    return columns.filter_correct(ruled_orders(spark, sf_dir), "label")


@query(
    "string_index",
    f"""SELECT p_partkey, p_name, p_brand, p_type, CAST(n.rank AS DOUBLE) AS p_name_index,
           CAST(b.rank AS DOUBLE) AS p_brand_index, CAST(t.rank AS DOUBLE) AS p_type_index
    FROM part JOIN {rank_sql("part", "p_name")} n USING (p_name)
         JOIN {rank_sql("part", "p_brand")} b USING (p_brand)
         JOIN {rank_sql("part", "p_type")} t USING (p_type)""",
)
def string_index(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return indexing.string_index(df, ["p_name", "p_brand", "p_type"])


@query(
    "label_index",
    f"""WITH {SMALL_CENSUS}
    SELECT o_orderkey, label, CAST(rank AS DOUBLE) AS "indexedLabel", label AS restored
    FROM census JOIN {rank_sql("census", "label")} USING (label)""",
)
def label_index(spark, sf_dir):
    df = small_census(spark, sf_dir).select("o_orderkey", "label")
    indexed, labels = indexing.label_index(df, "label")
    return indexing.label_restore(indexed, "indexedLabel", labels, "restored")


@query(
    "prepare_pipeline",
    f"""WITH {SMALL_CENSUS}
    SELECT o_orderkey, CAST(s.rank AS INTEGER) AS o_orderstatus_index, CAST(p.rank AS INTEGER) AS o_orderpriority_index,
           CAST(m.rank AS INTEGER) AS c_mktsegment_index, c_nationkey,
           CAST(trunc(c_acctbal) AS INTEGER) AS c_acctbal, CAST(l.rank AS INTEGER) AS "indexedLabel"
    FROM census JOIN {rank_sql("census", "o_orderstatus")} s USING (o_orderstatus)
         JOIN {rank_sql("census", "o_orderpriority")} p USING (o_orderpriority)
         JOIN {rank_sql("census", "c_mktsegment")} m USING (c_mktsegment)
         JOIN {rank_sql("census", "label")} l USING (label)""",
)
def prepare_pipeline(spark, sf_dir):
    df = small_census(spark, sf_dir)
    layout = columns.feature_layout(df, key="o_orderkey")
    model = prepare.prepare_pipeline(df, layout)
    return prepare.indexed_integers(df, model, layout, "o_orderkey")


@query(
    "assemble_vector",
    f"""WITH {SMALL_CENSUS},
    wide AS (
        SELECT o_orderkey, CAST(p.rank AS DOUBLE) AS c0, CAST(c_nationkey AS DOUBLE) AS c1,
               trunc(c_acctbal) AS c2
        FROM census JOIN {rank_sql("census", "o_orderpriority")} p USING (o_orderpriority))
    SELECT o_orderkey, CAST(0 AS INTEGER) AS position, c0 AS value FROM wide
    UNION ALL SELECT o_orderkey, CAST(1 AS INTEGER), c1 FROM wide
    UNION ALL SELECT o_orderkey, CAST(2 AS INTEGER), c2 + 0.0 FROM wide""",
)
def assemble_vector(spark, sf_dir):
    df = small_census(spark, sf_dir).select("o_orderkey", "o_orderpriority", "c_nationkey", "c_acctbal")
    indexed = indexing.string_index(df, ["o_orderpriority"])
    whole = columns.cast_integer(indexed, ["o_orderpriority_index", "c_nationkey", "c_acctbal"])
    vector = indexing.assemble_vector(whole, ["o_orderpriority_index", "c_nationkey", "c_acctbal"])
    return indexing.vector_cells(vector, ["o_orderkey"])


@query(
    "range_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
    FROM lineitem WHERE l_quantity > 16 AND l_extendedprice > 100 AND l_discount > 0.01 AND l_tax > 0""",
)
def range_filter(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    kept = census.range_filter(
        df, {"l_quantity": 16.0, "l_extendedprice": 100.0, "l_discount": 0.01, "l_tax": 0.0}
    )
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "label_threshold",
    """SELECT o_orderkey, o_totalprice,
           CASE WHEN o_totalprice > 50000 THEN '>50K' WHEN o_totalprice <= 50000 THEN '<=50K' END AS label
    FROM orders""",
)
def label_threshold(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return census.label_threshold(df, "o_totalprice", 50000.0)


@query(
    "unknown_to_null",
    f"""WITH {GAPPED_ORDERS}
    SELECT o_orderkey, nullif(o_orderpriority, '?') AS o_orderpriority, o_orderstatus,
           coalesce(o_orderstatus, '?') AS restored_status, o_orderpriority AS restored_priority
    FROM gapped""",
)
def unknown_to_null(spark, sf_dir):
    df = gapped_orders(spark, sf_dir).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    cleared = census.unknown_to_null(df, ["o_orderpriority", "o_orderstatus"])
    copies = cleared.withColumns(
        {"restored_priority": F.col("o_orderpriority"), "restored_status": F.col("o_orderstatus")}
    )
    return census.null_to_unknown(copies, ["restored_priority", "restored_status"])


GAP_COLUMNS = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
COMPLETE = "o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderpriority <> '?'"


def known_orders(spark, sf_dir):
    return census.unknown_to_null(gapped_orders(spark, sf_dir), ["o_orderpriority"])


@query(
    "drop_unknown",
    f"""WITH {GAPPED_ORDERS}
    SELECT count(*) AS rows_before, count(*) FILTER ({COMPLETE}) AS rows_after FROM gapped""",
)
def drop_unknown(spark, sf_dir):
    return census.unknown_counts(known_orders(spark, sf_dir), GAP_COLUMNS)


@query(
    "drop_unknown_rows",
    f"WITH {GAPPED_ORDERS} SELECT * FROM gapped WHERE {COMPLETE}",
)
def drop_unknown_rows(spark, sf_dir):
    return census.drop_unknown(known_orders(spark, sf_dir), GAP_COLUMNS)


@query(
    "class_priors",
    f"""WITH {GAPPED_ORDERS},
    counts AS (
        SELECT label, count(*) AS rows_all, count(*) FILTER ({COMPLETE}) AS rows_known
        FROM gapped GROUP BY label)
    SELECT label, rows_all, rows_known, round(rows_all / sum(rows_all) OVER (), 6) AS share_all,
           round(rows_known / sum(rows_known) OVER (), 6) AS share_known
    FROM counts""",
)
def class_priors(spark, sf_dir):
    priors = census.class_priors(known_orders(spark, sf_dir), "label", GAP_COLUMNS)
    return priors.withColumns({c: F.round(c, 6) for c in ("share_all", "share_known")})


@query(
    "duplicate_conflicts",
    """SELECT l_quantity, l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax, l_linestatus,
           count(*) AS copies, count(DISTINCT l_returnflag) AS labels,
           count(DISTINCT l_returnflag) > 1 AS conflicting
    FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_conflicts(spark, sf_dir):
    features = ["l_quantity", "l_discount", "l_tax", "l_linestatus"]
    df = table(spark, sf_dir, "lineitem").select(*features, "l_returnflag")
    return census.duplicate_conflicts(df, features, "l_returnflag")
