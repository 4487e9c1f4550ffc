"""A census scorer as tables: category ranks and tree nodes in one small file, scored by columns alone."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rungwise.operators.columns import Layout
from rungwise.plans.nodes import NODES, Node, TreeTable

KINDS = RANK, NUMBER, TREE = "rank", "number", "node"
ROWS = f"kind string, feature int, name string, value string, rank double, node struct<{NODES.replace(' ', ':').replace(',:', ',')}>"


class TableScorer(NamedTuple):
    """Text columns with their ranks, then numbers, in the order of the features; and the tree."""

    ranks: dict[str, dict[str, float]]
    numeric: list[str]
    tree: TreeTable

    @classmethod
    def of(cls, features: PipelineModel, model, layout: Layout) -> TableScorer:
        """From ``fit_features`` (ordered codes) and a fitted tree."""
        indexers = features.stages[1 : 1 + len(layout.text)]
        ranks = {c: {v: float(i) for i, v in enumerate(s.labels)} for c, s in zip(layout.text, indexers)}
        return cls(ranks, list(layout.numeric), TreeTable.of(model))

    def _rank(self, column: str) -> Column:
        """A category's rank; unseen and null ones have the column's own next rank."""
        own = self.ranks[column]
        known = F.from_json(F.lit(json.dumps(own)), "map<string,double>")
        return F.coalesce(F.try_element_at(known, F.col(column).cast("string")), F.lit(float(len(own))))

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (array) and ``prediction`` to raw rows; missing numbers count as 0."""
        numbers = [F.coalesce(F.col(c), F.lit(0)).cast("int").cast("double") for c in self.numeric]
        vector = F.array(*[self._rank(c) for c in self.ranks], *numbers)
        return self.tree.score(df.withColumn("_features", vector), "_features").drop("_features")

    def save(self, spark: SparkSession, path: str) -> None:
        """One file; replaces what ``path`` had."""
        rows = [(RANK, i, c, v, r, None) for i, c in enumerate(self.ranks) for v, r in (self.ranks[c] or {None: None}).items()]
        rows += [(NUMBER, i, c, None, None, None) for i, c in enumerate(self.numeric)]
        rows += [(TREE, None, None, None, None, tuple(n)) for n in self.tree.nodes]
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TableScorer:
        rows = spark.read.schema(ROWS).parquet(path).collect()
        ranks: dict[str, dict[str, float]] = {}
        for r in sorted((r for r in rows if r["kind"] == RANK), key=lambda r: (r["feature"], r["rank"] or 0.0)):
            own = ranks.setdefault(r["name"], {})
            if r["value"] is not None:
                own[r["value"]] = r["rank"]
        numeric = [r["name"] for r in sorted((r for r in rows if r["kind"] == NUMBER), key=lambda r: r["feature"])]
        return cls(ranks, numeric, TreeTable([Node(*r["node"]) for r in rows if r["kind"] == TREE]))


def scorer_roundtrip(df: DataFrame, scorer: TableScorer, model: PipelineModel, path: str) -> DataFrame:
    """Save, load and score: (rows, differing) against the fitted pipeline ``model``, which must agree on every row."""
    spark = df.sparkSession
    scorer.save(spark, path)
    own = TableScorer.load(spark, path).score(df).withColumnsRenamed({"prediction": "_own", "probability": "_shares"})
    both = model.transform(own)
    return both.agg(F.count("*").alias("rows"), F.count_if(~F.col("prediction").eqNullSafe(F.col("_own"))).alias("differing"))
