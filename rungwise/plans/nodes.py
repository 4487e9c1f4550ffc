"""A fitted tree as a table of nodes, scored by a column expression.

The model's own format tells every node's statistics, inner ones too, so one tree gives the
predictions of all shallower trees of the same data: a tree grown level by level is a prefix of the
deeper one. A tree has fewer than 2^(depth + 1) nodes whatever the rows; the driver holds
them, as it holds the model.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rungwise.plans.prepare import FEATURES
from rungwise.session import remove_scratch, scratch_path

NODES = (
    "node int, left int, right int, feature int, threshold double, categories array<double>, counts array<double>, "
    "depth int, path string"
)
LEAF = -1
ROOT = 0


class Node(NamedTuple):
    """``left`` and ``right`` are -1 in a leaf; ``categories`` go left where the split is nominal, else ``threshold`` decides."""

    node: int
    left: int
    right: int
    feature: int
    threshold: float
    categories: list[float] | None
    counts: list[float]
    depth: int
    path: str


def literal(values: list, kind: str) -> Column:
    """A list as one literal string that the optimizer turns into one array; an element-wise literal grows the plan."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


class TreeTable:
    """Nodes in order of their number, the root first."""

    def __init__(self, nodes: list[Node]):
        self.nodes = sorted(nodes)
        self.depth = max(n.depth for n in self.nodes)

    @classmethod
    def of(cls, model: DecisionTreeClassificationModel) -> TreeTable:
        """From a fitted model, by way of its saved form."""
        spark = SparkSession.active()
        path = scratch_path(spark, "tree")
        model.write().save(path)
        rows = {r["id"]: r for r in spark.read.parquet(f"{path}/data").collect()}
        remove_scratch(spark, path)
        nodes, open_nodes = [], [(ROOT, 0, "")]
        while open_nodes:
            number, depth, name = open_nodes.pop()
            row = rows[number]
            left, right, split = row["leftChild"], row["rightChild"], row["split"]
            counts = [float(c) for c in row["impurityStats"]]
            if left < 0:
                nodes.append(Node(number, LEAF, LEAF, LEAF, 0.0, None, counts, depth, name))
                continue
            values, nominal = list(split["leftCategoriesOrThreshold"]), split["numCategories"] > 0
            own = (0.0, values) if nominal else (values[0], None)
            nodes.append(Node(number, left, right, split["featureIndex"], *own, counts, depth, name))
            open_nodes += [(left, depth + 1, name + "L"), (right, depth + 1, name + "R")]
        return cls(nodes)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(n) for n in self.nodes], NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        """One file; replaces what ``path`` had."""
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeTable:
        return cls([Node(*r) for r in spark.read.schema(NODES).parquet(path).collect()])

    def _step(self, vector: str):
        """One level down from a node, a leaf stays: array look-ups, so the expression is as long for any tree."""
        left, right, feature = (literal([getattr(n, c) for n in self.nodes], "int") for c in ("left", "right", "feature"))
        threshold = literal([n.threshold for n in self.nodes], "double")
        nominal = any(n.categories is not None for n in self.nodes)
        sets = literal([n.categories for n in self.nodes], "array<double>") if nominal else None

        def step(node: Column, _: Column) -> Column:
            value = F.get(F.col(vector), F.get(feature, node))
            goes_left = value <= F.get(threshold, node)
            if nominal:
                goes_left = F.coalesce(F.array_contains(F.get(sets, node), value), goes_left)
            below = F.when(goes_left, F.get(left, node)).otherwise(F.get(right, node))
            return F.when(F.get(left, node) < 0, node).otherwise(below)

        return step

    def walk(self, df: DataFrame, depths: dict[str, int], features: str = FEATURES) -> DataFrame:
        """Adds, under each name, the node a row has reached after so many levels; null for a null vector (or array)."""
        names, kind = df.columns, dict(df.dtypes)[features]
        vector = F.col(features) if kind.startswith("array") else vector_to_array(features)
        walked, step, before, last = df.withColumn("_x", vector), self._step("_x"), 0, F.lit(ROOT)
        for name, depth in sorted(depths.items(), key=lambda item: item[1]):
            if depth > before:
                last = F.aggregate(F.sequence(F.lit(1), F.lit(depth - before)), last, step)
            walked = walked.withColumn(name, F.when(F.col("_x").isNotNull(), last))
            before, last = depth, F.col(name)
        return walked.select(*names, *depths)

    def predictions(self) -> list[float]:
        """The most frequent class of each node, the first of equals."""
        return [float(max(range(len(n.counts)), key=lambda k: n.counts[k])) for n in self.nodes]

    def score(self, df: DataFrame, features: str = FEATURES) -> DataFrame:
        """Adds ``probability`` (array) and ``prediction``, as the model does."""
        shares = literal([[c / sum(n.counts) for c in n.counts] for n in self.nodes], "array<double>")
        walked = self.walk(df, {"_node": self.depth}, features)
        scored = walked.withColumn("probability", F.get(shares, "_node"))
        return scored.withColumn("prediction", F.get(literal(self.predictions(), "double"), "_node")).drop("_node")

    def predict_at(self, df: DataFrame, depths: list[int], features: str = FEATURES) -> DataFrame:
        """Adds ``prediction_<d>``: what the tree would say had it grown only d levels."""
        walked = self.walk(df, {f"prediction_{d}": min(d, self.depth) for d in depths}, features)
        of_node = literal(self.predictions(), "double")
        return walked.withColumns({f"prediction_{d}": F.get(of_node, f"prediction_{d}") for d in depths})


def tree_roundtrip(df: DataFrame, tree: TreeTable, path: str) -> DataFrame:
    """Save, load, score again in one pass: (rows, nodes, differing), and ``differing`` must be 0."""
    spark = df.sparkSession
    tree.save(spark, path)
    again = TreeTable.load(spark, path)
    first = tree.score(df).withColumnsRenamed({"probability": "_p", "prediction": "_first"})
    twice = again.score(first)
    same = F.col("probability").eqNullSafe(F.col("_p")) & F.col("prediction").eqNullSafe(F.col("_first"))
    return twice.agg(F.count("*").alias("rows"), F.lit(len(again.nodes)).alias("nodes"), F.count_if(~same).alias("differing"))
