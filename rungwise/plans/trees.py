"""Decision trees: fit, score, cross-validate, and time on growing tables."""

from __future__ import annotations

import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from rungwise.functions import losses
from rungwise.operators.columns import is_correct
from rungwise.operators.growth import bag_multiply, ladder_rungs
from rungwise.operators.metrics import accuracy
from rungwise.operators.splits import kfold_assign
from rungwise.plans.nodes import TreeTable
from rungwise.plans.prepare import FEATURES, INDEXED_LABEL
from rungwise.session import cached, shuffle_width
from rungwise.sources.runlogs import LOG_SCHEMA, run_name, runlog_commit

SEED = 42
WEIGHT = "_copies"
# A task has at least FEWEST rows to be worth starting and, on any number of cores, at most MOST.
FEWEST, MOST = 20_000, 1_000_000


def tree_estimator(depth: int = 5, bins: int = 32, seed: int = SEED, **settings) -> DecisionTreeClassifier:
    """Gini tree; depth 5 and 32 bins are the defaults."""
    return DecisionTreeClassifier(
        labelCol=INDEXED_LABEL, featuresCol=FEATURES, maxDepth=depth, maxBins=bins, seed=seed, **settings
    )


def tree_fit(df: DataFrame, **settings) -> DecisionTreeClassificationModel:
    return tree_estimator(**settings).fit(df)


def spread_rows(df: DataFrame, copies: int = 1) -> DataFrame:
    """Even partitions for rows that will be multiplied and read many times.

    As many as keep all cores busy with a worthwhile number of rows each (a
    fit runs several jobs per tree level, so tiny tasks add up), and more where
    a partition would grow beyond ``MOST`` rows: their number has no limit.
    """
    rows, spark = df.count() * copies, df.sparkSession
    busy = min(max(2 * spark.sparkContext.defaultParallelism, shuffle_width(spark)), rows // FEWEST)
    return df.repartition(max(1, busy, -(-rows // MOST)))


def spread_few(df: DataFrame, parallelism: int = 1) -> tuple[DataFrame, int]:
    """Even partitions for deep trees, one a core at most, and how many of ``parallelism`` fits to run at once.

    On every level each partition sends the statistics of all open nodes, however few of its
    rows reach them, so what a fit shuffles grows with partitions times nodes. A fit also keeps
    its rows: ``MOST`` of them a partition for all fits at once, beyond that fewer fits.
    """
    rows = df.count()
    parts = max(1, min(df.sparkSession.sparkContext.defaultParallelism, rows // FEWEST))
    return df.repartition(parts), max(1, min(parallelism, parallelism * MOST * parts // max(rows, 1)))


def tree_importances(model: DecisionTreeClassificationModel, features: list[str]) -> DataFrame:
    """(feature, importance, depth, nodes), one row per feature."""
    spark = SparkSession.active()
    weights = model.featureImportances.toArray()
    rows = [(name, float(w), model.depth, model.numNodes) for name, w in zip(features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double, depth int, nodes int")


def tree_score(model, df: DataFrame, keys: list[str]) -> DataFrame:
    return model.transform(df).select(*keys, INDEXED_LABEL, "prediction")


def holdout_eval(model, df: DataFrame, classes: int, smoothing: float = 0.0) -> DataFrame:
    """(rows, loss, accuracy) on held-out rows, in one pass; a row without label is a miss, as in ``accuracy``."""
    scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
    loss = losses.xent_smoothed(F.col("_p"), F.col(INDEXED_LABEL), classes, smoothing)
    hit = F.coalesce(is_correct(INDEXED_LABEL, "prediction"), F.lit(False)).cast("double")
    return scored.agg(
        F.count("*").alias("rows"), F.avg(loss).alias("loss"), F.avg(hit).alias("accuracy")
    )


class Search(NamedTuple):
    """A grid search's outcome."""

    depths: tuple[int, ...]
    accuracies: list[float]
    best: int
    model: DecisionTreeClassificationModel
    seconds: float


def cross_validator(
    df: DataFrame,
    key: str,
    depths: tuple[int, ...] = (1, 5, 10, 20),
    folds: int = 5,
    copies: int = 1,
    parallelism: int = 4,
    seed: int = SEED,
) -> Search:
    """Grid search over tree depth by accuracy, best depth refitted on all rows.

    A tree grows level by level, so a shallower tree is what the deeper one of the same rows
    was before: every fold fits the deepest tree once and reads the others off its inner nodes,
    all depths in one pass over the held-out rows. Copies of a row are its weight, so the
    base is all that is kept and read, whatever their number. A fold is a filter on the base;
    at most ``parallelism`` fits run at once; a fold without rows is left out of the mean.
    """
    started = time.perf_counter()
    folded = kfold_assign(df, key, folds).select(FEATURES, INDEXED_LABEL, "fold", F.lit(float(copies)).alias(WEIGHT))

    def fit(rows: DataFrame, depth: int) -> DecisionTreeClassificationModel:
        return tree_fit(rows, depth=depth, seed=seed, weightCol=WEIGHT)

    def score(fold: int) -> list[float | None]:
        tree = TreeTable.of(fit(base.filter(F.col("fold") != fold), max(depths)))
        return nested_accuracies(tree, base.filter(F.col("fold") == fold), depths)

    spread, at_once = spread_few(folded, parallelism)
    with cached(spread) as base:
        with ThreadPoolExecutor(at_once) as pool:
            shares = list(pool.map(inheritable_thread_target(df.sparkSession)(score), range(folds)))
        means = []
        for of_depth in zip(*shares):
            known = [s for s in of_depth if s is not None]
            means.append(sum(known) / len(known) if known else float("nan"))
        best = max(range(len(depths)), key=lambda i: means[i])
        model = fit(base, depths[best])
    return Search(tuple(depths), means, best, model, time.perf_counter() - started)


def nested_accuracies(tree: TreeTable, df: DataFrame, depths: tuple[int, ...]) -> list[float | None]:
    """Share predicted right at each depth of one tree, in one pass; None without rows. A row without label is a miss."""
    scored = tree.predict_at(df, list(depths))
    hits = [F.coalesce(is_correct(INDEXED_LABEL, f"prediction_{d}"), F.lit(False)).cast("double") for d in depths]
    return list(scored.agg(*[F.avg(hit).alias(f"a{i}") for i, hit in enumerate(hits)]).first())


def cross_validate(df: DataFrame, key: str, depths: tuple[int, ...] = (1, 5, 10, 20), **settings) -> DataFrame:
    """(depth, accuracy, best, seconds of the whole search) from ``cross_validator``."""
    search = cross_validator(df, key, depths, **settings)
    rows = [(d, a, i == search.best, search.seconds) for i, (d, a) in enumerate(zip(depths, search.accuracies))]
    return df.sparkSession.createDataFrame(rows, "depth int, accuracy double, best boolean, seconds double")


def train_eval_rungs(
    train: DataFrame, test: DataFrame, rungs: list[int], **settings
) -> Iterator[tuple[int, int, float, float | None]]:
    """Yield (m, rows, seconds of the fit, accuracy on ``test``) for each rung.

    ``train`` and ``test`` are read once and kept, ``train`` evenly spread.
    Every rung multiplies the kept rows inside their own tasks, so nothing is
    shuffled per rung.
    """
    train = spread_rows(train.select(FEATURES, INDEXED_LABEL), max(rungs))
    with cached(train, test) as (train_rows, test_rows):
        base = train_rows.count()
        for m in rungs:
            grown = bag_multiply(train_rows, m)
            start = time.perf_counter()
            model = tree_fit(grown, **settings)
            seconds = time.perf_counter() - start
            share = accuracy(model.transform(test_rows), INDEXED_LABEL).first()["accuracy"]
            yield m, base * m, seconds, share


def train_eval_ladder(
    train: DataFrame,
    test: DataFrame,
    max_m: int = 600,
    step: int = 30,
    log: str | None = None,
    run: str | None = None,
    nodes: int = 1,
    cpus: int | None = None,
    **settings,
) -> DataFrame:
    """The scaling study: (m, rows, dt, a) for every rung of the ladder.

    With ``log``, a folder, every rung is committed to run ``run`` as soon as it
    is known, so a broken study keeps the rungs it has done; a rung that is run
    again replaces itself, and other studies may write to the folder meanwhile.
    ``nodes`` and ``cpus`` say what the study runs on and are part of the name.
    """
    spark, rows = train.sparkSession, []
    run = run or run_name(max_m, nodes, cpus or spark.sparkContext.defaultParallelism)
    for m, size, seconds, share in train_eval_rungs(train, test, ladder_rungs(max_m, step), **settings):
        if log:
            line = spark.createDataFrame([(run, m, seconds, share)], "run string, " + LOG_SCHEMA)
            runlog_commit(line, log)
        rows.append((m, size, seconds, share))
    return spark.createDataFrame(rows, "m int, rows long, dt double, a double")
