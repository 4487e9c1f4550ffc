"""Splits, folds, order and batches, all on a row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rungwise.functions.hashing import hash_share
from rungwise.operators.ranking import hash_rank, nth_smallest


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's own random split. Both parts rescan the input, so it must be a
    stable one (a file scan or a checkpoint); ``hash_split`` has no such need."""
    return df.randomSplit(weights, seed)


def in_train(key: Column | str, share: float = 0.7, seed: int = 0) -> Column:
    """A share of the keys; rows without a key count as training rows."""
    return hash_share(key, seed) < F.lit(share)


def hash_split(df: DataFrame, key: str, share: float = 0.7, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test): two filters on the key, no shuffle, the same on every run."""
    train = in_train(key, share, seed)
    return df.filter(train), df.filter(~train)


def split_part(df: DataFrame, key: str, share: float = 0.7, seed: int = 0, part: str = "part") -> DataFrame:
    """The same split as a column, for one pass over both parts."""
    return df.withColumn(part, F.when(in_train(key, share, seed), "train").otherwise("test"))


def two_thirds_split(df: DataFrame, key: str, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    return hash_split(df, key, 2.0 / 3.0, seed)


def head_split(df: DataFrame, key: str, n: int = 5000) -> tuple[DataFrame, DataFrame]:
    """(validation, train): the ``n`` rows of lowest unique integer key, and the rest.

    Finds the n-th key first; both parts are then key filters that reach the scan.
    """
    first = F.col(key) <= nth_smallest(df, key, n) if n > 0 else F.lit(False)
    return df.filter(first), df.filter(first.isNull() | ~first)


# Folds are a draw of their own: on the split's, the training part would fill only some folds.
FOLD_DRAW = 1


def kfold_assign(df: DataFrame, key: str, folds: int = 5, seed: int = 0, fold: str = "fold") -> DataFrame:
    return df.withColumn(fold, F.floor(hash_share(key, seed, FOLD_DRAW) * folds).cast("int"))


def shuffle_rows(df: DataFrame, key: str, seed: int = 0, position: str = "position") -> DataFrame:
    """All rows in a random order, numbered by it."""
    return hash_rank(df, key, seed, position, ordered=True)


def batch_assign(
    df: DataFrame,
    key: str,
    batch_size: int,
    seed: int = 0,
    replicas: int = 1,
    batch: str = "batch_id",
    ordered: bool = False,
) -> DataFrame:
    """Rows to batches of ``batch_size * replicas``; the last may be short."""
    ranked = hash_rank(df, key, seed, "_position", ordered)
    size = batch_size * replicas
    batch_id = F.call_function("div", F.col("_position") - 1, F.lit(size))
    return ranked.withColumn(batch, batch_id).drop("_position")
