"""Bag unions and copies of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(*frames: DataFrame, by_name: bool = False) -> DataFrame:
    """Bag union, by position or by name."""
    return reduce(DataFrame.unionByName if by_name else DataFrame.union, frames)


def bag_multiply(
    df: DataFrame, m: int, partitions: int | None = None, slices: int = 1, copy: str | None = None
) -> DataFrame:
    """``m`` copies of every row: one plan node, whatever ``m`` is.

    Copies are made inside the task that holds the row. With ``partitions`` the
    rows are spread before they multiply, so the shuffle moves each row once
    and never its copies; ``slices`` cuts one row's copies into that many
    pieces first, for a table with fewer rows than tasks. ``copy`` names a
    column for the copy's number.
    """
    if m < 1 or slices < 1:
        raise ValueError("m and slices must be at least 1")
    if slices == 1:
        spread = df.repartition(partitions) if partitions else df
        numbers = F.sequence(F.lit(0), F.lit(m - 1))
        grown = spread.select("*", F.explode(numbers).alias("_copy"))
    else:
        depth = -(-m // slices)
        starts = F.sequence(F.lit(0), F.lit(m - 1), F.lit(depth))
        pieces = df.select("*", F.explode(starts).alias("_start"))
        spread = pieces.repartition(partitions) if partitions else pieces
        ends = F.least(F.col("_start") + (depth - 1), F.lit(m - 1))
        grown = spread.select("*", F.explode(F.sequence("_start", ends)).alias("_copy")).drop("_start")
    return grown.withColumnRenamed("_copy", copy) if copy else grown.drop("_copy")


def ladder_rungs(max_m: int, step: int) -> list[int]:
    """Copies at each rung: one table, then ``step`` more per round below ``max_m``."""
    return [added + 1 for added in range(0, max_m, step)]


def scaling_ladder(df: DataFrame, max_m: int, step: int, partitions: int | None = None) -> list[tuple[int, DataFrame]]:
    """(m, table of m copies) for each rung; each is one ``bag_multiply`` of the base."""
    return [(m, bag_multiply(df, m, partitions)) for m in ladder_rungs(max_m, step)]
