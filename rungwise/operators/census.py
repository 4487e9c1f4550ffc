"""Preparation steps described with the census table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

UNKNOWN = "?"


def range_filter(df: DataFrame, above: dict[str, float]) -> DataFrame:
    """Rows where every named column exceeds its bound; the bounds reach the scan."""
    return df.filter(reduce(Column.__and__, [F.col(c) > F.lit(b) for c, b in above.items()]))


def label_threshold(df: DataFrame, column: str, threshold: float, label: str = "label") -> DataFrame:
    """A number cut into ``>50K`` or ``<=50K``; a null stays null."""
    name = f"{threshold / 1000:g}K"
    amount = F.col(column)
    return df.withColumn(
        label, F.when(amount > threshold, F.lit(">" + name)).when(amount <= threshold, F.lit("<=" + name))
    )


def unknown_to_null(df: DataFrame, columns: list[str], unknown: str = UNKNOWN) -> DataFrame:
    return df.withColumns({c: F.nullif(F.trim(c), F.lit(unknown)) for c in columns})


def null_to_unknown(df: DataFrame, columns: list[str], unknown: str = UNKNOWN) -> DataFrame:
    return df.na.fill(unknown, subset=columns)


def is_complete(columns: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def drop_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every named column."""
    return df.na.drop(subset=columns)


def unknown_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows before and after ``drop_unknown``, in one pass."""
    return df.agg(
        F.count("*").alias("rows_before"), F.count_if(is_complete(columns)).alias("rows_after")
    )


def class_priors(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Share of each class over all rows and over the rows without unknowns.

    Counted per class with partial aggregation; the totals are then summed
    over the handful of class rows.
    """
    counts = df.groupBy(label).agg(
        F.count("*").alias("rows_all"), F.count_if(is_complete(columns)).alias("rows_known")
    )
    every = Window.partitionBy()

    def share(rows: str) -> Column:
        return F.col(rows) / F.nullif(F.sum(rows).over(every), F.lit(0))

    return counts.select(
        label,
        "rows_all",
        "rows_known",
        share("rows_all").alias("share_all"),
        share("rows_known").alias("share_known"),
    )


def duplicate_conflicts(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Groups of rows with equal features: how many copies, how many labels.

    Counting (features, label) first merges copies before any shuffle, so a
    feature set held by a third of all rows arrives as a few rows per task.
    """
    per_label = df.groupBy(*features, label).agg(F.count("*").alias("n"))
    groups = per_label.groupBy(*features).agg(
        F.sum("n").alias("copies"), F.count(label).alias("labels")
    )
    return groups.filter(F.col("copies") > 1).withColumn("conflicting", F.col("labels") > 1)
