"""Projection and filter operators; all narrow, none shuffles."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

INDEX_SUFFIX = "_index"


class Layout(NamedTuple):
    """Which columns are text, which are numbers, and which is the label."""

    text: list[str]
    numeric: list[str]
    label: str

    @property
    def features(self) -> list[str]:
        """Feature names after indexing: indexed text first, then numbers in table order."""
        return [name + INDEX_SUFFIX for name in self.text] + self.numeric


def fill_missing_numeric(df: DataFrame, value: float = 0, columns: list[str] | None = None) -> DataFrame:
    """Nulls in numeric columns (all, or those named) become ``value``; strings keep theirs."""
    return df.na.fill(value, subset=columns)


def feature_layout(df: DataFrame, label: str | None = None, key: str | None = None) -> Layout:
    """The last column is the label unless named; a key is no feature."""
    label = label or df.columns[-1]
    fields = [f for f in df.schema.fields if f.name not in (label, key)]
    text = [f.name for f in fields if isinstance(f.dataType, StringType)]
    return Layout(text, [f.name for f in fields if f.name not in text], label)


def cast_integer(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Numbers to int, toward zero, in one projection."""
    chosen = set(columns if columns is not None else df.columns)
    wanted = {
        f.name for f in df.schema.fields if f.name in chosen and isinstance(f.dataType, NumericType)
    }
    return df.select(
        [F.col(c).cast("int").alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def select_columns(df: DataFrame, columns: list[str], name: str | None = None) -> DataFrame:
    chosen = df.select(*columns)
    return chosen.alias(name) if name else chosen


def drop_column(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def is_correct(label: str, prediction: str) -> Column:
    """Label (int) against prediction (double); null when either is null."""
    return F.col(label).cast("double") == F.col(prediction).cast("double")


def filter_correct(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.filter(is_correct(label, prediction))


def long_form(df: DataFrame, key: list[str], array: str, position: str = "position", value: str = "value") -> DataFrame:
    """One row per array cell: key columns, position from 0, value.

    The outer form plus a filter on its output: for the plain form the
    optimizer adds a size check below, which works out a computed array again.
    """
    cells = df.select(*key, F.posexplode_outer(array).alias(position, value))
    return cells.filter(F.col(position).isNotNull())
