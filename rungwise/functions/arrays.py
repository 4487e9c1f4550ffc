"""Helpers for array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` over a struct of values that are worked out once per row.

    A column used inside a lambda is otherwise evaluated again for every
    element the lambda sees: the optimizer inlines it there.
    """
    bound = F.struct(*[value.alias(name) for name, value in values.items()])
    return F.element_at(F.transform(F.array(bound), body), 1)


def array_total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
