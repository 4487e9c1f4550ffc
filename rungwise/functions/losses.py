"""Per-row losses over array columns; average them with ``avg``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rungwise.functions.arrays import array_total, bind

PROBABILITY_FLOOR = 1e-7


def one_hot(label: Column, classes: int) -> Column:
    """0/1 array of length ``classes``; null for a null label, all zeros out of range."""
    spots = F.sequence(F.lit(0), F.lit(classes - 1))
    return F.when(
        label.isNotNull(), F.transform(spots, lambda c: (c == label).cast("float"))
    )


def softmax(scores: Column) -> Column:
    """Class probabilities from raw scores, shifted by the largest for range."""

    def raised(row: Column) -> Column:
        return F.transform(row["scores"], lambda s: F.exp(s.cast("double") - row["top"]))

    def shares(row: Column) -> Column:
        return F.transform(row["raised"], lambda e: e / row["total"])

    def normalised(row: Column) -> Column:
        return bind({"raised": row["raised"], "total": array_total(row["raised"])}, shares)

    top = F.array_max(scores).cast("double")
    return bind({"raised": bind({"scores": scores, "top": top}, raised)}, normalised)


def xent_smoothed(probabilities: Column, label: Column, classes: int, smoothing: float = 0.0) -> Column:
    """Cross-entropy against a one-hot target mixed with the uniform one."""
    target = F.transform(
        one_hot(label, classes),
        lambda y: y.cast("double") * (1.0 - smoothing) + smoothing / classes,
    )
    terms = F.zip_with(
        target, probabilities, lambda t, p: t * F.log(F.greatest(p.cast("double"), F.lit(PROBABILITY_FLOOR)))
    )
    return -array_total(terms)


def xent_logits(scores: Column, label: Column) -> Column:
    """Cross-entropy of an integer label against raw scores (log-sum-exp form)."""

    def log_total(row: Column) -> Column:
        total = F.aggregate(
            row["scores"], F.lit(0.0), lambda acc, s: acc + F.exp(s.cast("double") - row["top"])
        )
        return F.log(total) + row["top"]

    top = F.array_max(scores).cast("double")
    return bind({"scores": scores, "top": top}, log_total) - F.get(scores, label).cast("double")


def squared_error(left: Column, right: Column) -> Column:
    """Mean squared difference of two arrays of equal length."""
    gaps = F.zip_with(left, right, lambda a, b: a.cast("double") - b.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g) / F.nullif(F.size(left), F.lit(0))
