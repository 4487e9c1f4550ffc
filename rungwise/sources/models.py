"""Fitted models in and out of storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_difference(df: DataFrame, first: PipelineModel, second: PipelineModel) -> DataFrame:
    """One row: rows scored, and rows on which the two models disagree.

    Both models score each row in the same pass, so no join is needed.
    """
    once = first.transform(df).select(*df.columns, F.col("prediction").alias("_first"))
    twice = second.transform(once)
    same = F.col("prediction").eqNullSafe(F.col("_first"))
    return twice.agg(F.count("*").alias("rows"), F.count_if(~same).alias("differing"))


def model_roundtrip(df: DataFrame, model: PipelineModel, path: str) -> DataFrame:
    """Save, load, score again: ``differing`` must be 0."""
    save_model(model, path)
    return score_difference(df, model, load_model(path))
