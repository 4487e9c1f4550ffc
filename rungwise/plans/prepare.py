"""Raw table to feature vectors."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from rungwise.operators.columns import INDEX_SUFFIX, Layout, cast_integer, fill_missing_numeric
from rungwise.operators.indexing import category_counts, fit_indexers, indexer_models

FEATURES = "features"
INDEXED_LABEL = "indexedLabel"
LABEL_RANK = "_label_rank"
INTEGER_SUFFIX = "_int"


def _integer_stage(columns: list[str]) -> SQLTransformer:
    """Int copies of all features in one projection, as a stage that saves with the model."""
    whole = [f"CAST(`{c}` AS INT) AS `{c}{INTEGER_SUFFIX}`" for c in columns]
    return SQLTransformer(statement=f"SELECT *, {', '.join(whole)} FROM __THIS__")


def vector_stages(layout: Layout, nominal: bool = False) -> list:
    """Indexed columns to one vector.

    By default category codes become plain ordered integers; ``nominal`` keeps
    them marked as categories, for a tree with ``bins`` above their number.
    """
    if nominal:
        return [VectorAssembler(inputCols=layout.features, outputCol=FEATURES, handleInvalid="error")]
    whole = [c + INTEGER_SUFFIX for c in layout.features]
    assembler = VectorAssembler(inputCols=whole, outputCol=FEATURES, handleInvalid="error")
    return [_integer_stage(layout.features), assembler]


def prepare_pipeline(df: DataFrame, layout: Layout, unseen: str = "error") -> PipelineModel:
    """All indexers, label included, fitted as one unit on ``df``."""
    columns = [*layout.text, layout.label]
    outputs = [*[c + INDEX_SUFFIX for c in layout.text], INDEXED_LABEL]
    return fit_indexers(df, columns, unseen, outputs)


def indexed_integers(df: DataFrame, model: PipelineModel, layout: Layout, key: str) -> DataFrame:
    """Key, features and label as indexed integers."""
    columns = [*layout.features, INDEXED_LABEL]
    return cast_integer(model.transform(df).select(key, *columns), columns)


def fit_features(
    train: DataFrame, layout: Layout, nominal: bool = False
) -> PipelineModel:
    """Learn category ranks from the training rows only, in one pass.

    Text and label are counted together; unseen categories later get a rank of
    their own, unseen labels are an error. The ranks live in the model. A column
    whose categories grow with the table is indexed first, with ``fit_ranks`` and
    ``apply_ranks``, and enters the layout as a number: its ranks stay a table.
    """
    outputs = [LABEL_RANK, *[c + INDEX_SUFFIX for c in layout.text]]
    columns = [layout.label, *layout.text]
    counts = category_counts(train, columns).collect()
    label = indexer_models(counts, columns[:1], outputs[:1], "error")
    # One stage per column: each column's unseen rank is its own number of categories.
    text = indexer_models(counts, columns[1:], outputs[1:], "keep")
    return PipelineModel([*label, *text, *vector_stages(layout, nominal)])


def apply_features(model: PipelineModel, df: DataFrame, layout: Layout, keys: list[str]) -> DataFrame:
    """Keys, ``features`` and ``indexedLabel`` (int), missing numbers as 0.

    The label keeps its class count as metadata, which saves the tree a pass
    over the table. Split before this step: no filter passes the ML stages.
    """
    rows = model.transform(fill_missing_numeric(df, columns=layout.numeric))
    classes = {
        "ml_attr": {"type": "nominal", "name": INDEXED_LABEL, "vals": list(model.stages[0].labels)}
    }
    label = F.col(LABEL_RANK).cast("int").alias(INDEXED_LABEL, metadata=classes)
    return rows.select(*keys, FEATURES, label)


def scorer(features: PipelineModel, classifier) -> PipelineModel:
    """Raw unlabelled rows to predictions: the feature stages and a fitted classifier."""
    return PipelineModel([*features.stages[1:], classifier])
