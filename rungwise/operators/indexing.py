"""Categories to ranks by falling frequency, ties by rising value."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from rungwise.operators.columns import INDEX_SUFFIX, long_form
from rungwise.operators.ranking import global_rank

def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) of every category, all columns in one pass.

    Counts are merged in the tasks and then by (column, value) across the
    cluster. The indexer's own fit merges whole category maps in one task.
    """
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    cells = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    return cells.groupBy("column", "value").count()


def nominal(name: str, values: int) -> dict:
    """Metadata of an index column: the number of its values, the same however the index was made."""
    return {"ml_attr": {"name": name, "type": "nominal", "num_vals": values}}


def indexer_models(counts: list, columns: list[str], outputs: list[str], unseen: str) -> list[StringIndexerModel]:
    """One indexer per column from collected (column, value, count); a model lists its categories, so the driver holds them."""
    labels: dict[str, list] = {c: [] for c in columns}
    for column, value, count in counts:
        if column in labels:
            labels[column].append((-count, value))
    return [
        StringIndexerModel.from_labels([v for _, v in sorted(labels[c])], c, output, handleInvalid=unseen)
        for c, output in zip(columns, outputs)
    ]


def fit_indexers(
    df: DataFrame,
    columns: list[str],
    unseen: str = "error",
    outputs: list[str] | None = None,
) -> PipelineModel:
    """An indexer per column, all fitted in one pass over ``df``.

    The model lists every category on the driver. Columns whose categories grow
    with the table are the caller's to name: ``fit_ranks`` keeps those in a table.
    """
    counts = category_counts(df, columns).collect()
    return PipelineModel(indexer_models(counts, columns, outputs or [c + INDEX_SUFFIX for c in columns], unseen))


def fit_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, rank) of all categories of wide columns, as a table.

    Ranks are by falling frequency and rising value, from 0 in each column; categories
    are counted and ranked by the cluster, whatever their number. The table can be
    written, read again and given to ``apply_ranks``, to score rows later.
    """
    counts = category_counts(df, columns)
    ranked = [
        global_rank(counts.filter(F.col("column") == c), [F.desc("count"), F.asc("value")], "_rank") for c in columns
    ]
    return reduce(DataFrame.unionByName, ranked).select("column", "value", (F.col("_rank") - 1).cast("double").alias("rank"))


def apply_ranks(df: DataFrame, ranks: DataFrame, columns: list[str], unseen: str = "keep") -> DataFrame:
    """Add ``<column>_index`` from a table of ``fit_ranks``, with the metadata ``string_index`` gives.

    ``unseen`` and null categories are kept under a rank of their own, skipped or an error.
    """
    sizes = dict(ranks.groupBy("column").agg(F.count("*")).collect())
    for column in columns:
        df = index_by_join(df, column, column + INDEX_SUFFIX, unseen, ranks, sizes.get(column, 0))
    return df


def index_by_join(
    df: DataFrame, column: str, output: str, unseen: str, ranks: DataFrame, size: int
) -> DataFrame:
    """The index of one column from a table of ranks with ``size`` categories of it.

    Spark broadcasts the ranks only if they are small, and splits a hot
    category's partition in the join otherwise.
    """
    own = ranks.filter(F.col("column") == column).select(F.col("value").alias("_value"), F.col("rank").alias(output))
    joined = df.withColumn("_text", F.col(column).cast("string")).join(own, F.col("_text") == F.col("_value"), "left")
    found = F.col(output)
    if unseen == "keep":
        found = F.coalesce(found, F.lit(float(size)))
    elif unseen == "error":
        found = F.coalesce(found, F.raise_error(F.lit(f"null or unseen category in {column}")).cast("double"))
    else:
        joined = joined.filter(found.isNotNull())
    marked = found.alias(output, metadata=nominal(output, size + (unseen == "keep")))
    return joined.select(*[F.col(c) for c in df.columns], marked)


def string_index(
    df: DataFrame, columns: list[str], unseen: str = "error", wide: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``<column>_index`` (double) for every column.

    Columns the caller names as ``wide`` are indexed by a join with a table of
    ranks, the others by an indexer; values and metadata are the same.
    """
    narrow, indexed = [c for c in columns if c not in wide], df
    if narrow:
        model = fit_indexers(df, narrow, unseen)
        sizes = {c: len(stage.labels) + (unseen == "keep") for c, stage in zip(narrow, model.stages)}
        plain = [F.col(c) for c in df.columns]
        index = [F.col(c + INDEX_SUFFIX).alias(c + INDEX_SUFFIX, metadata=nominal(c + INDEX_SUFFIX, sizes[c])) for c in narrow]
        indexed = model.transform(df).select(*plain, *index)
    if wide:
        indexed = apply_ranks(indexed, fit_ranks(df, list(wide)), list(wide), unseen)
    return indexed.select(*df.columns, *[c + INDEX_SUFFIX for c in columns])


def label_index(df: DataFrame, label: str, output: str = "indexedLabel") -> tuple[DataFrame, list[str]]:
    """Add the label's index; also returns the labels in index order."""
    model = fit_indexers(df, [label], outputs=[output])
    return model.transform(df), list(model.stages[0].labels)


def label_restore(df: DataFrame, index: str, labels: list[str], output: str) -> DataFrame:
    """Index back to label text."""
    return IndexToString(inputCol=index, outputCol=output, labels=labels).transform(df)


def assemble_vector(df: DataFrame, columns: list[str], output: str = "features", nulls: str = "error") -> DataFrame:
    """Columns to one vector; a null is an error unless ``nulls`` is keep or skip."""
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid=nulls).transform(df)


def vector_cells(df: DataFrame, key: list[str], vector: str = "features") -> DataFrame:
    """A vector column in long form."""
    return long_form(df.withColumn(vector, vector_to_array(vector)), key, vector)


def one_hot_vector(df: DataFrame, column: str, output: str, classes: int) -> DataFrame:
    """One-hot as an ML vector, no class dropped."""
    attributes = {"ml_attr": {"type": "nominal", "name": column, "num_vals": classes}}
    marked = df.withColumn(column, F.col(column).cast("double")).withMetadata(column, attributes)
    encoder = OneHotEncoder(inputCols=[column], outputCols=[output], dropLast=False)
    return encoder.fit(marked).transform(marked)
