"""Run logs and training histories.

One run may hold a large share of all rows, so nothing here sorts a whole run
in one task: first values are aggregates, and running maxima are taken in
slices of the step column.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from rungwise.session import shuffle_width

# Fixed values of the census table: rows, features, bits per value, bytes per copy.
CENSUS_ROWS = 32561
CENSUS_FEATURES = 14
VALUE_BITS = 32
COPY_BYTES = 1272824

# More slices only cost the driver a longer list of borders.
MAX_SLICES = 4096


def scale_factor(log: DataFrame, run: str, step: str, seconds: str, output: str = "scale") -> DataFrame:
    """Seconds over the first seconds of the run.

    The first value per run is a partial aggregate joined back by run: small
    enough run tables are broadcast, a hot run is split by the skew join.
    """
    firsts = log.groupBy(F.col(run).alias("_run")).agg(F.min_by(seconds, step).alias("_first"))
    return (
        log.join(firsts, F.col(run).eqNullSafe(F.col("_run")))
        .withColumn(output, F.col(seconds) / F.nullif(F.col("_first"), F.lit(0)))
        .drop("_run", "_first")
    )


def size_bits(m: Column, rows: int = CENSUS_ROWS, features: int = CENSUS_FEATURES) -> Column:
    return m.cast("bigint") * (rows * features * VALUE_BITS)


def size_megabytes(m: Column, copy_bytes: int = COPY_BYTES) -> Column:
    return m.cast("bigint") * copy_bytes / F.lit(1000000)


def dataset_size(log: DataFrame, m: str) -> DataFrame:
    """Copies to size, in bits of the assembled table and in megabytes."""
    return log.withColumns(
        {"size_bits": size_bits(F.col(m)), "size_mb": size_megabytes(F.col(m))}
    )


def node_comparison(log: DataFrame, nodes: str, m: str, seconds: str) -> DataFrame:
    """Seconds at the largest m, by node count."""
    return log.groupBy(nodes).agg(F.max_by(seconds, m).alias("last_dt"))


def accuracy_by_size(log: DataFrame, run: str, m: str, accuracy: str) -> DataFrame:
    return log.select(run, size_megabytes(F.col(m)).alias("size_mb"), F.col(accuracy).alias("accuracy"))


def history_long(history: DataFrame, epoch: str, metrics: list[str]) -> DataFrame:
    """One row per epoch and metric."""
    return history.unpivot([epoch], metrics, "metric", "value")


def _step_slices(df: DataFrame, step: str, slices: int) -> DataFrame:
    """Add ``_slice``: ranges of the step with about equal row counts over the whole table.

    Borders come from a quantile sketch and only balance the work; any borders
    give the same result.
    """
    shares = [i / slices for i in range(1, slices)]
    borders = df.approxQuantile(step, shares, 0.25 / slices) if slices > 1 else []
    if not borders:
        return df.withColumn("_slice", F.lit(0))
    splits = [float("-inf"), *sorted(set(borders)), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol=step, outputCol="_slice", handleInvalid="keep")
    return bucketizer.transform(df).withColumn("_slice", F.col("_slice").cast("int"))


def best_checkpoint(
    history: DataFrame, run: str, step: str, metric: str, slices: int | None = None
) -> DataFrame:
    """Epochs that beat every earlier one of their run; ``kept`` marks the last of them.

    ``step`` is numeric and unique within a run. A running maximum over a run
    is split in slices of the step: the best of earlier slices comes from one
    row per (run, slice), the best within a slice from a window over the
    slice, so no task sees more of a run than one slice holds. Rows that do
    not beat the earlier slices are dropped before the window's shuffle. Null
    and NaN beat nothing and are left out.
    """
    slices = slices or min(MAX_SLICES, shuffle_width(history.sparkSession))
    sliced = _step_slices(history.filter(F.col(metric).isNotNull() & ~F.isnan(metric)), step, slices)
    per_slice = sliced.groupBy(run, "_slice").agg(F.max(metric).alias("_slice_best"))
    whole = Window.partitionBy(run)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bests = per_slice.select(
        F.col(run).alias("_run"),
        F.col("_slice").alias("_of_slice"),
        F.max("_slice_best").over(earlier).alias("_before"),
        F.max("_slice_best").over(whole).alias("_best"),
    )
    same_slice = F.col(run).eqNullSafe(F.col("_run")) & (F.col("_slice") == F.col("_of_slice"))
    value = F.col(metric)
    hopeful = sliced.join(bests, same_slice).filter(F.col("_before").isNull() | (value > F.col("_before")))
    within = Window.partitionBy(run, "_slice").orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    return (
        hopeful.withColumn("_local", F.max(metric).over(within))
        .filter(F.col("_local").isNull() | (value > F.col("_local")))
        .withColumn("kept", value == F.col("_best"))
        .drop("_slice", "_local", "_run", "_of_slice", "_before", "_best")
    )
