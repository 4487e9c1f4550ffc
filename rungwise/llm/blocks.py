"""Buckets of any size as bounded tasks: large buckets become pairs of chunks, rows come grouped to Python."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Rows compared with one another at once; a larger bucket is dealt out as pairs of chunks of about this size.
CHUNK = 2_048


def chunk_pairs(rows: DataFrame, bucket: str, salt: Column, chunk: int = CHUNK) -> DataFrame:
    """Rows with ``chunk``, ``lo`` and ``hi``: every two rows of a bucket meet in exactly one (lo, hi).

    A bucket within the limit is one task, (0, 0). A larger one is salted into n
    chunks and each row goes to the n pairs that hold its chunk. Two rows of one
    chunk also meet in pairs with other chunks; there only rows of different chunks
    are to be compared (see ``crossing``).
    """
    large = rows.groupBy(bucket).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > chunk)
    parts = F.coalesce(F.ceil(F.col("_rows") / chunk), F.lit(1)).cast("int")
    dealt = rows.join(large, bucket, "left").withColumn("_parts", parts)
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64(salt, F.lit(7)), F.col("_parts")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return dealt.select(
        *rows.columns, "chunk", F.least("chunk", "_other").alias("lo"), F.greatest("chunk", "_other").alias("hi")
    )


def together(dealt: DataFrame, bucket: str) -> DataFrame:
    """Rows of a task next to one another."""
    return dealt.repartition(bucket, "lo", "hi").sortWithinPartitions(bucket, "lo", "hi")


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Neighbouring rows with equal values in the first ``keys`` columns, across batches."""
    held, open_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for start, end in pairwise([0, *changes.tolist(), batch.num_rows]):
            key = tuple(c[start] for c in columns)
            if held and key != open_key:
                yield pa.Table.from_batches(held)
                held = []
            open_key = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def crossing(chunk: np.ndarray, lo: int, hi: int) -> np.ndarray | None:
    """Which pairs of rows are compared here: all (None) in a task of one chunk, else those across its two chunks."""
    return None if lo == hi else chunk[:, None] != chunk[None, :]


def leaders(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the smallest row that links lead to."""
    n = len(linked)
    label = np.arange(n)
    while True:
        near = np.where(linked, label[None, :], n).min(axis=1, initial=n)
        after = np.minimum(label, near)
        after = after[after]
        if (after == label).all():
            return label
        label = after
