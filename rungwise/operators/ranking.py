"""Global ranks without a one-task sort.

A window without partitions pulls a whole table into one task. Here rows go
to many buckets whose order is known, buckets are counted (a few rows), and a
row's rank is its bucket's offset plus its rank inside the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rungwise.functions.hashing import HASH_RANGE, row_hash
from rungwise.session import checkpointed, shuffle_width

# Granularity only: any number of buckets gives the same ranks.
MAX_BUCKET_BITS = 16


def _bucket_bits(df: DataFrame) -> int:
    """Four buckets per shuffle partition, at most 2**16, so offsets stay broadcastable."""
    return min(MAX_BUCKET_BITS, max(3, (4 * shuffle_width(df.sparkSession) - 1).bit_length()))


def _offsets(counts: DataFrame, bucket: str) -> DataFrame:
    """Rows before each bucket; ``counts`` has one row per bucket."""
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))


def hash_rank(
    df: DataFrame, key: str, seed: int = 0, position: str = "position", ordered: bool = False
) -> DataFrame:
    """Number all rows 1..n in the order of ``row_hash(key, seed)``, key as tie-break.

    ``key`` is a row key (unique). Its hash values spread evenly, so buckets
    are even for any key distribution. A bucket depends on the row alone: a
    lost executor or a retry cannot change a rank. ``ordered`` also lays
    partitions out in rank order. The table is shuffled once; the bucket
    counts read only the key.
    """
    bits = _bucket_bits(df)
    hashed = df.withColumn("_hash", row_hash(key, seed))
    bucketed = hashed.withColumn("_bucket", F.shiftright("_hash", HASH_RANGE.bit_length() - 1 - bits))
    offsets = _offsets(bucketed.groupBy("_bucket").count(), "_bucket")
    spread = bucketed.repartitionByRange("_bucket") if ordered else bucketed
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    return (
        spread.withColumn("_local", local)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(position, F.col("_before") + F.col("_local"))
        .drop("_bucket", "_hash", "_before", "_local")
    )


def global_rank(df: DataFrame, order: list[Column], position: str = "position") -> DataFrame:
    """Number all rows 1..n in any order, ties broken arbitrarily.

    Spark's range sort picks the bucket borders from a sample, so the sorted
    rows are checkpointed before they are counted: both uses then see the same
    partitions. Broadcasts one row per partition.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = checkpointed(
        sorted_rows.withColumn("_part", F.spark_partition_id()).withColumn(
            "_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
        )
    )
    offsets = _offsets(numbered.groupBy("_part").count(), "_part")
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(position, F.col("_before") + F.col("_local"))
        .drop("_part", "_local", "_before")
    )


def nth_smallest(df: DataFrame, key: str, n: int, slots: int = 1024) -> int | None:
    """The n-th smallest value of an integer key (the largest if there are fewer).

    Counts ranges of 2**s keys, with s such that ``slots`` of them cover the
    keys, keeps the one that holds the n-th value and repeats inside it; each
    pass is a partial aggregation behind a pushed-down range filter and returns
    at most ``slots`` + 1 rows. Shifts do not overflow, so keys may be any bigint.
    """
    lo, hi, total = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if not total or n >= total:
        return hi
    below = 0
    while lo < hi:
        shift = max(0, (hi - lo).bit_length() - slots.bit_length() + 1)
        inside = df.filter(F.col(key).between(lo, hi))
        slot = F.shiftright(F.col(key).cast("bigint"), shift)
        for slot_id, rows in inside.groupBy(slot.alias("slot")).count().orderBy("slot").collect():
            if below + rows >= n:
                lo, hi = max(lo, slot_id << shift), min(hi, (slot_id + 1 << shift) - 1)
                break
            below += rows
    return lo
