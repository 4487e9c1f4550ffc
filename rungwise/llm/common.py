"""What the operators of this subpackage share: tables, Arrow batches, word memos."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from weakref import WeakSet

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Rows of one Arrow batch: with long texts the default of 10,000 rows is too much for a Python worker.
BATCH_ROWS = 1_000
# Bytes of one Arrow batch where rows hold long lists: a thousand of those are as much as a partition.
BATCH_BYTES = 8 << 20


def bound_rows(spark: SparkSession) -> None:
    """Arrow batches of the session have at most ``BATCH_ROWS`` rows from here on."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the query's folder; Arrow batches of the session are kept small from here on."""
    bound_rows(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of the session end at ``BATCH_BYTES`` from here on, or hold one row."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    value = spark.conf.get(key)
    if not value.isdigit() or not 0 < int(value) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


class Memo:
    """Values by piece of text, computed in bulk when missing.

    About ``size`` of those used last are remembered: what is found in the older
    half moves to the younger, and the older half goes when the younger is full.
    """

    alive: WeakSet[Memo] = WeakSet()

    def __init__(self, compute: Callable[[list[str]], list[bytes]], size: int = 1 << 19, longest: int = 64):
        self.compute, self.half, self.longest = compute, size // 2, longest
        self.fixed: dict[str, bytes] = {}  # values that ``compute`` does not know
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        Memo.alive.add(self)

    @classmethod
    def forget(cls) -> None:
        """Empty all memos of this Python worker: the next stage may have no use for what an earlier one learnt."""
        for memo in cls.alive:
            memo.clear()

    def clear(self) -> None:
        self.known, self.older = {}, {}

    def values(self, pieces: list[str]) -> list[bytes]:
        found = list(map(self.known.get, pieces))
        if None in found:
            missing = dict.fromkeys(p for p, value in zip(pieces, found) if value is None)
            own = {p: value for p in missing if (value := self.fixed.get(p) or self.older.get(p)) is not None}
            new = [p for p in missing if p not in own]
            own.update(zip(new, self.compute(new)))
            found = [own[p] if value is None else value for p, value in zip(pieces, found)]
            if len(self.known) + len(own) > self.half:
                self.older, self.known = self.known, {}
            self.known.update((p, value) for p, value in own.items() if len(p) <= self.longest)
        return found
