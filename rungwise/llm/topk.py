"""Exact top-k inner products from a bit-sliced index.

Components are integers. A block of rows keeps, for every component, its least
value and the binary digits of what lies above it: one bitmap over the block's rows
per digit. A query's score is a sum of shifted slices: each one-bit of a positive
factor adds the component's slices at that shift, a negative factor adds their
complements, and constants make up the rest. Slices of equal weight are added three at a
time into a sum and a carry. The score's own slices are then read from the most
significant downward: rows with a one are taken while they fit into k, and at the end
rows with all digits equal to the boundary's are exact ties, taken by smaller id.

Queries are a stated set; they meet the rows in blocks of both, so a task holds one
block's slices and one chunk of queries. Every row is indexed.

Components and scores are exact integers of any size; where a block has components
beyond 62 bits, Python's integers stand in for numpy's. A score that does not fit into a
long is reported as the nearest long, and ranked by its exact value.

Vectors that are null or hold null or non-finite components, and rows without id take no part. Shorter vectors count as
ending in zeros. A query is not compared with rows of its own id. Repeated rows of
another id each count; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rungwise.llm.blocks import groups
from rungwise.llm.common import read_table
from rungwise.session import scratch_path

BLOCK = 1 << 16  # rows of one block: a bitmap is 8 KiB
CHUNK = 128  # queries of one task
SCALE = 256
INDEX = "block int, dim int, bit int, bits binary"
IDS, LOWS = -1, -2  # values of dim: the block's ids, the least value of each component
WIDEST = 1 << 31  # of ``quantised``, whose integers are longs
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1
FOUND = "query_id long, vec_id long, score long, beyond binary"


def usable(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def quantised(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, q``: components times ``scale``, rounded down, of the rows that take part and fit below ``WIDEST``."""
    whole = table.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    rows = whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double") * scale).alias("s"), scaled.alias("q"))
    return rows.filter(F.forall("s", lambda x: F.abs(x) < WIDEST)).select("vec_id", "q")


def gridded(table: DataFrame) -> DataFrame:
    """``vec_id, q``: components of all rows that take part, rounded down to ``1 / SCALE``; exact as doubles of any size."""
    whole = table.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    down = lambda x: F.when(F.abs(x) < float(1 << 44), F.floor(x * SCALE) / SCALE).otherwise(x)
    return whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: down(x.cast("double"))).alias("q"))


def integers(values: np.ndarray) -> np.ndarray:
    """Doubles on the grid of ``1 / SCALE`` as integers, those of Python where longs are too short."""
    if not len(values) or np.abs(values).max() < 1 << 53:
        return (values * SCALE).astype(np.int64)
    return np.array([int(v) * SCALE if abs(v) >= 1 << 44 else int(v * SCALE) for v in values.tolist()], dtype=object)


def order_key(number: int) -> bytes:
    """Bytes that are in the order of the integers they stand for."""
    size = (abs(number).bit_length() + 7) // 8
    digits = size.to_bytes(2, "big") + abs(number).to_bytes(size, "big")
    return b"\x01" + digits if number >= 0 else b"\x00" + bytes(255 - d for d in digits)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists as rows of integers, short ones filled with zeros; doubles are on the grid of ``1 / SCALE``."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    flat = integers(flat) if flat.dtype.kind == "f" else flat
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=object if flat.dtype == object else np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


def bitmap(flags: np.ndarray) -> np.ndarray:
    """Flags as little-endian words of 64."""
    packed = np.packbits(flags, bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8, dtype=np.uint8)]).view(np.uint64)


def slice_rows(block: int, ids: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
    """The index of one block, rows in order of their ids."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    lows = values.min(axis=0)
    yield block, IDS, 0, ids.astype("<i8").tobytes()
    yield block, LOWS, 0, ",".join(map(str, lows.tolist())).encode()
    above = values - lows
    for dim in range(above.shape[1]):
        for bit in range(int(above[:, dim].max()).bit_length()):
            digit = (above[:, dim] >> bit & 1).astype(np.uint8)
            if digit.any():
                yield block, dim, bit, bitmap(digit).tobytes()


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """Slices of every row; ``blocks`` blocks by a hash of the id."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    dealt = dealt.repartition("block").sortWithinPartitions("block").select("block", "vec_id", "q")

    def run(batches):
        for table in groups(batches, 1):
            found = slice_rows(table["block"][0].as_py(), table["vec_id"].to_numpy(), matrix(table["q"]))
            for row in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                    names=["block", "dim", "bit", "bits"],
                )

    return dealt.mapInArrow(run, INDEX)


class Block:
    """One block's slices in memory."""

    def __init__(self, dims: list[int], bits: list[int], data: list[bytes]):
        self.slices: dict[int, list[tuple[int, np.ndarray]]] = {}
        for dim, bit, raw in zip(dims, bits, data):
            if dim == IDS:
                self.ids = np.frombuffer(raw, dtype="<i8")
            elif dim == LOWS:
                self.lows = [int(low) for low in raw.split(b",") if low]
            else:
                self.slices.setdefault(dim, []).append((bit, np.frombuffer(raw, dtype=np.uint64)))
        self.exists = bitmap(np.ones(len(self.ids), dtype=np.uint8))

    def score_slices(self, query: np.ndarray) -> tuple[int, list[np.ndarray]]:
        """Constant and slices, least significant first: score = constant + the sum of 2^w slice w."""
        constant, columns = 0, []
        for dim, factor in enumerate(query.tolist()[: len(self.lows)]):
            size = abs(factor)
            constant += factor * self.lows[dim]
            held = self.slices.get(dim, ())
            if factor < 0:  # -a x = a (2^b - 1 - x) - a (2^b - 1), digit by digit
                constant -= size * sum(1 << bit for bit, _ in held)
                held = [(bit, words ^ self.exists) for bit, words in held]
            shift = 0
            while size:
                if size & 1:
                    for bit, words in held:
                        while len(columns) <= bit + shift:
                            columns.append([])
                        columns[bit + shift].append(words)
                size, shift = size >> 1, shift + 1
        out, weight = [], 0
        while weight < len(columns):
            column = columns[weight]
            if len(column) > 1 and weight + 1 == len(columns):
                columns.append([])
            while len(column) > 2:
                a, b, c = column.pop(), column.pop(), column.pop()
                ab = a ^ b
                column.insert(0, ab ^ c)
                columns[weight + 1].append(a & b | ab & c)
            if len(column) == 2:
                a, b = column
                columns[weight + 1].append(a & b)
                column = [a ^ b]
            out.append(column[0] if column else np.zeros_like(self.exists))
            weight += 1
        return constant, out

    def top(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The block's best (id, score), in order."""
        constant, digits = self.score_slices(query)
        left = self.exists.copy()
        for own in range(*np.searchsorted(self.ids, [query_id, query_id + 1])):
            left[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        taken = np.zeros_like(left)
        wanted = k
        for digit in reversed(digits):
            ones = left & digit
            count = int(np.bitwise_count(ones).sum())
            if count >= wanted:
                left = ones
            else:
                taken |= ones
                wanted -= count
                left &= ~digit
        sure, ties = (np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little")) for x in (taken, left))
        rows = np.concatenate([sure, ties[:wanted]])
        found = []
        for row in rows.tolist():
            place, off = row >> 6, np.uint64(row & 63)
            score = constant + sum(int(digit[place] >> off & np.uint64(1)) << w for w, digit in enumerate(digits))
            found.append((int(self.ids[row]), score))
        return sorted(found, key=lambda pair: (-pair[1], pair[0]))


def top_products(rows: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best rows; both inputs are ``vec_id, q`` (longs or ``gridded``)."""
    spark = rows.sparkSession
    blocks, chunks = max(1, -(-rows.count() // block)), max(1, -(-queries.count() // chunk))
    folder = scratch_path(spark, "slices")
    build_index(rows, blocks).write.parquet(folder)
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    index = spark.read.parquet(folder).select("*", every_chunk)
    asked = queries.select("vec_id", "q", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk"), every_block)

    def run(slices: pa.Table, some: pa.Table) -> pa.Table:
        out = []
        if slices.num_rows and some.num_rows:
            held = Block(slices["dim"].to_pylist(), slices["bit"].to_pylist(), slices["bits"].to_pylist())
            for query_id, query in zip(some["vec_id"].to_pylist(), matrix(some["q"])):
                for vec_id, score in held.top(query_id, query, k):
                    near = min(max(score, LEAST_LONG), MOST_LONG)
                    out.append((query_id, vec_id, near, order_key(score - near)))
        columns = [pa.array([row[i] for row in out], pa.binary() if i == 3 else pa.int64()) for i in range(4)]
        return pa.table(columns, names=["query_id", "vec_id", "score", "beyond"])

    found = index.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(
        run, FOUND
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gridded(read_table(spark, sf_dir, "embeddings"))
    return top_products(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)


OP4_SQL = """
WITH whole AS (
  SELECT vec_id, [CAST(floor(256 * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(coalesce(list_sum([a.q[i] * b.q[i] FOR i IN range(1, 1 + least(len(a.q), len(b.q)))]), 0) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
