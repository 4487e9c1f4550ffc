"""Near-duplicate vectors from randomised-rotation binary codes.

A vector's unit direction is turned by a random frame with orthonormal columns; its code is
the signs, ``code_bits`` of them (more for longer vectors, see ``bits_of``), stored with the correction factor, the inner
product of the signs' direction and the turned vector. For another vector y,
<signs, turned y> / factor is an unbiased estimate of the cosine, and its error stays
within a bound of order sqrt(1 - factor^2) / factor / sqrt(bits - 1). Pairs whose upper bound
is below the threshold are dropped; all others are computed exactly in double precision, so
no pair below the threshold is linked.

Candidates meet by tables of some code bits each: enough bits that a bucket holds
about ``bucket`` vectors, and enough tables that a pair at the threshold is missed
with a chance of ``miss`` at most. A pair that meets in several tables is counted in
the first. Buckets of any size are dealt out as bounded chunk pairs; each reports
sums and a star per connected group, never its pairs. Equal vectors are one class from the start.

Vectors that are null, zero or hold null or non-finite components link with nothing, nor do vectors
of different lengths. Every row gets a row, repeated rows too (they are copies of one another
and linked); a null id is reported as it is. No rows give no rows.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rungwise.llm.blocks import chunk_pairs, crossing, groups, leaders, together
from rungwise.llm.common import read_table
from rungwise.llm.components import components
from rungwise.llm.topk import usable
from rungwise.session import checkpointed

LEAST, CODE_BITS, BUCKET, MISS, SEED = 0.9, 256, 256, 0.005, 20
SURE = 6.0  # units of the error bound (one standard deviation) that an estimate may be off
CODED = "cid long, size long, vector binary, code binary, factor double, buckets array<long>"
LINKS = "u long, v long, n long"


@lru_cache(maxsize=8)
def frame(dim: int, bits: int) -> np.ndarray:
    """``bits`` rows and ``dim`` orthonormal columns, at random but always the same."""
    bits = max(bits, dim)
    square, _ = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((bits, dim)))
    return square


def table_plan(n: int, least: float = LEAST, bucket: int = BUCKET, miss: float = MISS) -> tuple[int, int]:
    """Bits per table and tables for ``n`` vectors."""
    bits = min(30, max(4, round(math.log2(max(n, 2) / bucket))))
    meet = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-meet))


def table_bits(bits: int, tables: int, code_bits: int) -> np.ndarray:
    """Which code bits each table reads: permutations laid end to end, so bits are used evenly."""
    rng = np.random.default_rng(SEED)
    rounds = -(-bits * tables // (code_bits // bits * bits))
    use = [rng.permutation(code_bits)[: code_bits // bits * bits] for _ in range(rounds)]
    return np.concatenate(use)[: bits * tables].reshape(tables, bits)


def bits_of(dim: int, code_bits: int) -> int:
    """Bits of the code of vectors with ``dim`` components: one for each at least, in whole bytes."""
    return -(-max(code_bits, dim) // 8) * 8


@lru_cache(maxsize=8)
def table_masks(bits: int, tables: int, code_bits: int) -> np.ndarray:
    """The bits of ``table_bits`` as one packed code per table."""
    masks = np.zeros((tables, code_bits), dtype=np.uint8)
    np.put_along_axis(masks, table_bits(bits, tables, code_bits), 1, axis=1)
    return np.packbits(masks, axis=1, bitorder="little")


def unit_rows(raw: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1)
    largest = np.abs(rows).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    rows = rows / largest
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def coded(classes: DataFrame, n: int, code_bits: int) -> DataFrame:
    """Code, correction factor and buckets of every class."""
    width, tables = table_plan(n)

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            by_dim: dict[int, list[int]] = {}
            vectors = [np.asarray(v, dtype="<f8") for v in lists.to_pylist()]
            for row, vector in enumerate(vectors):
                by_dim.setdefault(len(vector), []).append(row)
            for dim, rows in by_dim.items():
                raw = [vectors[row].tobytes() for row in rows]
                turned = unit_rows(raw) @ frame(dim, bits_of(dim, code_bits)).T
                signs = turned > 0
                factor = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
                use = table_bits(width, tables, signs.shape[1])
                weights = np.int64(1) << np.arange(width)
                keys = (signs[:, use] * weights).sum(axis=2)
                keys += (np.arange(tables) << 32) + (np.int64(dim % 32768) << 48)
                codes = np.packbits(signs, axis=1, bitorder="little")
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(raw, pa.binary()),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor), pa.array(keys.tolist(), pa.list_(pa.int64()))],
                    names=["cid", "size", "vector", "code", "factor", "buckets"],
                )

    return classes.select("cid", "size", "embedding").mapInArrow(run, CODED)


def class_links(classes: DataFrame, n: int, least: float, code_bits: int) -> DataFrame:
    """Per block: ``u, v, 0`` stars of linked classes and ``u, u, n`` numbers of linked vectors."""
    table = checkpointed(coded(classes, n, code_bits))
    width, tables = table_plan(n)
    rows = table.select(F.explode("buckets").alias("bucket"), "cid", "size", "vector", "code", "factor")
    dealt = together(chunk_pairs(rows, "bucket", F.col("cid")), "bucket").select(
        "bucket", "lo", "hi", "chunk", "cid", "size", "vector", "code", "factor"
    )

    def run(batches):
        for block in groups(batches, 3):
            if block.num_rows < 2:
                continue
            found = linked_pairs(block, least, width, tables)
            across = crossing(block["chunk"].to_numpy(), block["lo"][0].as_py(), block["hi"][0].as_py())
            found &= True if across is None else across
            if not found.any():
                continue
            ids, size = block["cid"].to_numpy(), block["size"].to_numpy()
            number, first = found @ size, leaders(found)
            some, moved = np.flatnonzero(number), np.flatnonzero(first != np.arange(len(ids)))
            u, v = np.concatenate([ids[some], ids[moved]]), np.concatenate([ids[some], ids[first[moved]]])
            n_links = np.concatenate([number[some], np.zeros(len(moved), dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(n_links)], names=["u", "v", "n"])

    return dealt.mapInArrow(run, LINKS)


def linked_pairs(block: pa.Table, least: float, width: int, tables: int) -> np.ndarray:
    """Which rows are linked, of pairs that have not met in an earlier table."""
    unit = unit_rows(block["vector"].to_pylist())
    count, dim = unit.shape
    codes = np.frombuffer(b"".join(block["code"].to_pylist()), dtype=np.uint8).reshape(count, -1)
    bits = codes.shape[1] * 8
    signs = (np.unpackbits(codes, axis=1, bitorder="little").astype(np.float32) * 2 - 1) / np.float32(math.sqrt(bits))
    factor = block["factor"].to_numpy()
    turned = (unit @ frame(dim, bits).T).astype(np.float32)
    estimate = (signs @ turned.T) / factor[:, None]
    bound = SURE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(bits - 1, 1))
    maybe = np.triu(estimate + bound[:, None] >= least, 1)
    i, j = np.nonzero(maybe)
    found = np.zeros((count, count), dtype=bool)
    number = int(block["bucket"][0].as_py() >> 32 & 0xFFFF)
    for start in range(0, len(i), 1 << 18):
        a, b = i[start : start + (1 << 18)], j[start : start + (1 << 18)]
        near = np.einsum("ij,ij->i", unit[a], unit[b]) >= least
        a, b = a[near], b[near]
        new = np.ones(len(a), dtype=bool)
        apart = codes[a] ^ codes[b]
        for earlier in table_masks(width, tables, bits)[:number]:
            new &= (apart & earlier).any(axis=1)
        found[a[new], b[new]] = found[b[new], a[new]] = True
    return found


def near_vectors(table: DataFrame, least: float = LEAST, code_bits: int = CODE_BITS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding``."""
    vector = F.col("embedding")
    fine = usable(vector) & F.exists(vector, lambda x: x != 0)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, vector).alias("embedding"))
    grouped = rows.filter("embedding is not null").groupBy("embedding").agg(F.count("*").alias("size"), F.min("vec_id").alias("first"))
    classes = checkpointed(grouped.withColumn("cid", F.monotonically_increasing_id()))
    links = checkpointed(class_links(classes, classes.count(), least, code_bits))
    number = links.filter("u = v").groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("n"))
    found = components(links.filter("u <> v").select("u", "v")).withColumnRenamed("node", "cid")
    whole = classes.join(number, "cid", "left").join(found, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    roots = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    links_of = (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links")
    # A table of its own: the last join then has plain exchanges, and a vector of very many rows can be split.
    told = checkpointed(whole.join(roots, "component").select("embedding", links_of, "component_id"))
    out = rows.join(told, "embedding", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op2_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE fine AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS node, vec_id AS found FROM fine
  UNION SELECT node, v FROM reach JOIN links ON found = u),
roots AS (SELECT node, min(found) AS component_id FROM reach GROUP BY node),
numbers AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN roots ON node = vec_id LEFT JOIN numbers ON u = vec_id
"""
