"""SimHash fingerprints and their near duplicates by the generalised pigeonhole principle.

Bits are grouped into parts so that correlated bits share a part. If part i has the
threshold t_i and the sum of (t_i + 1) exceeds the radius, two fingerprints within
the radius agree up to t_i bits in at least one part. Thresholds differ by part: a
dynamic programme picks those with the least estimated work, from the number of
equal pairs in each part (counted over all fingerprints) and the spread of each
bit. A threshold of -1 leaves a part out. Probes are the part's value and its
variants up to t_i flipped bits; buckets of equal values are compared in blocks,
and the full fingerprints decide. Buckets of any size are dealt out as bounded
chunk pairs, and each block reports a star per connected group, not its pairs.

Only distinct fingerprints are compared: exact copies meet by key.

Null and empty texts have fingerprint zero and are linked like any other; repeated
rows each get a row; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

import math
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from rungwise.llm.blocks import chunk_pairs, crossing, groups, leaders, together
from rungwise.llm.common import read_table, slices, text_bytes
from rungwise.llm.components import components
from rungwise.session import checkpointed

SHINGLE, RADIUS, SEED, BITS = 4, 4, 42, 64
MOST_PARTS = 12
MOST_PROBES = 4_096  # variants of one part's value; thresholds that need more are not considered
STEP = 1 << 16  # shingles whose bits are counted at once


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of all shingles of ``size`` words, repeats included; one of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    line, ends = b" ".join(words), [end - 1 for end in accumulate(len(w) + 1 for w in words)]
    size = min(size, len(words))
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[s:e], SEED) for s, e in zip(starts, ends[size - 1 :])], dtype=np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit i is one if it is one in over half of the hashes; signed."""
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), STEP):
        ones += np.unpackbits(hashes[start : start + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (64 bits as a long) of every row."""

    def run(batches):
        for batch in slices(batches):
            values = [fingerprint_of(shingle_hashes(text, size)) for text in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and how often bits i and j are both one; one small matrix per task is summed by Spark."""

    def run(batches):
        total = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            bits = bit_matrix(batch.column(0).to_numpy()).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "n"])

    both = np.zeros((BITS, BITS))
    for row in fps.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[row["i"], row["j"]] = row["n"]
    return fps.count(), both


def correlated_parts(n: int, both: np.ndarray, count: int) -> list[list[int]]:
    """``count`` parts of almost equal size; each takes the bits that go most together with those it has."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tie = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    free, parts = set(range(BITS)), []
    for size in [BITS // count + (k < BITS % count) for k in range(count)]:
        part = [max(sorted(free), key=lambda b: tie[b, sorted(free)].max())]
        free.discard(part[0])
        while len(part) < size:
            part.append(max(sorted(free), key=lambda b: tie[b, part].sum()))
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def within(chances: list[float], most: int) -> list[float]:
    """Chance that at most t of the bits differ, for t up to ``most``, bits taken as independent."""
    exact = [1.0] + [0.0] * most
    for p in chances:
        exact = [exact[t] * (1 - p) + (exact[t - 1] * p if t else 0) for t in range(most + 1)]
    return list(accumulate(exact))


def allocate(work: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """Thresholds from -1 to ``radius`` with the least work; their sum is radius - parts + 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # by the sum of (t + 1) so far
    for costs in work:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, radius - spent + 1):
                option = (cost + (costs[t] if t >= 0 else 0.0), [*chosen, t])
                if spent + t + 1 not in after or option < after[spent + t + 1]:
                    after[spent + t + 1] = option
        best = after
    return best[radius + 1]


def value_of(bits: list[int]):
    """The bits of a part gathered into one long, as a column."""
    column = F.lit(0).cast("long")
    for place, bit in enumerate(bits):
        column = column.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", bit).bitwiseAND(F.lit(1)), place))
    return column


def choose_parts(fps: DataFrame, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Parts with their thresholds: the number of parts and the allocation with the least estimated work."""
    n, both = bit_moments(fps)
    share = np.diag(both) / max(n, 1)
    options = {count: correlated_parts(n, both, count) for count in range(2, max(2, min(MOST_PARTS, radius + 1)) + 1)}
    labels = {(count, k): value_of(part) for count, parts in options.items() for k, part in enumerate(parts)}
    named = F.explode(F.array(*(F.struct(F.lit(c * 100 + k).alias("which"), v.alias("value")) for (c, k), v in labels.items())))
    equal = (
        fps.select(named.alias("part")).groupBy("part.which", "part.value").agg(F.count("*").alias("n"))
        .groupBy("which").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect()
    )
    pairs = {row["which"]: row["pairs"] for row in equal}
    best = None
    for count, parts in options.items():
        work = []
        for k, part in enumerate(parts):
            chance = within([2 * share[b] * (1 - share[b]) for b in part], radius)
            equal_pairs = pairs.get(count * 100 + k, n * n / 2 * chance[0])
            probes = list(accumulate(comb(len(part), t) for t in range(radius + 1)))
            # A probe is a shuffled row, a candidate one comparison inside a block: about 300 to 1.
            work.append([
                300.0 * n * probes[t] + equal_pairs * chance[t] / max(chance[0], 1e-30) if probes[t] <= MOST_PROBES else math.inf
                for t in range(radius + 1)
            ])
        option = (*allocate(work, radius), parts)
        best = option if best is None or option[0] < best[0] else best
    return [(part, t) for part, t in zip(best[2], best[1]) if t >= 0]


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Stars ``u, v`` that connect distinct fingerprints as all links of ``radius`` or fewer bits do."""
    rows = []
    for number, (part, most) in enumerate(choose_parts(fps, radius)):
        flips = [sum(1 << bit for bit in some) for t in range(most + 1) for some in combinations(range(len(part)), t)]
        probe = F.explode(F.array(*(F.lit(flip).cast("long") for flip in flips))).alias("flip")
        probed = fps.select("fp", value_of(part).alias("value"), probe)
        rows.append(probed.select(
            F.xxhash64(F.lit(number), F.col("value").bitwiseXOR(F.col("flip"))).alias("bucket"), "fp", (F.col("flip") == 0).alias("home")
        ))
    probes = rows[0]
    for more in rows[1:]:
        probes = probes.unionByName(more)
    dealt = together(chunk_pairs(probes, "bucket", F.col("fp")), "bucket").select("bucket", "lo", "hi", "chunk", "fp", "home")

    def run(batches):
        for table in groups(batches, 3):
            fp = table["fp"].to_numpy().view(np.uint64)
            if len(fp) < 2:
                continue
            linked = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
            across = crossing(table["chunk"].to_numpy(), table["lo"][0].as_py(), table["hi"][0].as_py())
            linked &= True if across is None else across
            first = leaders(linked)
            u = np.flatnonzero((first != np.arange(len(fp))) & (fp != fp[first]))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(fp[u].view(np.int64)), pa.array(fp[first[u]].view(np.int64))], names=["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def simhash_groups(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row."""
    marked = checkpointed(fingerprints(docs, size))
    distinct = checkpointed(marked.select("fp").distinct())
    found = components(near_links(distinct, radius))
    by_fp = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    by_fp = by_fp.select("fp", F.coalesce("component", "fp").alias("component"))
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(by_fp, "fp")
    roots = first.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # A table of its own: the last join then has plain exchanges, and a fingerprint of very many rows can be split.
    told = checkpointed(first.join(roots, "component").select("fp", "component_id"))
    return marked.join(told, "fp").select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` (as read from files) with one row of each group: the least id, null last."""
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    found = simhash_groups(numbered.select(F.col("_row").alias("doc_id"), "text"), size, radius)
    ids = numbered.select("_row", F.col("doc_id").alias("_id")).join(found.withColumnRenamed("doc_id", "_row"), "_row")
    order = F.struct(F.col("_id").isNull(), "_id", "_row")
    first = ids.groupBy("component_id").agg(F.min_by("_row", order).alias("_row")).select("_row")
    return numbered.join(first, "_row", "left_semi").select(*docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
