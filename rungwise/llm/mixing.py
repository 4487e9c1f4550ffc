"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words. Each source gets a target: its share of all words by weight, at most
``repeats`` times its own size, the excess reshared by weight. A target is cut into equal
blocks of about ``block`` words of the source's documents, in shuffled order, repeated as
often as the target asks. The schedule has 2^m slots; slot n stands at the n-th van der
Corput point, and the cumulative targets, cut at multiples of 2^-m, say whose it is. Points
are bit reversals, so a source's points are a run of integers, and the rank of a slot among
its source's slots is a sum over the bits of n: no sort, no window. The rank-th slot of a
source takes its rank-th block. A source that no point hits gets one slot after the others.

Documents are shuffled by a hash of their id; running sums over (source, hash) come from a
range sort and one offset per partition, so a source may hold any share of the rows. A long
document spans several blocks. Targets are met to the word; every prefix of the schedule has
each source's share but for a number of blocks that grows with the logarithm of its length.

Null text, and text without a word, has size 0 and is never taken. Null is a source of its own,
the last. Documents that are alike in id, source and size are alike in the result but
for their place, also if null; repeated rows are documents of their own. Other columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rungwise.checks.inputs import hash_sql
from rungwise.functions.hashing import row_hash
from rungwise.llm.common import read_table
from rungwise.operators.ranking import global_rank
from rungwise.session import checkpointed

BLOCK, REPEATS, WEIGHTS, SEED = 4096, 3, (1, 2, 3), 12
SPAN = 1 << 12  # slots made from one row at once
ORDER = ["place", "h", "doc_id", "size"]


def words(text: str = "text") -> Column:
    """Number of runs of other characters than ASCII white space."""
    single = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(single, r"[\x20\x09-\x0D]+", "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, place, source_size, target) from (source, size).

    Weights go round the sources in the order of code points, null last. The level is the
    target of one unit of weight among the sources that are not full; it rises until
    no further source fills up.
    """
    totals = checkpointed(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    placed = global_rank(totals, [F.col("source").asc_nulls_last()], "place")
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int"))
    rows = checkpointed(placed.select("source", "place", "source_size", weight.alias("weight")))
    total, level = rows.agg(F.sum("source_size")).first()[0] or 0, 0.0
    limit = F.col("source_size") * F.lit(repeats)
    while True:
        full = F.col("weight") * F.lit(level) > limit
        taken, left = rows.agg(
            F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if not left or (total - taken) / left == level:
            break
        level = (total - taken) / left
    target = F.least(F.col("weight") * F.lit(level), limit.cast("double"))
    return rows.select("source", "place", "source_size", target.alias("target"))


def running_sums(rows: DataFrame, order: list[str], value: str, output: str) -> DataFrame:
    """Adds ``row``, a number of its own for each row, and the sum of ``value`` over all rows before it in the given order.

    Rows are sorted in ranges and written, so that both passes see the same ranges;
    a range is summed up row by row in its task, and the driver sees one number per range.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = checkpointed(sorted_rows.withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftright("row", 33).alias("part")  # where that function keeps the number of the partition
    sums = sorted(kept.groupBy(part).agg(F.sum(value)).collect())
    starts = dict(zip([p for p, _ in sums], accumulate([0, *(s for _, s in sums)])))
    at, schema = kept.columns.index(value), StructType([*kept.schema.fields, StructField(output, LongType())])

    def run(batches):
        before = None
        for batch in batches:
            if batch.num_rows:
                if before is None:
                    before = starts[batch.column("row")[0].as_py() >> 33]
                values = batch.column(at).to_numpy()
                ends = before + np.cumsum(values)
                before = int(ends[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - values)], names=[*batch.schema.names, output])

    return kept.mapInArrow(run, schema)


def shared_slots(targets: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Targets with ``goal`` (whole words), each source's points [lo, hi) and its number of ``slots``; also the bits of a slot."""
    goals = targets.withColumn("goal", F.round("target").cast("long"))
    total = goals.agg(F.sum("goal")).first()[0] or 0
    bits = max(1, (-(-total // block) - 1).bit_length())

    def first_point(words_before: Column) -> Column:
        return F.ceil(words_before.cast("double") * F.lit(2.0**bits / max(total, 1))).cast("long")

    summed = running_sums(goals, ["place"], "goal", "_before")
    points = summed.withColumn("lo", first_point(F.col("_before"))).withColumn("hi", first_point(F.col("_before") + F.col("goal")))
    own = F.greatest(F.least(F.greatest(F.col("hi") - F.col("lo"), F.lit(1)), F.col("goal")), F.lit(1))
    return checkpointed(points.withColumn("slots", own).drop("_before", "row")), bits


def reversed_bits(number: Column, bits: int) -> Column:
    """Van der Corput's point of a slot, as a multiple of 2^-bits, and back."""
    parts = [F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1)), bits - 1 - i) for i in range(bits)]
    return reduce(Column.bitwiseOR, parts)


def earlier_points(slot: Column, point: Column, below: Column, bits: int) -> Column:
    """How many slots before ``slot``, which has ``point``, have a point under ``below``.

    Slots before n fall into one run for each bit set in n: the bits above as in n, this bit 0,
    the lower ones free. Reversed, the run's points are c, c + s, c + 2s, ... with s = 2^(bits - lower),
    and c is what the point has below that bit.
    """
    counts = []
    for lower in range(bits):
        start, step = point.bitwiseAND(F.lit((1 << bits - 1 - lower) - 1)), 1 << bits - lower
        under = F.shiftright(below - start + F.lit(step - 1), bits - lower)
        inside = F.greatest(F.lit(0), F.least(F.lit(1 << lower), under))
        counts.append(F.when(F.shiftright(slot, lower).bitwiseAND(F.lit(1)) == 1, inside).otherwise(0))
    return reduce(Column.__add__, counts)


def schedule(shares: DataFrame, bits: int) -> DataFrame:
    """(slot, place, rank) of every slot; ``shares`` comes from ``shared_slots``.

    A source's points are made in spans, dealt out before they become slots, so that a source with
    very many slots is no single row's work.
    """
    spans = shares.filter("hi > lo and goal > 0").select(
        "place", "lo", "hi", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1, F.lit(SPAN))).alias("_from")
    )
    last = F.least(F.col("_from") + F.lit(SPAN), F.col("hi")) - 1
    points = spans.repartition("place", "_from").select("place", "lo", "hi", F.explode(F.sequence("_from", last)).alias("_point"))
    slots = points.withColumn("slot", reversed_bits(F.col("_point"), bits))
    upper, lower = (earlier_points(F.col("slot"), F.col("_point"), F.col(end), bits) for end in ("hi", "lo"))
    missed = shares.filter("hi = lo and goal > 0").select(
        (F.lit(1 << bits) + F.col("place")).alias("slot"), "place", F.lit(0).cast("long").alias("rank")
    )
    return slots.select("slot", "place", (upper - lower).alias("rank")).unionByName(missed)


def block_start(rank: Column) -> Column:
    """First word of a block in its source's repeated stream: the first ``goal mod slots`` blocks have one word more."""
    return rank * F.expr("goal div slots") + F.least(rank, F.expr("goal % slots"))


def block_of(word: str) -> Column:
    """The block that holds a word of the stream."""
    longer = "(goal % slots) * (goal div slots + 1)"
    return F.expr(
        f"CASE WHEN {word} < {longer} THEN {word} div (goal div slots + 1) "
        f"ELSE goal % slots + ({word} - {longer}) div (goal div slots) END"
    )


def pieces(placed: DataFrame) -> DataFrame:
    """Every document cut where its source's blocks end, once for each time the stream passes it before the goal.

    (all columns, ``rank`` of the block, ``first`` word in the document, ``words``); a document that the
    stream does not reach, or that has no words, keeps one row without rank.
    """
    times = F.expr("CASE WHEN size > 0 AND start < goal THEN sequence(0L, (goal - 1 - start) div source_size) END")
    passes = placed.withColumn("_pass", F.explode_outer(times))
    passes = passes.withColumn("_from", F.col("_pass") * F.col("source_size") + F.col("start"))
    passes = passes.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("goal")))
    cut = passes.withColumn("rank", F.explode_outer(F.sequence(block_of("_from"), block_of("(_to - 1)"))))
    begin = F.greatest(F.col("_from"), block_start(F.col("rank")))
    end = F.least(F.col("_to"), block_start(F.col("rank") + 1))
    return cut.withColumn("first", begin - F.col("_from")).withColumn("words", end - begin).drop("_pass", "_from", "_to")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK, seed: int = SEED
) -> DataFrame:
    """The mixture: which words of which document stand in which slot.

    (row, doc_id, size, source, source_size, target, slot, first, words), one row per piece, ``row`` telling
    apart equal documents; a document that the mixture does not take has one row with null slot.
    Sorted by slot, the rows that have one are the training order.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words().alias("size"))
    sizes = checkpointed(own)
    shares, bits = shared_slots(source_targets(sizes, weights, repeats), block)
    named = shares.withColumnRenamed("source", "_source")
    known = sizes.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    summed = running_sums(known.withColumn("h", row_hash("doc_id", seed)), ORDER, "size", "_before")
    of_source = running_sums(shares.select("place", "source_size"), ["place"], "source_size", "_base").select("place", "_base")
    placed = summed.join(of_source, "place").withColumn("start", F.col("_before") - F.col("_base"))
    cut = pieces(placed.select("row", "doc_id", "size", "source", "place", "source_size", "target", "goal", "slots", "start"))
    slotted = cut.join(schedule(shares, bits), ["place", "rank"], "left")
    return slotted.select("row", "doc_id", "size", "source", "source_size", "target", "slot", "first", "words")


def words_taken(mixture: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document, from ``mix``."""
    taken = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0)).alias("taken")
    return mixture.groupBy("row", "doc_id", "size", "source_size", "target").agg(taken).drop("row")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_taken(mix(read_table(spark, sf_dir, "documents")))


OP12_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighted AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS most, sum(source_size) OVER () AS total FROM totals
), filling AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
    sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unfilled FROM weighted
), levels AS (
  SELECT most, weight, place, (total - filled)::DOUBLE / unfilled::DOUBLE AS level FROM filling
), targets AS (
  SELECT source, source_size, least(weight * coalesce((
    SELECT level FROM levels WHERE weight * level <= most ORDER BY most / weight, place LIMIT 1
  ), 'infinity'::DOUBLE), most::DOUBLE) AS target FROM weighted
), placed AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS goal, coalesce(sum(size) OVER (
    PARTITION BY s.source ORDER BY {hash_sql("doc_id", SEED)}, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
  ), 0)::BIGINT AS start FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  goal // source_size * size + greatest(0, least(size, goal % source_size - start)) END::BIGINT AS taken FROM placed
"""
