"""Dense networks trained by back-propagation.

A training table is put into batches once and written in blocks of batches. Steps follow one another,
so small batches gain nothing from many tasks: a block is one job, whose task streams its
batches in the epoch's order and takes a step after each; the next block starts from the weights it
returns. Of batches of more than ``STREAMED`` rows each is a job, its gradient summed over all tasks.
The driver starts a job per block or per large batch, and holds the model only; a lost task repeats its block from the weights the block began with.

A barrier stage whose tasks exchange gradients was tried: a round of ``allGather`` takes 0.7 to 1.0 s in
PySpark 4.1, whatever is sent, as its wait sleeps for a second; a job takes a fifth of that.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from rungwise.functions.hashing import hash_constant, mixed, row_hash
from rungwise.operators.ranking import hash_rank
from rungwise.session import remove_scratch, scratch_path

STREAMED = 4_096  # most rows of a batch that one task takes alone
BLOCK_ROWS, MOST_BLOCKS = 1 << 16, 256  # rows of a block of small batches; more of them where blocks would become too many
WEIGHTS, MEAN, SQUARE, SEEN = range(4)  # kinds of rows of a state
STATE = "kind int, position int, value double"
HISTORY = "epoch int, loss double, accuracy double, val_loss double, val_accuracy double"


class Adam:
    """Adam with the gradient clipped by value first."""

    def __init__(self, rate: float, clip: float | None, decay: tuple[float, float] = (0.9, 0.999)):
        self.rate, self.clip, self.decay, self.step = rate, clip, decay, 0
        self.mean = self.square = 0.0

    def update(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        if self.clip:
            gradient = np.clip(gradient, -self.clip, self.clip)
        first, second = self.decay
        self.step += 1
        self.mean = first * self.mean + (1 - first) * gradient
        self.square = second * self.square + (1 - second) * gradient**2
        mean = self.mean / (1 - first**self.step)
        square = self.square / (1 - second**self.step)
        return weights - self.rate * mean / (np.sqrt(square) + 1e-7)


def layer_views(flat: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """The matrices of a flat weight vector: outputs x (inputs + 1), the last column the bias."""
    views, at = [], 0
    for before, after in zip(sizes, sizes[1:]):
        views.append(flat[at : at + after * (before + 1)].reshape(after, before + 1))
        at += after * (before + 1)
    return views


def weight_count(sizes: tuple[int, ...]) -> int:
    return sum(after * (before + 1) for before, after in zip(sizes, sizes[1:]))


def initial_weights(sizes: tuple[int, ...], seed: int) -> np.ndarray:
    """Zeros for a single layer; otherwise normal, scaled by the inputs of a hidden layer (He) and by both ends of the last (Glorot)."""
    flat = np.zeros(weight_count(sizes))
    if len(sizes) > 2:
        rng, views = np.random.default_rng(seed), layer_views(flat, sizes)
        for k, view in enumerate(views):
            after, before = view.shape[0], view.shape[1] - 1
            scale = np.sqrt(2.0 / (before + after if k == len(views) - 1 else before))
            view[:, :-1] = rng.normal(0.0, scale, (after, before))
    return flat


def forward(views: list[np.ndarray], x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(inputs of every layer, logarithms of the class probabilities); hidden layers are rectified."""
    inputs = [x]
    for view in views[:-1]:
        inputs.append(np.maximum(inputs[-1] @ view[:, :-1].T + view[:, -1], 0.0))
    scores = inputs[-1] @ views[-1][:, :-1].T + views[-1][:, -1]
    scores -= scores.max(axis=1, keepdims=True)
    return inputs, scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def batch_sums(flat: np.ndarray, sizes: tuple[int, ...], x: np.ndarray, y: np.ndarray, smoothing: float, slopes: bool = True) -> np.ndarray:
    """Summed gradient of the smoothed cross-entropy by weight, then loss, hits and rows; zeros for slopes not wanted."""
    views, out = layer_views(flat, sizes), np.zeros(len(flat) + 3)
    inputs, logs = forward(views, x)
    target = np.full(logs.shape, smoothing / sizes[-1])
    target[np.arange(len(y)), y] += 1.0 - smoothing
    out[-3:] = -(target * logs).sum(), (logs.argmax(axis=1) == y).sum(), len(y)
    if slopes:
        delta, grown = np.exp(logs) - target, layer_views(out[:-3], sizes)
        for k in reversed(range(len(views))):
            grown[k][:, :-1], grown[k][:, -1] = delta.T @ inputs[k], delta.sum(axis=0)
            if k:
                delta = delta @ views[k][:, :-1] * (inputs[k] > 0)
    return out


def examples(batch: pa.RecordBatch, array: int, label: int) -> tuple[np.ndarray, np.ndarray]:
    """A batch's arrays as a matrix and its labels."""
    x = batch.column(array).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return x.astype(np.float64), batch.column(label).to_numpy(zero_copy_only=False).astype(np.int64)


def fitting(df: DataFrame, array: str, label: str, sizes: tuple[int, ...]) -> DataFrame:
    """Rows with an array of the right length and a label among the classes."""
    return df.filter((F.size(array) == sizes[0]) & F.col(label).between(0, sizes[-1] - 1))


class Batches(NamedTuple):
    """A written training table: rows with ``batch_id`` and ``block``; the number of batches, and of those in a block."""

    rows: DataFrame
    batches: int
    per_block: int
    streamed: bool
    path: str

    def order(self, seed: int) -> list[int]:
        """Blocks in an epoch's order."""
        blocks = -(-self.batches // self.per_block)
        return sorted(range(blocks), key=lambda block: (mixed(block ^ hash_constant(seed, 1)), block))

    def inside(self, block: int, seed: int) -> list[int]:
        """A block's batches in an epoch's order, as ``row_hash`` has it."""
        own = range(block * self.per_block, min(self.batches, (block + 1) * self.per_block))
        return sorted(own, key=lambda batch: (mixed(batch ^ hash_constant(seed, 0)), batch))


def store_batches(df: DataFrame, key: str, array: str, label: str, batch_size: int, seed: int) -> Batches:
    """Rows in a seeded order, cut into batches and blocks, a folder per block."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "batches")
    batches = -(-df.count() // batch_size)
    streamed = batch_size <= STREAMED
    per_block = max(1, BLOCK_ROWS // batch_size if streamed else 1, -(-batches // MOST_BLOCKS))
    ranked = hash_rank(df.select(F.col(key).alias("_key"), F.col(array).alias("_x"), F.col(label).alias("_y")), "_key", seed, "_position", ordered=True)
    batch = F.call_function("div", F.col("_position") - 1, F.lit(batch_size).cast("long"))
    block = F.call_function("div", batch, F.lit(per_block)).cast("int")
    rows = ranked.select("_x", "_y", (F.col("_position") - 1).alias("place"), batch.alias("batch_id"), block.alias("block"))
    rows.sortWithinPartitions("block").write.partitionBy("block").parquet(path)
    added = [StructField("place", LongType()), StructField("batch_id", LongType()), StructField("block", IntegerType())]
    schema = StructType([*rows.select("_x", "_y").schema.fields, *added])
    return Batches(spark.read.schema(schema).parquet(path), batches, per_block, streamed, path)


def own_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
    """(turn and batch, arrays, labels) of a task's sorted rows, one batch at a time."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        turn, number = (batch.column(i).to_numpy() for i in (0, 1))
        x, y = examples(batch, 2, 3)
        cuts = np.flatnonzero((np.diff(turn) != 0) | (np.diff(number) != 0)) + 1
        for start, end in pairwise([0, *cuts.tolist(), len(turn)]):
            own = (int(turn[start]), int(number[start]))
            if held and own != key:
                yield key, np.vstack([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held = []
            key = own
            held.append((x[start:end], y[start:end]))
    if held:
        yield key, np.vstack([h[0] for h in held]), np.concatenate([h[1] for h in held])


def gradient_sums(rows: DataFrame, flat: np.ndarray, sizes: tuple[int, ...], smoothing: float) -> np.ndarray:
    """``batch_sums`` of a table: each task adds up its batches, Spark the tasks' sums by position."""

    def partial(batches):
        total = np.zeros(len(flat) + 3)
        for batch in batches:
            if batch.num_rows:
                total += batch_sums(flat, sizes, *examples(batch, 0, 1), smoothing)
        if total[-1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["position", "value"])

    total = np.zeros(len(flat) + 3)
    sums = rows.select("_x", "_y").mapInArrow(partial, "position int, value double")
    for position, value in sums.groupBy("position").agg(F.sum("value")).collect():
        total[position] = value
    return total


def streamed_steps(rows: DataFrame, flat: np.ndarray, optimizer: Adam, sizes: tuple[int, ...], smoothing: float) -> DataFrame:
    """STATE after a step for each batch of sorted rows in one partition."""

    def run(batches):
        weights, adam, seen = flat, optimizer, np.zeros(3)
        for _, x, y in own_batches(batches):
            sums = batch_sums(weights, sizes, x, y, smoothing)
            weights, seen = adam.update(weights, sums[:-3] / sums[-1]), seen + sums[-3:]
        yield from state_rows(weights, adam, seen)

    return rows.select("_turn", "batch_id", "_x", "_y").mapInArrow(run, STATE)


def state_rows(weights: np.ndarray, adam: Adam, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts = [weights, adam.mean + 0.0 * weights, adam.square + 0.0 * weights, np.append(seen, adam.step)]
    kind = np.concatenate([np.full(len(p), k, dtype=np.int32) for k, p in enumerate(parts)])
    position = np.concatenate([np.arange(len(p), dtype=np.int32) for p in parts])
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (kind, position, np.concatenate(parts))], names=["kind", "position", "value"])


def state_of(rows: list, rate: float, clip: float | None) -> tuple[np.ndarray, Adam, np.ndarray]:
    """(weights, optimizer, sums seen) from collected rows of STATE."""
    parts: dict[int, dict[int, float]] = {kind: {} for kind in range(4)}
    for kind, position, value in rows:
        parts[kind][position] = value
    arrays = {kind: np.array([own[i] for i in range(len(own))]) for kind, own in parts.items()}
    optimizer = Adam(rate, clip)
    optimizer.mean, optimizer.square, optimizer.step = arrays[MEAN], arrays[SQUARE], int(arrays[SEEN][3])
    return arrays[WEIGHTS], optimizer, arrays[SEEN][:3]


def train_epoch(
    stored: Batches, seed: int, flat: np.ndarray, optimizer: Adam, sizes: tuple[int, ...], smoothing: float
) -> tuple[np.ndarray, Adam, np.ndarray]:
    """(weights, optimizer, sums seen) after one pass over all batches, in an order of the epoch's own."""
    seen = np.zeros(3)
    for block in stored.order(seed):
        rows = fitting(stored.rows.filter(F.col("block") == block), "_x", "_y", sizes)
        if stored.streamed:
            turned = rows.withColumn("_turn", row_hash("batch_id", seed)).repartition(1)
            ordered = turned.sortWithinPartitions("_turn", "batch_id", "place")
            after = streamed_steps(ordered, flat, optimizer, sizes, smoothing).collect()
            if after:
                flat, optimizer, own = state_of(after, optimizer.rate, optimizer.clip)
                seen = seen + own
            continue
        for batch in stored.inside(block, seed):
            sums = gradient_sums(rows.filter(F.col("batch_id") == batch), flat, sizes, smoothing)
            if sums[-1]:
                flat, seen = optimizer.update(flat, sums[:-3] / sums[-1]), seen + sums[-3:]
    return flat, optimizer, seen


def write_state(spark: SparkSession, path: str, flat: np.ndarray, optimizer: Adam, seen: np.ndarray) -> None:
    batch = next(state_rows(flat, optimizer, seen))
    spark.createDataFrame(pa.Table.from_batches([batch]), schema=STATE).coalesce(1).write.mode("overwrite").parquet(path)


def read_state(spark: SparkSession, path: str, rate: float, clip: float | None) -> tuple[np.ndarray, Adam, np.ndarray] | None:
    """What ``write_state`` wrote; None where there is nothing."""
    try:
        rows = spark.read.schema(STATE).parquet(path).collect()
    except AnalysisException:
        return None
    return state_of(rows, rate, clip) if rows else None


def evaluated(df: DataFrame, array: str, label: str, flat: np.ndarray, sizes: tuple[int, ...], smoothing: float) -> np.ndarray:
    """Loss, hits and rows of a table, summed in the tasks and then by Spark."""

    def partial(batches):
        sums = np.zeros(3)
        for batch in batches:
            if batch.num_rows:
                sums += batch_sums(flat, sizes, *examples(batch, 0, 1), smoothing, slopes=False)[-3:]
        yield pa.RecordBatch.from_arrays([pa.array([s]) for s in sums], names=["loss", "hits", "rows"])

    sums = fitting(df, array, label, sizes).select(array, label).mapInArrow(partial, "loss double, hits double, rows double")
    return np.array([v or 0.0 for v in sums.agg(F.sum("loss"), F.sum("hits"), F.sum("rows")).first()])


def _means(sums: np.ndarray) -> tuple[float | None, float | None]:
    return (float(sums[0] / sums[2]), float(sums[1] / sums[2])) if sums[2] else (None, None)


class Network:
    """A trained network: layer sizes and flat weights."""

    def __init__(self, sizes: tuple[int, ...], flat: np.ndarray):
        self.sizes, self.flat = tuple(sizes), flat

    def score(self, df: DataFrame, array: str, output: str = "probability", prediction: str = "prediction") -> DataFrame:
        """Adds class probabilities and the most likely class, the first of equals; null for an array of another length."""
        flat, sizes, at = self.flat, self.sizes, df.columns.index(array)
        schema = StructType([*df.schema.fields, StructField(output, ArrayType(DoubleType())), StructField(prediction, DoubleType())])

        def run(batches):
            views = layer_views(flat, sizes)
            for batch in batches:
                lists = batch.column(at)
                fits = np.array([v is not None and len(v) == sizes[0] and None not in v for v in lists.to_pylist()], dtype=bool)
                shares, classes = [None] * batch.num_rows, [None] * batch.num_rows
                if fits.any():
                    x = lists.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(-1, sizes[0])
                    logs = forward(views, x.astype(np.float64))[1]
                    for row, share, best in zip(np.flatnonzero(fits), np.exp(logs).tolist(), logs.argmax(axis=1).tolist()):
                        shares[row], classes[row] = share, float(best)
                added = [pa.array(shares, pa.list_(pa.float64())), pa.array(classes, pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, output, prediction])

        return df.mapInArrow(run, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per unit; replaces what ``path`` had."""
        views = layer_views(self.flat, self.sizes)
        rows = [(k, unit, [float(v) for v in row]) for k, view in enumerate(views) for unit, row in enumerate(view)]
        spark.createDataFrame(rows, "layer int, unit int, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Network:
        rows = sorted(spark.read.parquet(path).collect())
        last = max(r["layer"] for r in rows)
        own = [[r["weights"] for r in rows if r["layer"] == k] for k in range(last + 1)]
        return cls((len(own[0][0]) - 1, *map(len, own)), np.concatenate([np.ravel(layer) for layer in own]))


def network_fit(
    train: DataFrame,
    valid: DataFrame,
    key: str,
    array: str,
    label: str,
    inputs: int,
    classes: int,
    hidden: tuple[int, ...] = (512,),
    epochs: int = 3,
    batch_size: int = 64,
    rate: float = 0.005,
    clip: float | None = 0.12,
    smoothing: float = 0.2,
    seed: int = 42,
    initial: np.ndarray | None = None,
    state: str | None = None,
) -> tuple[Network, DataFrame]:
    """Mini-batch training; returns the network of the epoch with the best accuracy on ``valid`` and the history.

    The first of equal epochs counts; without rows to validate, the last. The history is HISTORY,
    training figures as seen while learning. With ``state``, a folder, every epoch's weights and
    optimizer are kept there and a training begun before goes on after its last whole epoch.
    """
    spark, sizes = train.sparkSession, (inputs, *hidden, classes)
    stored = store_batches(train, key, array, label, batch_size, seed)
    flat, optimizer = initial_weights(sizes, seed) if initial is None else initial, Adam(rate, clip)
    history, best = [], (-1.0, flat)
    for epoch in range(1, epochs + 1):
        done = read_state(spark, f"{state}/epoch={epoch}", rate, clip) if state else None
        flat, optimizer, seen = done or train_epoch(stored, seed + epoch, flat, optimizer, sizes, smoothing)
        if state and done is None:
            write_state(spark, f"{state}/epoch={epoch}", flat, optimizer, seen)
        history.append((epoch, *_means(seen), *_means(evaluated(valid, array, label, flat, sizes, smoothing))))
        share = history[-1][-1]
        if share is None or share > best[0]:
            best = (-1.0 if share is None else share, flat)
    remove_scratch(spark, stored.path)
    return Network(sizes, best[1]), spark.createDataFrame(history, HISTORY)
