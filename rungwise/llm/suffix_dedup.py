"""Exact removal of repeated byte strings by column-wise suffix sorting.

A byte goes if it lies in a string of ``window`` bytes that also starts anywhere else.
Two equal strings have their least ``k``-byte hash at the same place, so every
window of a text belongs to one anchor, and equal windows to anchors with equal
``k`` bytes. Anchors (about one in 80 bytes) are counted over all texts; those seen
twice or more send the bytes around them to a task by their hash.

There the strings, aligned at their anchors, are inserted column by column from the
right: each round takes one symbol of every string (the next column of the
collection's Burrows-Wheeler transform), re-sorts the strings by it, keeping the old
order of equals, and updates the common prefix of neighbours: the least of those
between them if the symbols agree, else none. After the round of column c, a window
that starts there is repeated if and only if its common prefix with a neighbour
has ``window`` bytes or more. Rounds are as many as the columns, whatever the length
of the texts: inserting whole texts symbol by symbol would need a pass for every
byte of the longest. Both arrays are read and written in order, once a round.

In a run of a short period every window equals the one a period before. Such windows are marked where they are
found, by their bytes, and only the first of each run is sent on, so runs are no more work than
other text. Rows with one id and text send their strings once, marked as repeated.

An anchor held by more strings than ``limit`` is dealt out in chunks. Each chunk
then reports one row for each different window, by a 128-bit fingerprint; those are
summed with a map-side aggregate, and a window alone in its chunk but not in all
chunks is repeated too.

Null text is empty. A text shorter than the window has nothing removed. Repeated
rows remove each other, as any two equal texts do. Null ids and repeated ids are
kept apart by text. Other columns are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rungwise.llm.common import Memo, bound_batches, read_table, slices, text_bytes
from rungwise.session import remove_scratch, scratch_path

WINDOW, ANCHOR = 200, 40
LIMIT = 1 << 15  # most strings of one anchor that are sorted together
LOT = 1 << 13  # strings after which a lot ends with its anchor
BLOCK = 1 << 11  # strings laid out at once
OUT_BYTES = 1 << 22  # strings sent on at once
SEGMENT = 1 << 18  # bytes hashed together, at some 100 bytes of memory each; positions within take 24 bits
END = 0xFF  # no byte of UTF-8
ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # bases of the polynomial hashes: any odd numbers
KEY = ["_d", "_x"]
ANCHORS = "_d long, _x long, h long, place long, until long"
CONTEXTS = "h long, chunk int, parts int, _d long, _x long, first long, left int, bytes binary, twice boolean"
FOUND = "kind int, _d long, _x long, start long, end long, f1 long, f2 long"


@lru_cache(maxsize=4)
def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    both = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(count, factor, dtype=np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def prefix_sums(data: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the bytes before each place, weighed by powers of ``base``, and the powers of its inverse."""
    up, down = powers(base, 1 << max(16, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def rolling(sums: np.ndarray, down: np.ndarray, size: int) -> np.ndarray:
    """A mixed 64-bit hash of every ``size`` neighbouring bytes."""
    value = (sums[size:] - sums[:-size]) * down[: len(sums) - size]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    return value


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def seen_before(data: np.ndarray, sums: np.ndarray, down: np.ndarray, anchor: np.ndarray, hashes: np.ndarray, begins: np.ndarray, window: int):
    """For each window how far back, inside its text, the equal window before it starts; 0 if none is found.

    Only runs of a short period are looked at: where the anchor moves on by p to an equal hash, the window p
    bytes back may be equal. A hash of the window selects, the bytes decide.
    """
    back = np.zeros(len(anchor), dtype=np.int64)
    moved = np.flatnonzero(np.diff(anchor) != 0) + 1
    same = moved[hashes[anchor[moved]] == hashes[anchor[moved - 1]]]
    if not len(same):
        return back
    ends = np.r_[moved, len(anchor)][np.searchsorted(moved, same) + 1]
    sizes = ends - same
    at = np.repeat(same - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    shift = np.repeat(anchor[same] - anchor[same - 1], sizes)
    fits = at - shift >= begins[at]
    at, shift = at[fits], shift[fits]

    def prints(i):
        return (sums[i + window] - sums[i]) * down[i]

    equal = prints(at) == prints(at - shift)
    at, shift = at[equal], shift[equal]
    cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(shift) != 0)) + 1
    for start, end in pairwise([0, *cuts.tolist(), len(at)] if len(at) else [0]):
        first, last, p = int(at[start]), int(at[end - 1]) + window, int(shift[start])
        if np.array_equal(data[first:last], data[first - p : last - p]):
            back[at[start:end]] = p
    return back


def anchors_of(data: np.ndarray, bounds: np.ndarray, window: int, k: int):
    """Runs of windows with one anchor: (text, first window, anchor - first, further windows, hash) as arrays.

    ``bounds`` are the ends of texts laid end to end, from 0. Of windows that repeat at a short distance only the
    first is kept; all of them come as spans (text, start, end) besides.
    """
    none = np.empty(0, dtype=np.int64)
    if len(data) < window:
        return (none, none, none, none, np.empty(0, dtype=np.uint64)), (none, none, none)
    sums, down = prefix_sums(data, ODD[0])
    hashes = rolling(sums, down, k)
    low = np.uint64((1 << 24) - 1)
    anchor = (sliding_least(hashes & ~low | np.arange(len(hashes), dtype=np.uint64), window - k + 1) & low).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(anchor)]
    inside = np.arange(len(anchor)) + window <= bounds[1:][text]
    back = np.where(inside, seen_before(data, sums, down, anchor, hashes, bounds[text], window), 0)
    again = np.flatnonzero(back)
    spans = (none, none, none)
    if len(again):
        near = np.zeros(len(anchor) + 2, dtype=np.int8)
        near[again + 1] = near[again - back[again] + 1] = 1
        start, end = np.flatnonzero(np.diff(near) == 1), np.flatnonzero(np.diff(near) == -1)
        # Neighbouring windows of two texts are never both inside their texts, so a run lies in one.
        spans = text[start], start - bounds[text[start]], end - 1 + window - bounds[text[start]]
    at = np.flatnonzero(inside & (back == 0))
    if not len(at):
        return (at, at, at, at, np.empty(0, dtype=np.uint64)), spans
    starts = np.r_[True, (np.diff(at) > 1) | (np.diff(anchor[at]) != 0) | (np.diff(text[at]) != 0)]
    first = at[starts]
    more = np.diff(np.r_[np.flatnonzero(starts), len(at)]) - 1
    return (text[first], first - bounds[text[first]], anchor[first] - first, more, hashes[anchor[first]]), spans


def segments(texts: list[bytes], window: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in lots of about SEGMENT bytes; longer ones are cut with an overlap that leaves every window in one piece."""
    rows, shifts, pieces, size = [], [], [], 0
    for row, text in enumerate(texts):
        for shift in range(0, max(1, len(text) - window + 1), SEGMENT):
            piece = text[shift : shift + SEGMENT + window - 1]
            if size + len(piece) > 2 * SEGMENT:
                yield rows, shifts, pieces
                rows, shifts, pieces, size = [], [], [], 0
            rows.append(row)
            shifts.append(shift)
            pieces.append(piece)
            size += len(piece)
    if rows:
        yield rows, shifts, pieces


def keyed(docs: DataFrame) -> DataFrame:
    """All columns, and ``_d, _x`` that tell texts apart even where ids are null or repeated."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select("*", number.alias("_d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_x"))


def anchor_rows(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """``place`` packs the first window, the anchor's distance from it and the number of further windows.

    Rows without hash are spans of windows that repeat nearby, from ``place`` to ``until``.
    """

    names = [*KEY, "h", "place", "until"]

    def run(batches):
        Memo.forget()
        for batch in slices(batches):
            d, x = (batch.column(i).to_numpy() for i in (0, 1))
            for rows, shifts, pieces in segments(text_bytes(batch.column(2)), window):
                bounds = np.cumsum([0, *map(len, pieces)])
                anchors, spans = anchors_of(np.frombuffer(b"".join(pieces), np.uint8), bounds, window, k)
                text, first, left, more, hashes = anchors
                rows, shifts = np.array(rows), np.array(shifts)
                row, first = rows[text], first + shifts[text]
                none = np.full(len(row), None)
                columns = d[row], x[row], hashes.view(np.int64), first << 16 | left << 8 | more, none
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
                if len(spans[0]):
                    row, shift = rows[spans[0]], shifts[spans[0]]
                    columns = d[row], x[row], np.full(len(row), None), spans[1] + shift, spans[2] + shift
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return docs.select(*KEY, "text").mapInArrow(run, ANCHORS)


def context_rows(docs: DataFrame, shared: DataFrame, window: int, limit: int) -> DataFrame:
    """The bytes of all windows of each shared anchor, with the anchor's hash and chunk.

    Rows with one id and text share their key: they have each anchor as often as there are such
    rows. Their strings are sent once, marked ``twice``.
    """
    wanted = shared.groupBy(*KEY).agg(F.collect_set(F.struct("h", "place", "n")).alias("anchors"), F.count("*").alias("_rows"))
    wanted = wanted.select(*KEY, "anchors", (F.col("_rows") > F.size("anchors")).alias("twice"))
    names = [field.strip().split(" ")[0] for field in CONTEXTS.split(",")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    def run(batches):
        before = None
        for batch in slices(batches):
            out, size = [], 0
            lists = batch.column(3)
            ends, flat = lists.offsets.to_pylist(), lists.values
            h, place, n = (flat.field(i).to_pylist() for i in range(3))
            texts, d, x, twice = text_bytes(batch.column(2)), *(batch.column(i).to_pylist() for i in (0, 1, 4))
            for row, text in enumerate(texts):
                # The join puts rows of one key next to one another; where it does not, they only come more often.
                if twice[row] and (d[row], x[row]) == before:
                    continue
                before = d[row], x[row]
                for i in range(ends[row], ends[row + 1]):
                    first, left, more = place[i] >> 16, place[i] >> 8 & 255, place[i] & 255
                    parts = -(-n[i] // limit)
                    chunk = hash((d[row], x[row], first)) % parts
                    own = text[first : first + more + window]
                    out.append((h[i], chunk, parts, d[row], x[row], first, left, own, twice[row]))
                    size += len(own)
                    if size > OUT_BYTES:
                        yield batch_of(out)
                        out, size = [], 0
            if out:
                yield batch_of(out)

    return docs.select(*KEY, "text").join(wanted, KEY).select(*KEY, "text", "anchors", "twice").mapInArrow(run, CONTEXTS)


def lots(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Sorted rows in lots of at least ``rows`` that end where (h, chunk) changes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        h, chunk = table["h"].to_numpy(), table["chunk"].to_numpy()
        changes = np.flatnonzero((h[1:] != h[:-1]) | (chunk[1:] != chunk[:-1]))
        if len(changes):
            cut = int(changes[-1]) + 1
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def aligned(lists: list[bytes], left: np.ndarray, width: int, at: int) -> np.ndarray:
    """Columns of the strings with their anchors in column ``at``; END where a string has no byte. Filled block by block."""
    columns = np.full((width, len(lists)), END, dtype=np.uint8)
    for start in range(0, len(lists), BLOCK):
        some = lists[start : start + BLOCK]
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        row = np.repeat(np.arange(start, start + len(some)), sizes)
        column = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(at - left[start : start + BLOCK], sizes)
        columns[column, row] = np.frombuffer(b"".join(some), dtype=np.uint8)
    return columns


def insert_columns(columns: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per column from the right: (column, order of the strings' suffixes from it, where each first differs from the one before)."""
    width, count = columns.shape
    order = np.arange(count)
    differs = np.full(count + 1, width, dtype=np.int16)
    for column in range(width - 1, -1, -1):
        symbols = columns[column][order]  # the next column of the Burrows-Wheeler transform
        moved = np.argsort(symbols, kind="stable")
        ranked = symbols[moved]
        same = np.flatnonzero((ranked[1:] == ranked[:-1]) & (ranked[1:] != END)) + 1
        after = np.full(count + 1, column, dtype=np.int16)
        if len(same):
            ends = np.empty(2 * len(same), dtype=np.int64)
            ends[::2], ends[1::2] = moved[same - 1] + 1, moved[same] + 1
            after[same] = np.minimum.reduceat(differs, ends)[::2]
        order, differs = order[moved], after
        yield column, order, differs[:count]


def window_prints(columns: np.ndarray, window: int, base: int) -> np.ndarray:
    """A 64-bit fingerprint of each window, by first column and string."""
    up, down = powers(base, 1 << 16)
    width = len(columns)
    sums = np.zeros((width + 1, columns.shape[1]), dtype=np.uint64)
    np.cumsum((columns.astype(np.uint64) + np.uint64(1)) * up[:width, None], axis=0, out=sums[1:])
    value = (sums[window:] - sums[:-window]) * down[: width - window + 1, None]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0x94D049BB133111EB)
    return (value ^ value >> np.uint64(30)).view(np.int64)


def some_prints(columns: np.ndarray, column: np.ndarray, row: np.ndarray, window: int) -> Iterator[list[np.ndarray]]:
    """Both fingerprints of windows by column and string (in order), a block of strings at a time."""
    for start in range(0, columns.shape[1], BLOCK):
        first, last = np.searchsorted(row, [start, start + BLOCK])
        if last > first:
            block, own = columns[:, start : start + BLOCK], (column[first:last], row[first:last] - start)
            yield [window_prints(block, window, base)[own] for base in ODD]


def repeated_windows(table: pa.Table, window: int, k: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows as byte spans (kind 0); of chunked anchors also one row per window (1 repeated, 2 alone)."""
    at = window - k
    width = at + window
    left = table["left"].to_numpy().astype(np.int64)
    lists = table["bytes"].to_pylist()
    columns = aligned(lists, left, width, at)
    firsts, more = at - left, np.fromiter(map(len, lists), np.int64, len(lists)) - window
    chunked, marked = table["parts"].to_numpy() > 1, table["twice"].to_numpy()
    repeated = np.zeros((at + 1, len(lists)), dtype=bool)
    heads = []
    for column, order, differs in insert_columns(columns):
        if column > at:
            continue
        own = (firsts[order] <= column) & (column <= firsts[order] + more[order])
        with_last = differs >= column + window
        with_last[0] = False
        either = with_last.copy()
        either[:-1] |= with_last[1:]
        either |= marked[order]
        repeated[column, order] = either & own
        lead = np.flatnonzero(own & ~with_last & chunked[order])
        if len(lead):
            heads.append((np.full(len(lead), column), order[lead], either[lead]))
    d, x, first = (table[name].to_numpy() for name in (*KEY, "first"))
    by_row = np.zeros((len(lists), at + 3), dtype=np.int8)
    by_row[:, 1 : at + 2] = repeated.T
    edge = np.diff(by_row, axis=1)
    (row, start), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
    base = first[row] - firsts[row]
    yield _found(0, d[row], x[row], base + start, base + end - 1 + window)
    if heads:
        column, row, twice = map(np.concatenate, zip(*heads))
        by_string = np.argsort(row, kind="stable")
        column, row, twice = column[by_string], row[by_string], twice[by_string]
        prints = [np.concatenate(p) for p in zip(*some_prints(columns, column, row, window))]
        start = first[row] - firsts[row] + column
        yield _found(np.where(twice, 1, 2), d[row], x[row], start, start + window, *prints)


def _found(kind, d, x, start, end, f1=None, f2=None) -> pa.RecordBatch:
    none = np.zeros(len(d), dtype=np.int64)
    columns = [np.broadcast_to(np.int32(kind) if np.isscalar(kind) else kind.astype(np.int32), len(d)), d, x, start, end]
    columns += [none if f1 is None else f1, none if f2 is None else f2]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.strip().split(" ")[0] for f in FOUND.split(",")])


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, limit: int = LIMIT) -> DataFrame:
    """Byte spans ``_d, _x, start, end`` of repeated windows; spans may overlap. ``docs`` comes from ``keyed``."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "repeats")
    anchor_rows(docs, window, k).write.parquet(f"{folder}/anchors")
    written = spark.read.parquet(f"{folder}/anchors")
    anchors = written.filter("h IS NOT NULL").drop("until")
    # Written, so that the join below has plain exchanges on both sides: adaptive execution can then split a hot anchor.
    anchors.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > 1).write.parquet(f"{folder}/counts")
    contexts = context_rows(docs, anchors.join(spark.read.parquet(f"{folder}/counts"), "h"), window, limit)
    placed = contexts.repartition("h", "chunk").sortWithinPartitions("h", "chunk")

    def run(batches):
        for table in lots(batches, LOT):
            yield from repeated_windows(table, window, k)

    placed.mapInArrow(run, FOUND).write.parquet(f"{folder}/found")
    nearby = written.filter("h IS NULL").select(*KEY, F.col("place").alias("start"), F.col("until").alias("end"))
    nearby.write.parquet(f"{folder}/nearby")
    for done in ("anchors", "counts"):
        remove_scratch(spark, f"{folder}/{done}")
    found = spark.read.parquet(f"{folder}/found")
    spans = found.filter("kind = 0").select(*KEY, "start", "end").unionByName(spark.read.parquet(f"{folder}/nearby"))
    windows = found.filter("kind > 0")
    if windows.isEmpty():
        return spans
    several = windows.groupBy("f1", "f2").agg(F.count("*").alias("n"), F.max((F.col("kind") == 1)).alias("twice"))
    several = several.filter((F.col("n") > 1) | F.col("twice")).select("f1", "f2")
    return spans.unionByName(windows.filter("kind = 2").join(several, ["f1", "f2"]).select(*KEY, "start", "end"))


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by spans; spans that touch are one run."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts, ends)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> list[bytes]:
    at, out = 0, []
    for start, end in runs:
        out.append(text[at:start])
        at = end
    return [*out, text[at:]]


def with_runs(docs: DataFrame, **options) -> DataFrame:
    """All columns of every row, and ``_starts, _ends`` of the spans found in its text."""
    marked = keyed(docs)
    spans = repeated_spans(marked, **options).groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
    pairs = spans.select(*KEY, F.col("_spans.start").alias("_starts"), F.col("_spans.end").alias("_ends"))
    return marked.join(pairs, KEY, "left").drop(*KEY)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` and ``n_chars`` counted anew.

    A character that lost some of its bytes goes as a whole. Null text stays null.
    """
    names = docs.columns
    place = [names.index(name) for name in ("text", "n_chars")]

    def run(batches):
        for batch in slices(batches):
            texts = []
            for text, starts, ends in zip(*(batch.column(i).to_pylist() for i in (place[0], len(names), len(names) + 1))):
                if text is not None and starts:
                    text = b"".join(kept_bytes(text.encode(), merged(starts, ends))).decode("utf-8", "ignore")
                texts.append(text)
            columns = batch.columns[: len(names)]
            columns[place[0]] = pa.array(texts, columns[place[0]].type)
            columns[place[1]] = pa.array([None if t is None else len(t) for t in texts], columns[place[1]].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return with_runs(docs, **options).select(*names, "_starts", "_ends").mapInArrow(run, docs.schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches):
        for batch in slices(batches):
            out = []
            for text, starts, ends in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                runs, digest = merged(starts or [], ends or []), hashlib.sha256()
                for part in kept_bytes(text, runs):
                    digest.update(part)
                out.append((len(text), sum(e - s for s, e in runs), len(runs), digest.hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*out), kinds))], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    bound_batches(spark)
    found = with_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.mapInArrow(run, schema)
