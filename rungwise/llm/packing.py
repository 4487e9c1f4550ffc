"""Packing documents into sequences of a fixed window by minimum bin slack.

A document's ids (with an end id) are cut into whole windows and one remainder.
Remainders are packed by length alone: their lengths are at most the window, so
the table of counts by length is bounded by it, whatever the number of documents.
For each sequence the longest remainder left is taken, and a subset-sum over a
bitset (bit s: the sum s can be reached, one shift per group of equal lengths)
finds the multiset of other remainders that leaves the least slack; the counts are
found by walking the bitsets back. The pattern is repeated as often as the counts
allow. What the plan says of lengths is then given to pieces by their rank among
the pieces of equal length, numbered task by task, so no task sees a whole length.

Null and empty texts are a document of one id, the end id. Repeated documents are
packed once each. Columns other than ``doc_id`` and ``text`` are not read. An
empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rungwise.llm.common import BATCH_ROWS, Memo, read_table, slices, text_bytes
from rungwise.session import checkpointed

WINDOW, END_ID = 4096, 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
BETWEEN, TOGETHER = "\x01", 200  # pieces that the library encodes at once
WORD_END = "</w>"  # how the vocabulary's entries end that can only be the last of a word
WORD = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+").fullmatch  # letters that the library neither cuts nor composes: one word
SPECIAL = "<|"  # how the vocabulary's special strings begin; none holds a blank
RANK_BITS = 48  # a rank below 2^48 and a length below 2^15 share one sorted key


@lru_cache(maxsize=2)
def library_memo(path: str) -> Memo:
    """Ids of blank-free pieces from the tokenizers library, remembered in one Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def ids_of(text: str) -> np.ndarray:
        """As encode(), but without the offsets of tokens in the text."""
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    between = ids_of(BETWEEN)
    assert len(between) == 1, "the separator must be one id of the vocabulary"
    vocabulary = tokenizer.get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # whether an id ends a word
    last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def compute(pieces: list[str]) -> list[bytes]:
        """Pieces as one text: the library is slow on many short texts. Where a word ends its last id tells; others get a control character between them."""
        out, marked = {}, [p for p in pieces if not WORD(p) and BETWEEN not in p]
        words = [p for p in pieces if WORD(p)]
        for start in range(0, len(words), TOGETHER):
            some = words[start : start + TOGETHER]
            ids = ids_of(" ".join(some))
            ends, data = (4 * (np.flatnonzero(last[ids]) + 1)).tolist(), ids.tobytes()
            if len(ends) != len(some) or ends[-1] != len(data):
                marked += some
                continue
            out.update((piece, data[at:end]) for piece, (at, end) in zip(some, pairwise([0, *ends])))
        for start in range(0, len(marked), TOGETHER):
            some = marked[start : start + TOGETHER]
            ids = ids_of(f" {BETWEEN} ".join(some))
            ends, data, at = [*(4 * np.flatnonzero(ids == between[0])).tolist(), 4 * len(ids)], ids.tobytes(), 0
            for piece, end in zip(some, ends):
                out[piece], at = data[at:end], end + 4
        for piece in set(pieces) - out.keys():
            out[piece] = ids_of(piece).tobytes()
        return [out[piece] for piece in pieces]

    return Memo(compute, 3 << 18)


def different_pieces(texts: list[bytes]) -> tuple[list[str], pa.Array, np.ndarray]:
    """The different pieces between blanks and line ends, which of them stands at each place, and where texts end, from 0.

    Each text ends with a separator here, and each piece holds the one after it, so all pieces lie end to end and
    Arrow can find the different ones. A full stop or comma between a letter or digit and the separator is a piece of
    its own, as the library has it. Plain pieces come in lower case, as the vocabulary has them: the library looks
    for special strings before it lower-cases, and composes characters before that too. So only ASCII pieces
    that cannot hold a special string are lower-cased here.
    """
    data = b"".join(text + b" " for text in texts)
    symbols = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero((symbols == 32) | (symbols == 10)) + 1
    stop = ends[ends > 3] - 2  # where a stop would be; nothing is cut in the first bytes
    stop = stop[(symbols[stop] == 46) | (symbols[stop] == 44)]
    before, lead = symbols[stop - 1], symbols[stop - 2]
    # A to Z, a to z, 0 to 9, and U+00C0 to U+00FF in UTF-8 but for the signs of multiplication and division.
    latin = (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    letter = (before - 48 < 10) | ((before & 0xDF) - 65 < 26) | latin
    cuts = np.sort(np.r_[0, ends, stop[letter]], kind="stable")
    piece_array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    places = piece_array.dictionary_encode()
    pieces = [piece.rstrip(b" \n").decode() for piece in places.dictionary.to_pylist()]
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    bounds = np.r_[0, np.searchsorted(cuts, text_ends)]
    return [p.lower() if p.isascii() and SPECIAL not in p else p for p in pieces], places.indices, bounds


def pieces_of(text: str) -> list[str]:
    """One text's pieces in order."""
    pieces, places, _ = different_pieces([text.encode()])
    return [pieces[i] for i in places.to_pylist()]


def text_ids(texts: list[bytes], memo: Memo) -> list[bytes]:
    """Each text's ids, four bytes each: a piece's are looked up once, Arrow puts them at all its places."""
    pieces, places, bounds = different_pieces(texts)
    _, offsets, data = pa.array(memo.values(pieces), pa.large_binary()).take(places).buffers()
    at, ids = np.frombuffer(offsets, dtype=np.int64)[bounds].tolist(), memoryview(data)
    return [ids[start:end].tobytes() for start, end in pairwise(at)]


def piece_rows(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: whole windows and the remainder, numbered by length within the task.

    The vocabulary drops white space and joins nothing across it, so a text's ids are
    those of its pieces between blanks and line ends, in order (see ``different_pieces``).
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        memo, part, seen = library_memo(path), TaskContext.get().partitionId(), Counter()
        for batch in slices(batches, BATCH_ROWS):
            out = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), text_ids(text_bytes(batch.column(1)), memo)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    out.append((doc_id, start, length, crc, total, part, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 5 + [pa.int32(), pa.int64()])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def fill(counts: Counter, capacity: int) -> Counter:
    """The multiset of lengths whose sum comes closest to ``capacity`` from below."""
    reached, steps = 1, []
    mask = (1 << capacity + 1) - 1
    for length in sorted(counts, reverse=True):
        left, group = min(counts[length], capacity // length), 1
        while left > 0:
            group = min(group, left)
            after = (reached | reached << length * group) & mask
            if after != reached:
                steps.append((length, group, reached))
                reached = after
            left, group = left - group, group * 2
        if reached >> capacity & 1:
            break
    total, chosen = reached.bit_length() - 1, Counter()
    for length, group, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += group
            total -= length * group
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, pieces per sequence, first sequence, offset) that place every rank."""
    left, rank, rows, sequence = Counter({n: c for n, c in counts.items() if c}), Counter(), [], 0
    while left:
        longest = max(left)
        rest = left.copy()
        rest[longest] -= 1
        pattern = fill(+rest, window - longest) + Counter({longest: 1})
        repeats = min(left[length] // n for length, n in pattern.items())
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            rows.append((length, rank[length], n, sequence, offset))
            offset += length * n
            rank[length] += n * repeats
            left[length] -= n * repeats
        left, sequence = +left, sequence + repeats
    return rows


def place(pieces: DataFrame, rows: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Sequence and offset of pieces that carry ``length`` and ``rank``; the plan is bounded by the window."""
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    keys = (table[:, 0] << RANK_BITS) + table[:, 1]

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (2, 5))
            row = table[np.searchsorted(keys, (length << RANK_BITS) + rank, side="right") - 1]
            nth, within = np.divmod(rank - row[:, 1], np.maximum(row[:, 2], 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(row[:, 3] + nth), pa.array(row[:, 4] + within * length)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(run, PACKED)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Every id of every document in exactly one place of one sequence."""
    pieces = checkpointed(piece_rows(docs, path, window, end_id))
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = pieces.join(bases.select("part", "length", "base"), ["part", "length"])
    return place(ranked.withColumn("rank", F.col("base") + F.col("nth")), plan(counts, window))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
