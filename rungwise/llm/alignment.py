"""Alignment of two tokenizers' tokens over the same bytes, in Arrow.

Texts come in chunks of bounded bytes. A chunk's texts are cut before every space
that follows a character other than white space: no token of either vocabulary
crosses such a place, so both sides end there. The pieces are dictionary encoded, each
different one is encoded once by the libraries, and the ids come back as lists:

* lists of ids by piece are flattened, their parent indices name the piece;
* cumulative sums of the tokens' byte lengths are the tokens' ends, pieces lying end to end;
* an Acero hash join on the end finds the ends that both sides share: they cut groups;
* tokens are counted by (group, id) and joined on the group: the piece's links, with how often each occurs;
* counts, names and links of pieces are taken for every place of the documents, as often as a piece occurs there;
* ``Table.group_by`` adds up links by document and pair, some places at once, then documents by pair for the chunk.

Spark adds up the chunks' partial counts by pair, takes the highest count of every A id and
brings the counts back to the chunks, where each document sums over its own pairs. What is
shuffled are the different pairs of each chunk, never a row per link. The rest of a chunk, its
documents' counts and links, is compressed by Python and goes through Spark as small rows of
bytes that only the last step opens: the JVM never holds a chunk's lists.

Null and empty texts have no tokens; neither have texts that B cannot give back (with U+2581):
counts are 0 and the digest is empty. Repeated rows are documents of their own, in
the result and in the counts; ids may be null or repeated. A text longer than a chunk is a
chunk of its own. Only ``doc_id`` and ``text`` are read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from rungwise.llm.bpe import byte_letters
from rungwise.llm.blocks import groups
from rungwise.llm.common import BATCH_ROWS, Memo, bound_batches, read_table, slices
from rungwise.session import scratch_path

CHUNK_BYTES = 1 << 20  # text of one chunk, unless a single text is longer
MARK = "\x00"  # stands for a space at a cut; texts that hold it are cut by Python
# The white space of Unicode; what the class leaves is followed by a cut if a space comes next.
CUT = r"([^\s\v\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]) "
SPACE = "▁"
TOGETHER = 4_000  # pieces encoded at once
REMEMBERED, LONGEST = 1 << 19, 64  # pieces a worker remembers, and the most characters of one
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
PIECES = 1 << 13  # different pieces whose tokens are joined at once
LINKS = 1 << 17  # links of places counted at once
PART_BYTES = 1 << 13  # of a chunk's body in one row: Spark's readers hold thousands of rows at once
# A chunk's different pairs by number (place), and the parts of its body.
STORED = "chunk long, place int, a int, b int, docs long, body binary"
BODY = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs", "pair", "times")
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Records(NamedTuple):
    """What the libraries give for pieces, end to end: whether both sides give a piece's bytes back, the number of A ids, A ids, B ids."""

    flat: np.ndarray
    ends: np.ndarray

    @classmethod
    def none(cls) -> Records:
        return cls(np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64))

    @classmethod
    def joined(cls, parts: list[Records]) -> Records:
        before = np.cumsum([0, *(len(part.flat) for part in parts)])
        return cls(np.concatenate([p.flat for p in parts]), np.concatenate([p.ends + b for p, b in zip(parts, before)]))

    def take(self, numbers: np.ndarray) -> Records:
        starts = np.r_[0, self.ends][numbers]
        sizes = self.ends[numbers] - starts
        ends = np.cumsum(sizes)
        return Records(self.flat[np.arange(sizes.sum()) + np.repeat(starts - ends + sizes, sizes)], ends)


class PieceMemo(Memo):
    """Records by piece, as ``Memo`` keeps bytes: about ``size`` pieces used last, in two halves; long ones are not kept.

    Pieces are Arrow arrays: dicts of as many strings take several times the memory, in every Python worker.
    """

    def __init__(self, encode: Callable[[list[str]], Records], size: int = REMEMBERED):
        super().__init__(encode, size, LONGEST)
        self.clear()

    def clear(self) -> None:
        self.known = self.older = pa.array([], pa.large_string())
        self.records = self.older_records = Records.none()

    def take(self, pieces: pa.Array | list[str]) -> Records:
        """Records of pieces that are all different, in their order."""
        pieces = pa.array(pieces, pa.large_string()) if isinstance(pieces, list) else pieces
        found = places(pieces, self.known)
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return self.records.take(found)
        new = pieces.take(pa.array(missing))
        of_older = places(new, self.older)
        short = pc.utf8_length(new).to_numpy() <= self.longest
        moved, fresh, long = (np.flatnonzero(m) for m in (of_older >= 0, (of_older < 0) & short, (of_older < 0) & ~short))
        order = np.concatenate([moved, fresh, long])
        base, kept = len(self.records.ends), len(moved) + len(fresh)
        found[missing[order]] = base + np.arange(len(order))
        names = new.take(pa.array(order))
        self.known = pa.concat_arrays([self.known, names[:kept]])
        parts = [self.records, self.older_records.take(of_older[moved]), self.compute(names[len(moved) : kept].to_pylist())]
        self.records = Records.joined(parts)
        out = Records.joined([self.records, self.compute(names[kept:].to_pylist())]).take(found)
        if len(self.known) > self.half:
            self.older, self.older_records = self.known, self.records
            self.known, self.records = pa.array([], pa.large_string()), Records.none()
        return out


def places(pieces: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each piece is among the known ones, -1 if nowhere; pieces and known ones are all different."""
    # The known ones are looked up among the pieces: theirs is the smaller hash table.
    of_known = pc.fill_null(pc.index_in(known, value_set=pieces), -1).to_numpy()
    found, at = np.full(len(pieces), -1, dtype=np.int64), np.flatnonzero(of_known >= 0)
    found[of_known[at]] = at
    return found


class Tokens:
    """Two vocabularies: ids of pieces of text, bytes and decimal names of ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size_a, size_b, alphabet = self.a.get_vocab_size(), self.b.get_piece_size(), {c: b for b, c in enumerate(byte_letters())}
        entries = [self.a.id_to_token(i) or "" for i in range(size_a)]
        self.bytes_a = [bytes(alphabet[c] for c in e) if set(e) <= alphabet.keys() else e.encode() for e in entries]
        self.bytes_b = []
        for i in range(size_b):
            piece = self.b.id_to_piece(i)
            byte = BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode())
        self.entries_a, self.entries_b = (pa.array(side, pa.large_binary()) for side in (self.bytes_a, self.bytes_b))
        self.sizes_a, self.sizes_b = (pc.binary_length(side) for side in (self.entries_a, self.entries_b))
        # Names by id, side and whether the token ends its group's part: "7," or "7|" of A, "7," or "7;" of B.
        ends = [(size_a, ","), (size_a, "|"), (size_b, ","), (size_b, ";")]
        self.names = pa.array([f"{i}{end}" for size, end in ends for i in range(size)], pa.large_string())
        self.starts = np.cumsum([0] + [size for size, _ in ends])
        self.memo = PieceMemo(self.encode)

    def encode(self, pieces: list[str]) -> Records:
        """Records of pieces, each behind a space.

        The libraries are slow on many short texts. Pieces that a space may follow are
        encoded together and cut by bytes: their ends are ends of tokens on both sides.
        A lot that holds a piece whose bytes do not come back is halved, down to that piece.
        """
        if not pieces:
            return Records.none()
        plain = [i for i, p in enumerate(pieces) if p and not p[-1].isspace() and SPACE not in p]
        lots = [plain[start : start + TOGETHER] for start in range(0, len(plain), TOGETHER)]
        order, parts = [], []
        while lots:
            lot = lots.pop()
            records = self.encode_together([pieces[i] for i in lot])
            if records:
                order += lot
                parts.append(records)
            elif len(lot) > 1:
                lots += [lot[: len(lot) // 2], lot[len(lot) // 2 :]]
        for i in sorted(set(range(len(pieces))).difference(order)):
            order.append(i)
            parts.append(self.encode_one(pieces[i]))
        return Records.joined(parts).take(np.argsort(order))

    def encode_together(self, pieces: list[str]) -> Records | None:
        text = " ".join(["", *pieces])
        data = pa.py_buffer(text.encode())
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, pieces)), np.int64, len(pieces)) + 1)
        sides = []
        for ids, entries, sizes in ((self.ids_a(text), self.entries_a, self.sizes_a), (self.b.encode(text[1:]), self.entries_b, self.sizes_b)):
            ids = pa.array(ids, pa.int32())
            sums = np.cumsum(sizes.take(ids).to_numpy())
            if not len(ids) or sums[-1] != data.size or not entries.take(ids).buffers()[2].slice(0, data.size).equals(data):
                return None
            sides.append((ids.to_numpy(), np.r_[0, np.searchsorted(sums, ends) + 1]))
        counts = [np.diff(cuts) for _, cuts in sides]
        last = np.cumsum(2 + counts[0] + counts[1])
        flat = np.empty(last[-1], dtype=np.int32)
        start = np.r_[0, last[:-1]]
        flat[start], flat[start + 1] = 1, counts[0]
        for (ids, cuts), count, first in zip(sides, counts, (start + 2, start + 2 + counts[0])):
            flat[np.arange(len(ids)) + np.repeat(first - cuts[:-1], count)] = ids
        return Records(flat, last)

    def ids_a(self, text: str) -> list[int]:
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode_one(self, piece: str) -> Records:
        """As ``encode``, without ids if the bytes do not come back; library B makes nothing of an empty text, also where it stands for a last space."""
        whole, ids = (" " + piece).encode(), (self.ids_a(" " + piece), self.b.encode(piece) or [self.b.piece_to_id(SPACE)])
        same = all(b"".join(map(names.__getitem__, own)) == whole for names, own in zip((self.bytes_a, self.bytes_b), ids))
        flat = np.array([1, len(ids[0]), *ids[0], *ids[1]] if same else [0, 0], dtype=np.int32)
        return Records(flat, np.array([len(flat)]))


@lru_cache(maxsize=2)
def tokens_of(path_a: str, path_b: str) -> Tokens:
    """The vocabularies of one Python worker."""
    return Tokens(path_a, path_b)


def pieces_of(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Pieces of texts in order, and the index of each one's text; the space before a piece is left out."""
    if pc.any(pc.match_substring(texts, MARK)).as_py():
        cut = re.compile(r"(?<=\S) ")
        lists = pa.array([cut.split(text) for text in texts.to_pylist()], pa.list_(pa.large_string()))
    else:
        marked = pc.replace_substring_regex(texts, CUT, r"\1" + MARK)
        lists = pc.split_pattern(marked, MARK)
    return pc.list_flatten(lists), pc.list_parent_indices(lists)


def id_lists(records: Records) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Of the different pieces: which are whole, and their A and B ids as list arrays."""
    flat, ends = records
    starts = ends - np.diff(ends, prepend=0)
    n_a = flat[starts + 1].astype(np.int64)
    inner = starts + 2 + n_a
    side = np.zeros(len(flat) + 1, dtype=np.int8)  # 0: heads, then +1 up to the A ids' end, B ids after it
    np.add.at(side, starts + 2, 1)
    np.add.at(side, inner, 1)
    np.add.at(side, ends, -2)
    kind = np.cumsum(side[:-1])
    lists = [
        pa.LargeListArray.from_arrays(np.r_[0, np.cumsum(count)], pa.array(flat[kind == k]))
        for k, count in ((1, n_a), (2, ends - inner))
    ]
    return flat[starts].astype(bool), *lists


def token_table(lists: pa.Array, sizes: pa.Array) -> pa.Table:
    """(piece, id, end) of all tokens in order; ends in bytes from the first piece's start: a piece has as many on both sides."""
    ids = pc.list_flatten(lists)
    return pa.table({"piece": pc.list_parent_indices(lists), "id": ids, "end": pc.cumulative_sum(sizes.take(ids))})


def shared_ends(a: pa.Table, b: pa.Table) -> np.ndarray:
    """The ends of tokens of both sides, in order."""
    both = a.select(["end"]).join(b.select(["end"]), "end", join_type="inner", use_threads=False)
    return np.sort(both["end"].to_numpy())


def with_groups(tokens: pa.Table, shared: np.ndarray) -> pa.Table:
    """Adds ``group``: the number of the first shared end at or after the token's own."""
    return tokens.append_column("group", pa.array(np.searchsorted(shared, tokens["end"].to_numpy())))


def counted(codes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, with their number or the sum of ``times``."""
    table = pa.table({"code": codes, "times": codes if times is None else times})
    sums = table.group_by("code", use_threads=False).aggregate([([], "count_all") if times is None else ("times", "sum")])
    found = sums["code"].to_numpy()
    order = np.argsort(found)
    return found[order], sums.column(1).to_numpy()[order]


def group_ids(tokens: pa.Table, name: str, bits: int) -> pa.Table:
    """(group, id, times) of the tokens, which come in the order of groups: nearly sorted codes, put in order and counted by runs."""
    codes = np.sort(tokens["group"].to_numpy() << bits | tokens["id"].to_numpy(), kind="stable")
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    own = codes[first]
    return pa.table({"group": own >> bits, name: own & (1 << bits) - 1, "times_" + name: np.diff(first, append=len(codes))})


def link_counts(a: pa.Table, b: pa.Table, group_piece: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links by code (piece, A id, B id; an id has ``bits`` bits). A group gives its different pairs, never all occurrences."""
    sides = [group_ids(a, "a", bits), group_ids(b, "b", bits)]
    pairs = sides[0].join(sides[1], "group", join_type="inner", use_threads=False)
    group, of_a, of_b, times_a, times_b = (pairs[n].to_numpy() for n in ("group", "a", "b", "times_a", "times_b"))
    return counted(group_piece[group] << 2 * bits | of_a << bits | of_b, times_a * times_b)


def group_names(tokens: Tokens, a: pa.Table, b: pa.Table, pieces: int) -> pa.Array:
    """Each piece's groups, ``a1,a2|b1;a3|b2;``."""
    group_a, group_b = a["group"].to_numpy(), b["group"].to_numpy()
    place = np.empty(len(group_a) + len(group_b), dtype=np.int32)
    for group, other, side, ids, kind in ((group_a, group_b, "left", a, 0), (group_b, group_a, "right", b, 2)):
        last = np.diff(group, append=-1) != 0
        at = np.arange(len(group)) + np.searchsorted(other, group, side=side)
        place[at] = ids["id"].to_numpy() + np.where(last, tokens.starts[kind + 1], tokens.starts[kind])
    if not len(place):
        return pa.array([""] * pieces, pa.large_string())
    # The names taken lie end to end in one buffer: a piece's are a slice of it.
    _, offsets, data = tokens.names.take(pa.array(place)).buffers()
    count = sum(np.bincount(t["piece"].to_numpy(), minlength=pieces) for t in (a, b))
    ends = np.frombuffer(offsets, dtype=np.int64)[np.r_[0, np.cumsum(count)]]
    return pa.Array.from_buffers(pa.large_string(), pieces, [None, pa.py_buffer(ends), data])


def linked_pieces(tokens: Tokens, lists: list[pa.Array], first: int, bits: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of some pieces, the first one's number being ``first``: names and number of their groups, links by code and times of these."""
    a, b = (token_table(own, sizes) for own, sizes in zip(lists, (tokens.sizes_a, tokens.sizes_b)))
    shared, pieces = shared_ends(a, b), len(lists[0])
    group_piece = a["piece"].to_numpy()[np.searchsorted(a["end"].to_numpy(), shared)]
    a, b = with_groups(a, shared), with_groups(b, shared)
    links, times = link_counts(a, b, group_piece, bits)
    return group_names(tokens, a, b, pieces), np.bincount(group_piece, minlength=pieces), links + (first << 2 * bits), times


def group_digests(names: pa.Array, codes: np.ndarray, per_doc: np.ndarray) -> list[str]:
    """Hash of each document's groups, but for the last separator; empty for documents without tokens."""
    if not len(codes):
        return [""] * len(per_doc)
    _, offsets, data = names.take(pa.array(codes)).buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[np.r_[0, np.cumsum(per_doc)]].tolist()
    return [hashlib.sha256(data[start : end - 1]).hexdigest() if end > start else "" for start, end in pairwise(ends)]


def sums_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the first ``counts[0]`` values, the next ``counts[1]``, and so on."""
    return np.diff(np.r_[0, np.cumsum(values)][np.r_[0, np.cumsum(counts)]])


def document_links(number: np.ndarray, codes: np.ndarray, ends: np.ndarray, links: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links by ``number`` of their place's document plus link, with the sum of their times.

    ``codes`` are the pieces at the places, piece p has links ``ends[p]`` to ``ends[p + 1]``. Those of some places are
    written out and counted at once, so that what is held are counts, never the links of all places.
    """
    sizes = np.diff(ends)[codes]
    before = np.r_[0, np.cumsum(sizes)]
    parts, start = [(np.empty(0, dtype=np.int64),) * 2], 0
    while start < len(codes):
        end = max(start + 1, int(np.searchsorted(before, before[start] + LINKS, side="right")) - 1)
        size = sizes[start:end]
        at = np.arange(size.sum()) + np.repeat(ends[codes[start:end]] - before[start:end] + before[start], size)
        parts.append(counted(np.repeat(number[start:end], size) + links[at], times[at]))
        start = end
    return counted(*map(np.concatenate, zip(*parts))) if len(parts) > 2 else parts[-1]


def align(tokens: Tokens, doc_ids: pa.Array, texts: pa.Array, chunk: int) -> dict:
    """The columns of BODY and the pairs (a, b, docs) for the documents of a chunk."""
    docs = len(texts)
    pieces, parents = pieces_of(pc.fill_null(texts, "").cast(pa.large_string()))
    parents = parents.cast(pa.int64())
    filled = np.flatnonzero(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) > 0)
    encoded = pieces.dictionary_encode()
    different = len(encoded.dictionary)
    whole, *lists = id_lists(tokens.memo.take(encoded.dictionary))
    number, codes = parents.to_numpy(), encoded.indices.to_numpy()
    has = np.zeros(docs, dtype=bool)
    has[filled] = True
    has[number[~whole[codes]]] = False
    number, codes = number[has[number]], codes[has[number]]
    bits = max(len(tokens.bytes_a), len(tokens.bytes_b)).bit_length()
    parts = [linked_pieces(tokens, [side[start : start + PIECES] for side in lists], start, bits) for start in range(0, max(1, different), PIECES)]
    names, n_groups, links, times = zip(*parts)
    names, n_groups, links, times = pa.concat_arrays(names), *map(np.concatenate, (n_groups, links, times))
    # Pairs by number, so that a link is one small integer.
    pairs, numbers = np.unique(links & (1 << 2 * bits) - 1, return_inverse=True)
    ends = np.r_[0, np.cumsum(np.bincount(links >> 2 * bits, minlength=different))]
    width = len(pairs).bit_length()
    links, times = document_links(number << width, codes, ends, numbers, times)
    doc, pair = links >> width, links & (1 << width) - 1
    holding = np.bincount(pair, minlength=len(pairs))
    held = holding > 0  # not those that only documents without tokens have
    pairs, holding, pair = pairs[held], holding[held], (np.cumsum(held) - 1)[pair]
    per_doc, n_pairs = np.bincount(number, minlength=docs), np.bincount(doc, minlength=docs)
    n_a, n_b = (np.diff(side.offsets.to_numpy())[codes] for side in lists)
    return {
        "chunk": chunk, "doc_id": doc_ids.cast(pa.int64()),
        "n_a": sums_of(n_a, per_doc), "n_b": sums_of(n_b, per_doc),
        "n_groups": sums_of(n_groups[codes], per_doc), "n_links": sums_of(times, n_pairs),
        "groups_sha256": group_digests(names, codes, per_doc),
        "n_pairs": n_pairs.astype(np.int32), "pair": pair.astype(np.int32), "times": times,
        "a": (pairs >> bits).astype(np.int32), "b": (pairs & (1 << bits) - 1).astype(np.int32), "docs": holding,
    }


def chunks(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows in lots of at most ``limit`` bytes of text, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def stored(row: dict) -> Iterator[pa.RecordBatch]:
    """Rows of STORED for a chunk: one for each of its pairs, then its body in parts."""
    columns = [row[name] if isinstance(row[name], pa.Array) else pa.array(row[name]) for name in BODY]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values) for values in columns]
    body, sink = pa.RecordBatch.from_arrays(lists, names=BODY), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, body.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(body)
    data = memoryview(sink.getvalue())
    parts = [bytes(data[start : start + PART_BYTES]) for start in range(0, len(data), PART_BYTES)]
    schema = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64()), ("body", pa.binary())])
    for n, own in ((len(row["a"]), row), (len(parts), {"body": parts})):
        given = own | {"chunk": np.full(n, row["chunk"]), "place": np.arange(n)}
        rows = [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in schema]
        yield from slices([pa.RecordBatch.from_arrays(rows, schema=schema)], BATCH_ROWS)


def aligned_chunks(docs: DataFrame, path_a: str, path_b: str, limit: int = CHUNK_BYTES) -> DataFrame:
    """STORED of all chunks: the pairs' partial counts, and documents' counts, digests and links as pair numbers."""

    def run(batches):
        tokens, chunk = tokens_of(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lot in chunks(batch, limit):
                yield from stored(align(tokens, lot.column(0), lot.column(1), chunk))
                chunk += 1
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(run, STORED)


def pair_counts(partial: DataFrame) -> DataFrame:
    """(a, b, count, best) from partial counts (a, b, docs): documents that hold a pair, and whether no other of its A id is held by more."""
    counts = partial.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))  # as many rows as A has ids
    return counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def document_sums(rows: DataFrame) -> DataFrame:
    """RESULT from each chunk's rows, next to one another: (chunk, place, count, best, body) of its pairs and of its body's parts, by place."""
    names = [field.split(" ")[0] for field in RESULT.split(", ")]

    def run(batches):
        # Workers come from the encoding stage: this one needs neither its memo nor its vocabularies.
        Memo.forget()
        tokens_of.cache_clear()
        pa.default_memory_pool().release_unused()
        for rows in groups(batches, 1):
            is_body = pc.is_valid(rows["body"])
            body = pa.ipc.open_stream(b"".join(rows["body"].filter(is_body).to_pylist())).read_next_batch()
            row = {name: body.column(name)[0].values for name in BODY}
            pairs = rows.select(["place", "best", "count"]).filter(pc.invert(is_body))
            by_pair = np.zeros((2, len(pairs)), dtype=np.int64)
            for total, name in zip(by_pair, ("best", "count")):
                total[pairs["place"].to_numpy()] = pairs[name].to_numpy()
            docs, pair, times = len(row["doc_id"]), row["pair"].to_numpy(), row["times"].to_numpy()
            doc = np.repeat(np.arange(docs), row["n_pairs"].to_numpy())
            sums = np.zeros((2, docs), dtype=np.int64)
            for total, value in zip(sums, by_pair):
                np.add.at(total, doc, times * value[pair])
            own = {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
            yield pa.RecordBatch.from_arrays([own[n] if n in own else row[n] for n in names], names=names)

    return rows.mapInArrow(run, RESULT)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, limit: int = CHUNK_BYTES) -> DataFrame:
    """RESULT: one row per document, with its links weighed by the pairs' counts over all documents."""
    spark = docs.sparkSession
    bound_batches(spark)  # rows of parts are as long as their text, so a partition of them must not be one batch
    folder = scratch_path(spark, "alignment")
    aligned_chunks(docs, path_a, path_b, limit).write.parquet(f"{folder}/chunks")
    aligned = spark.read.parquet(f"{folder}/chunks")
    cells = aligned.select("chunk", "place", "a", "b", "docs").filter("a is not null")  # without reading bodies
    # Written, so that the join below has plain exchanges and a pair that all chunks hold can be split.
    pair_counts(cells).write.parquet(f"{folder}/pairs")
    counted = cells.join(spark.read.parquet(f"{folder}/pairs"), ["a", "b"])
    counted = counted.select("chunk", "place", "count", "best", F.lit(None).cast("binary").alias("body"))
    bodies = aligned.filter("body is not null")
    bodies = bodies.select("chunk", "place", F.lit(None).cast("long"), F.lit(None).cast("boolean"), "body")
    return document_sums(counted.union(bodies).repartition("chunk").sortWithinPartitions("chunk", "place"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return aligned_documents(read_table(spark, sf_dir, "documents"), *paths)
