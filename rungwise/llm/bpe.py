"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

The merge list fixes how far to the right a token boundary can depend on the
text. A boundary after token ``u`` disappears only by a merge ``(u, c)``; that
merge needs ``c`` whole, and ``c`` may have been taken away by an earlier merge
``(c, d)``, and so on with ever smaller ranks. ``sufficient_lookahead`` adds the
lengths along the longest such chain, by one pass over the merges in rank order.
A token whose end lies that many bytes before the end of the window is stable:
it is emitted, and the rest is encoded on its own, as no merge crosses its end.
Words longer than the window therefore need constant memory.

Decoding maps ids to bytes and feeds them to an incremental UTF-8 state
machine, which keeps the bytes of an unfinished character between pushes.

Null text is empty: no ids, the hash of the empty string. Repeated rows give
repeated results. Other columns of the input are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from rungwise.llm.common import Memo, read_table, slices

# The pre-tokeniser's pattern of the byte-level vocabulary.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next of U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(other)) for b in range(256)]


class Merges:
    """A merge list by ids: ``pairs[(a, b)] = (rank, merged)``."""

    def __init__(self, first: list[int], pairs: dict[tuple[int, int], tuple[int, int]], text: dict[int, bytes]):
        self.first, self.pairs, self.text, self.table = first, pairs, text, PairTable(pairs)
        self.lookahead = self.sufficient_lookahead()

    @classmethod
    def from_json(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        value = {letter: bytes([b]) for b, letter in enumerate(letters)}
        pairs = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        text = {i: b"".join(value[c] for c in token) for token, i in vocab.items() if all(c in value for c in token)}
        merges = cls([vocab[letter] for letter in letters], pairs, text)
        merges.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges.text |= {i: content.encode() for content, i in merges.special.items()}
        return merges

    special: dict[str, int] = {}

    def sufficient_lookahead(self) -> int:
        """Bytes beyond a token's end that can decide whether the boundary there stays."""
        right_end: dict[int, int] = {}  # merged -> its right part
        reach: dict[int, int] = {}  # token -> longest chain among the merges so far that take it as left part

        def longest(token: int) -> int:
            most = reach.get(token, 0)
            while token in right_end:
                token = right_end[token]
                most = max(most, reach.get(token, 0))
            return most

        for (a, b), (_, merged) in sorted(self.pairs.items(), key=lambda item: item[1][0]):
            chain = len(self.text[b]) + longest(b)
            reach[a] = max(reach.get(a, 0), chain)
            right_end.setdefault(merged, b)
        return max(reach.values(), default=0)

    def merge(self, ids: list[int]) -> list[int]:
        """The merges of one window: lowest rank first, from left to right."""
        pairs = self.pairs
        while len(ids) > 1:
            found = [pairs[p] for p in zip(ids, ids[1:]) if p in pairs]
            if not found:
                break
            rank, merged = min(found)
            out, i, last = [], 0, len(ids) - 1
            while i <= last:
                if i < last and pairs.get((ids[i], ids[i + 1]), (-1,))[0] == rank:
                    out.append(merged)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids


    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many short words at once: in each round every unfinished word applies its lowest-ranked pair."""
        done = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), lengths)
        ids = np.array(self.first, dtype=np.int64)[np.frombuffer(b"".join(words), dtype=np.uint8)]
        while len(ids):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            ranks, merged = self.table.find(ids[:-1], ids[1:])
            ranks = np.r_[np.where(owner[1:] == owner[:-1], ranks, self.table.none), self.table.none]
            least = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.r_[starts, len(ids)])
            going = np.repeat(least != self.table.none, sizes)
            ended = ids[~going].astype("<u4").tobytes()
            over, at = least == self.table.none, 0
            for word, size in zip(owner[starts[over]].tolist(), (4 * sizes[over]).tolist()):
                done[word] = ended[at : at + size]
                at += size
            hit = going & (ranks == np.repeat(least, sizes))
            at = np.flatnonzero(hit)
            if len(at):  # in a run such as aaaa take every other pair, from the left
                new_run = np.r_[True, np.diff(at) > 1]
                order = np.arange(len(at)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
                at = at[order % 2 == 0]
                ids[at] = merged[at]
                going[at + 1] = False
            ids, owner = ids[going], owner[going]
        return done


class PairTable:
    """Ranks and results of pairs of ids, found for whole arrays by open addressing."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.none = np.int64(1 << 40)
        self.bits = max(4, (4 * len(pairs)).bit_length())
        keys = np.full(1 << self.bits, -1, dtype=np.int64)
        values = np.zeros((1 << self.bits, 2), dtype=np.int64)
        self.probes = 1
        for (a, b), value in pairs.items():
            slot, probe = self.slot(a << 32 | b), 1
            while keys[slot] >= 0:
                slot, probe = (slot + 1) % len(keys), probe + 1
            keys[slot], values[slot], self.probes = a << 32 | b, value, max(self.probes, probe)
        self.keys, self.ranks, self.merged = keys, values[:, 0].copy(), values[:, 1].copy()

    def slot(self, key: int) -> int:
        return (key * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - self.bits)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a << 32 | b
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)
        ranks, merged = np.full(len(key), self.none), np.zeros(len(key), dtype=np.int64)
        left = np.arange(len(key))
        for _ in range(self.probes):
            held = self.keys[slot]
            same = held == key[left]
            ranks[left[same]], merged[left[same]] = self.ranks[slot[same]], self.merged[slot[same]]
            on = ~same & (held >= 0)
            if not on.any():
                break
            left, slot = left[on], (slot[on] + 1) % len(self.keys)
        return ranks, merged


class Transducer:
    """Bytes of one word in, in chunks of any size; ids out as soon as they are stable."""

    def __init__(self, merges: Merges, step: int = 256):
        self.merges, self.window = merges, merges.lookahead + max(1, step)
        self.held = b""

    def push(self, chunk: bytes) -> Iterator[int]:
        size = self.window  # it may grow on the way
        for start in range(0, len(chunk), size):
            self.held += chunk[start : start + size]
            while len(self.held) >= self.window:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        text, first = self.merges.text, self.merges.first
        window, self.held = self.held[: self.window], self.held[self.window :]
        safe, at = self.window - self.merges.lookahead, 0
        for token in self.merges.merge([first[b] for b in window]):
            end = at + len(text[token])
            if end > safe and at:
                break
            if end > safe:  # a first token longer than the step: more text is needed
                self.window *= 2
                break
            yield token
            at = end
        self.held = window[at:] + self.held

    def finish(self) -> list[int]:
        first, rest, self.held = self.merges.first, self.held, b""
        return self.merges.merge([first[b] for b in rest])


class Encoder:
    """Whole texts to ids: special strings, words, then merges; words are remembered in a bounded memo.

    Words shorter than the window are merged together, longer ones go through the transducer.
    """

    def __init__(self, merges: Merges, step: int = 256, memo: int = 1 << 19):
        self.merges, self.step = merges, step
        names = sorted(merges.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, names))) if names else None
        self.memo = Memo(self._words, memo)
        for name, i in merges.special.items():  # no word of the pattern equals one of them
            self.memo.fixed[name] = np.array([i], dtype="<u4").tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        window = self.merges.lookahead + self.step
        data = [word.encode() for word in words]
        out = self.merges.merge_many([word if len(word) < window else b"" for word in data])
        for k, word in enumerate(data):
            if len(word) >= window:
                machine = Transducer(self.merges, self.step)
                out[k] = np.array([*machine.push(word), *machine.finish()], dtype="<u4").tobytes()
        return out

    def _split(self, text: str) -> list[str]:
        """Words in order, special strings among them as words of their own."""
        if self.specials is None or not self.specials.search(text):
            return WORDS.findall(text)
        words, at = [], 0
        for match in self.specials.finditer(text):
            words += WORDS.findall(text[at : match.start()])
            words.append(match[0])
            at = match.end()
        return words + WORDS.findall(text[at:])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        split = [self._split(text) for text in texts]
        known = self.memo.values([word for own in split for word in own])
        out, at = [], 0
        for own in split:
            out.append(np.frombuffer(b"".join(known[at : at + len(own)]), dtype="<u4"))
            at += len(own)
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


class Decoder:
    """Ids in, text out as soon as its characters are whole; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, text: dict[int, bytes]):
        self.of = text.__getitem__
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: list[int]) -> str:
        return self.machine.decode(b"".join(map(self.of, ids)))

    def finish(self) -> str:
        out = self.machine.decode(b"", final=True)
        self.machine.reset()
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary file."""
    return Encoder(Merges.from_json(path))


def encode_documents(docs: DataFrame, fold: Callable, schema: str, path: str) -> DataFrame:
    """``fold(doc_id, ids, text table)`` for every row of ``doc_id, text``, as rows of ``schema``."""

    def run(batches):
        coder = encoder(path)
        for batch in slices(batches):
            ids = coder.encode_all([text or "" for text in batch.column(1).to_pylist()])
            rows = [fold(d, i, coder.merges.text) for d, i in zip(batch.column(0).to_pylist(), ids)]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    columns = docs.select("doc_id", "text")
    arrow = arrow_schema(schema)
    return columns.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [field.strip().rpartition(" ") for field in ddl.split(",")]
    return pa.schema([(name, kinds[kind]) for name, _, kind in fields])


@lru_cache(maxsize=1 << 17)
def decimal(number: int) -> str:
    return str(number)


def digest_ids(doc_id: int, ids: np.ndarray, text: dict[int, bytes], step: int = 1 << 16) -> dict:
    """Counts and hashes of one document's ids and of the text decoded from them, ``step`` ids at a time."""
    written, read, decoder = hashlib.sha256(), hashlib.sha256(), Decoder(text)
    for start in range(0, len(ids), step):
        part = ids[start : start + step].tolist()
        written.update(((b"," if start else b"") + ",".join(map(decimal, part)).encode()))
        read.update(decoder.push(part).encode())
    read.update(decoder.finish().encode())
    return {"doc_id": doc_id, "n_tokens": len(ids), "ids_sha256": written.hexdigest(), "decoded_sha256": read.hexdigest()}


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return encode_documents(docs, digest_ids, RESULT, public_tokenizers.path("byte_bpe_50k.json"))
