"""Operators 11 to 13 against brute force on small awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rungwise.llm import alignment, conversation_repair as repair, mixing
from rungwise.llm.alignment import PieceMemo, Tokens, align, aligned_documents, op11_alignment
from rungwise.llm.common import BATCH_BYTES, Memo, read_table
from rungwise.llm.queries import ORACLE_SQL
from tests.llm import odd
from tests.oracle import compare, connect

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


# Alignment


def aligned_by_hand(rows):
    """Whole texts through the libraries, groups and links by the definition."""
    import sentencepiece
    from tokenizers import Tokenizer

    names = Tokens(*PATHS)
    a_side = Tokenizer.from_file(PATHS[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    found, holding = [], Counter()
    for doc_id, text in rows:
        ids, groups = ([], []), []
        if text:
            ids = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
            pieces = [[names.bytes_a[i] for i in ids[0]], [names.bytes_b[i] for i in ids[1]]]
            if any(b"".join(side) != (" " + text).encode() for side in pieces):
                ids = ([], [])
            else:
                ends = [list(itertools.accumulate(map(len, side))) for side in pieces]
                cuts = sorted(set(ends[0]) & set(ends[1]))
                for start, end in zip([0, *cuts], cuts):
                    groups.append([[i for i, e in zip(own, at) if start < e <= end] for own, at in zip(ids, ends)])
        links = Counter(pair for group in groups for pair in itertools.product(*group))
        holding.update(links.keys())
        found.append((doc_id, ids, groups, links))
    best = defaultdict(int)
    for (a, _), count in holding.items():
        best[a] = max(best[a], count)
    out = []
    for doc_id, (a, b), groups, links in found:
        digest = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        n_best = sum(n for (x, y), n in links.items() if holding[x, y] == best[x])
        total = sum(n * holding[pair] for pair, n in links.items())
        sha = hashlib.sha256(digest.encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(groups), sum(links.values()), n_best, total, sha))
    return sorted(out, key=repr)


ALIGNED_TEXTS = [
    "a  b\n c", " x ", "a\x00b  c ", "<|endoftext|> <s>q</s><0x41><unk>", "▁x y", "x ▁ y", "   y", "x 　 z", "\r\n\t",
    "naïve café über 数据 数据 🙂🙂", "don't  stop'll ' s", "a\x1f b\x85 c", " ", "   ", "x", "12 345,678.90", "é ﬁ",
]


@pytest.fixture(scope="module")
def aligned_rows():
    rows = [(d, t) for d, t, _ in odd.texts() if t != odd.LONG]
    return rows + [(100 + i, t) for i, t in enumerate(ALIGNED_TEXTS)] + [(1, "x y x y x y"), (1, "x y x y x y")]


def test_alignment_equals_whole_texts(spark, tmp_path, aligned_rows):
    folder = odd.documents(spark, tmp_path, [(d, t, "en") for d, t in aligned_rows])
    want = aligned_by_hand(aligned_rows)
    assert sorted(map(tuple, op11_alignment(spark, folder).collect()), key=repr) == want
    small = aligned_documents(read_table(spark, folder, "documents"), *PATHS, limit=300)
    assert sorted(map(tuple, small.collect()), key=repr) == want


def test_alignment_of_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op11_alignment(spark, sf_dir).collect()), key=repr) == aligned_by_hand(rows)


def test_alignment_of_nothing(spark, tmp_path):
    assert op11_alignment(spark, _empty(spark, tmp_path)).collect() == []


def test_alignment_bounds_the_bytes_of_a_batch(spark, tmp_path):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    folder = odd.documents(spark, tmp_path, [(1, "x y", "en")])
    assert op11_alignment(spark, folder).count() == 1

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    chunks = spark.range(0, 40, 1, 1).select(F.expr("repeat('x', 1 << 20)").alias("row"))
    found = chunks.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in found) == 40 and max(r["bytes"] for r in found) < BATCH_BYTES + (2 << 20)


def test_alignment_works_on_different_pieces_only(monkeypatch):
    """A text a hundred times over: tokens are grouped and joined once, its links counted a hundred times."""
    from rungwise.llm import alignment

    rows = []
    for name in ("shared_ends", "link_counts"):
        inner = getattr(alignment, name)
        monkeypatch.setattr(alignment, name, lambda a, b, *more, inner=inner: rows.append(len(a) + len(b)) or inner(a, b, *more))
    tokens, text = Tokens(*PATHS), "thonre was athawh, naïve 数据 and and"
    once, often = (align(tokens, pa.array([1]), pa.array([" ".join([text] * n)]), 0) for n in (1, 100))
    assert rows[0] == rows[2] and rows[1] == rows[3]
    assert often["n_links"].tolist() == (100 * once["n_links"]).tolist() and often["times"].tolist() == (100 * once["times"]).tolist()


def test_alignment_memo_gives_what_the_libraries_give():
    tokens = Tokens(*PATHS)
    memo = PieceMemo(tokens.encode, 8)
    lots = [["a", "b\n", "", "naïve"], ["b\n", "x" * 99, "c", "ﬁ", "d"], ["e", "f", "a", "▁"], ["x" * 99, "d", "naïve", "g h"]]
    for pieces in lots:
        flat, ends = memo.take(pieces)
        own = [flat[start:end].tolist() for start, end in zip([0, *ends], ends)]
        assert own == [tokens.encode_one(piece).flat.tolist() for piece in pieces]
        assert len(memo.known) <= 8 and "x" * 99 not in memo.known
    Memo.forget()
    assert not memo.known and not memo.older and not len(memo.records.flat) and not len(memo.older_records.flat)
    assert memo.take(["a"]).flat.tolist() == tokens.encode_one("a").flat.tolist()


def test_alignment_gives_spark_small_rows(spark):
    """The JVM never holds a chunk's lists: its pairs and the parts of its body are rows of bounded bytes."""
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(40_000))
    rows = alignment.aligned_chunks(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), *PATHS)
    assert {f.dataType.typeName() for f in rows.schema} == {"long", "integer", "binary"}
    cells, parts = rows.filter("a is not null"), rows.filter("body is not null")
    size = parts.agg(F.max(F.length("body")), F.count("*")).first()
    assert size[0] <= alignment.PART_BYTES and size[1] > 1 and rows.count() == cells.count() + size[1]


def test_alignment_memo_takes_few_bytes_a_piece():
    """In dicts of strings a piece takes 160 bytes and more besides its records: too much for all workers of an executor."""

    def encode(pieces):
        return alignment.Records(np.ones(4 * len(pieces), dtype=np.int32), 4 * np.arange(1, len(pieces) + 1))

    memo = PieceMemo(encode, 1 << 17)
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for start in range(0, 120_000, 20_000):
        memo.take([f"piece{i}" for i in range(start, start + 20_000)])
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(memo.known) + len(memo.older) == 120_000 and held < 80 * 120_000


def test_alignment_of_few_pieces_and_links_at_once(monkeypatch):
    tokens, words = Tokens(*PATHS), "thonre was athawh, naïve 数据 and and \n x 12 345 was".split(" ")
    rng = random.Random(6)
    texts = pa.array([" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(12)] + [None, "", "▁"])
    ids = pa.array(range(len(texts)))
    want = align(tokens, ids, texts, 0)
    monkeypatch.setattr(alignment, "PIECES", 2)
    monkeypatch.setattr(alignment, "LINKS", 5)
    assert {k: list(v) if k != "chunk" else v for k, v in align(tokens, ids, texts, 0).items()} == {
        k: list(v) if k != "chunk" else v for k, v in want.items()
    }


def _empty(spark, folder) -> str:
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


# Mixing


def targets_by_hand(sizes: dict) -> dict:
    """Weights 1, 2, 3 by code point, null last; excess reshared until nobody is above three times its size."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = sum(weight[s] for s in order if s not in full)
        level = (total - sum(3 * sizes[s] for s in full)) / left if left else 0.0
        more = {s for s in order if s not in full and weight[s] * level > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * level for s in order}
        full |= more


def mixed_tables():
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["b", "a", "é", "B", None, "hot", "hot", "hot"])) for i in range(300)]
    rows += [(500, "word " * 9000, "long"), (501, "one two", "tiny"), (502, None, "none"), (503, " \t\n", "none")]
    rows += [(7, "same text", "hot")] * 3 + [(None, "no id", None), (None, None, None), (504, None, "hot")] * 2
    return rows


def write_mixed(spark, folder, rows) -> str:
    df = spark.createDataFrame([(d, t, s, 1, 2, 3) for d, t, s in rows], "doc_id long, text string, source string, size long, row long, slot long")
    df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_mixture_meets_targets(spark, tmp_path):
    rows = mixed_tables()
    folder = write_mixed(spark, tmp_path, rows)
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = Counter()
    for (_, _, source), n in zip(rows, words):
        sizes[source] += n
    targets = targets_by_hand(sizes)
    pieces = mixing.mix(read_table(spark, folder, "documents"), block=64)
    pieces = [r.asDict() for r in pieces.collect()]
    assert {(p["source"], p["source_size"]) for p in pieces} == set(sizes.items())
    for p in pieces:
        assert p["target"] == pytest.approx(targets[p["source"]], abs=1e-6)
    by_row, by_slot, by_source = defaultdict(list), defaultdict(list), Counter()
    for p in pieces:
        by_row[p["row"]].append(p)
        if p["slot"] is not None:
            by_slot[p["slot"]].append(p)
            by_source[p["source"]] += p["words"]
    assert sorted(((own[0]["doc_id"], own[0]["size"]) for own in by_row.values()), key=repr) == sorted(
        ((d, n) for (d, _, _), n in zip(rows, words)), key=repr
    )
    for source, target in targets.items():
        assert abs(by_source[source] - target) <= 0.5
    for own in by_row.values():
        taken = [range(p["first"], p["first"] + p["words"]) for p in own if p["slot"] is not None]
        assert all(p["words"] > 0 for p in own if p["slot"] is not None)
        often = Counter(i for r in taken for i in r)
        assert all(n <= 3 for n in often.values()) and all(0 <= i < own[0]["size"] for i in often)
    assert all(len({p["source"] for p in slot}) == 1 for slot in by_slot.values())
    # Blocks of one source are equal to a word; every prefix of the schedule has the shares.
    blocks = defaultdict(set)
    for slot in by_slot.values():
        blocks[slot[0]["source"]].add(sum(p["words"] for p in slot))
    assert all(max(b) - min(b) <= 1 for b in blocks.values())
    total, order = sum(sizes.values()), sorted(by_slot)
    for source in ("hot", "long", "a"):
        share, seen = targets[source] / total, 0
        for n, slot in enumerate(order, 1):
            seen += by_slot[slot][0]["source"] == source
            assert abs(seen - n * share) <= 6
    again = mixing.words_taken(mixing.mix(read_table(spark, folder, "documents").repartition(7), block=64))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(
        map(tuple, mixing.words_taken(mixing.mix(read_table(spark, folder, "documents"), block=64)).collect()), key=repr
    )


def test_ranks_of_points(spark):
    bits = 7
    slots = spark.range(1 << bits).select(mixing.reversed_bits(F.col("id"), bits).alias("slot"), F.col("id").alias("point"))
    ranks = slots.select("slot", "point", *(mixing.earlier_points(F.col("slot"), F.col("point"), F.lit(b), bits).alias(f"b{b}") for b in (0, 1, 37, 128)))
    rows = sorted(map(tuple, ranks.collect()))
    for slot, _, *found in rows:
        assert found == [sum(1 for s, p, *_ in rows if s < slot and p < b) for b in (0, 1, 37, 128)]


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None)], [(1, "x y z", None)], [(None, "x", "a"), (None, "x", "a")]])
def test_small_mixtures(spark, tmp_path, rows):
    folder = write_mixed(spark, tmp_path, rows) if rows else _empty(spark, tmp_path)
    found = mixing.op12_mixing(spark, folder).collect()
    assert len(found) == len(rows)
    assert all(r["taken"] == r["size"] and r["target"] == r["source_size"] for r in found)


def test_mixing_equals_sql(spark, tmp_path, sf_dir):
    assert compare(mixing.op12_mixing(spark, sf_dir), connect(sf_dir), ORACLE_SQL["op12_mixing"]) == []


# Conversations


def audit_by_hand(rows):
    """All edits of a few rows (initial, lost, truncated): the least by cost, then by letters."""
    best = (1 << 30, "")
    inserts = ["", "I", "II"]
    for edits in itertools.product("DKR", repeat=len(rows)):
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            text = "".join(p + e for p, e in zip(put, edits)) + put[-1]
            cost, state, at = 0, "", 0
            for letter in text:
                cost += {"K": 0, "R": 3, "D": 4, "I": 3}[letter]
                if letter == "I":
                    state = "a" if state == "u" else "u"
                    continue
                initial, lost, truncated = rows[at]
                at += 1
                if letter == "D":
                    continue
                cost += 3 * truncated
                needed = "a" if state == "u" else "u"
                if lost or (letter == "K" and initial != needed and not (initial == "s" and state == "")):
                    cost = 1 << 30
                    break
                if letter == "R" and initial == needed:
                    cost += 1
                state = initial if letter == "K" else needed
            if state in ("", "a"):
                best = min(best, (cost, text))
    return best


@pytest.mark.parametrize("modulus", [repair.MODULUS, 3, 1])
def test_audit_is_the_least(modulus):
    rng = random.Random(5)
    for _ in range(120):
        rows = [(rng.choice("ssuuaax") if rng.random() < 0.95 else "", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 4))]
        rows = [(i, lost, cut and not lost) for i, lost, cut in rows]
        audit = repair.Audit(modulus)
        for row in rows:
            audit.row(*row)
        assert audit.result() == audit_by_hand(rows), rows


def audit_by_strings(rows):
    """The same program over whole strings."""
    states = {0: (0, "")}

    def put(into, state, option):
        if state not in into or option < into[state]:
            into[state] = option

    def inserted(now):
        out = dict(now)
        for state, before in ((2, (0, 1, 3)), (3, (2,))):
            for p in before:
                if p in out:
                    put(out, state, (out[p][0] + 3, out[p][1] + "I"))
        return out

    for initial, lost, cut in rows:
        now, after = inserted(states), {}
        for p, (cost, text) in now.items():
            put(after, p, (cost + 4, text + "D"))
            if not lost:
                if initial == "s" and p == 0:
                    put(after, 1, (cost + 3 * cut, text + "K"))
                state, own = (3, "a") if p == 2 else (2, "u")
                put(after, state, (cost + 3 * cut + (0 if initial == own else 3), text + ("K" if initial == own else "R")))
        states = after
    now = inserted(states)
    return min(now[s] for s in (0, 3) if s in now)


def test_long_audits_write_out_what_is_agreed(monkeypatch):
    monkeypatch.setattr(repair, "FLUSH", 8)
    rng = random.Random(6)
    for size in (50, 400, 1500):
        rows = [(rng.choice("suuaaax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(size)]
        audit = repair.Audit()
        for row in rows:
            audit.row(*row)
        assert audit.written and audit.result() == audit_by_strings(rows)
        assert max(state[1].depth for state in audit.states if state) < 64


def repaired_by_hand(conversations):
    """REPAIRED from rows (conv_id, turn, role, text), by the contract."""
    damaged = defaultdict(list)
    for conv, turn, role, text in conversations:
        role, text = role if role is not None else " ", text if text is not None else " "
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        copies = 0 if kind == 0 else 2 if kind == 3 else 1
        damaged[conv] += [(turn, "user" if kind == 4 else role, text)] * copies
    out = []
    for conv, rows in damaged.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        cost, audit = audit_by_strings([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)])
        kept, at, state = [], 0, ""
        for letter in audit:
            if letter == "I":
                role, text = ("assistant" if state == "u" else "user"), ""
            else:
                (_, role, text), at = rows[at], at + 1
                if letter == "D":
                    continue
                if letter == "R":
                    role = "assistant" if state == "u" else "user"
            state = role[:1]
            kept.append(f"{role}:{text}")
        turns = sorted({r[0] for r in rows if r[0] is not None})
        pairs = zip([r[1][:1] for r in rows], [r[1][:1] for r in rows[1:]])
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
        gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
        figures = (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal)
        out.append((conv, gaps, *figures, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def awkward_conversations():
    rng = random.Random(8)
    texts = ["Hello.", "Hello.", "no end", " \t", "", "Why? ", "Yes!\n", None, "é　", "long " * 30_000, "ok ."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for conv in [*range(120), None, -5]:
        for turn in range(rng.randint(1, 9)):
            turn = rng.choice([turn, turn, turn + 3, None]) if rng.random() < 0.2 else turn
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[(turn or 0) % 2]
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randint(0, 9)}."))
    rows += rows[:5] + [(900, 1 << 62, "user", "a."), (900, -(1 << 62), "user", "a.")]
    return rows


def write_conversations(spark, folder, rows) -> str:
    df = spark.createDataFrame(
        [(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, copies int, digest string, kind int"
    )
    df.repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def test_repair_equals_brute_force(spark, tmp_path):
    rows = awkward_conversations()
    found = repair.op13_conversation_repair(spark, write_conversations(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == repaired_by_hand(rows)


def test_repair_of_one_large_conversation(spark, tmp_path):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", "cut", f"t{t}."])) for t in range(4000)]
    rows += [(2, 0, "user", "hi."), (2, 1, "assistant", "ho.")]
    found = repair.op13_conversation_repair(spark, write_conversations(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == repaired_by_hand(rows)


def test_repair_equals_sql(spark, sf_dir):
    assert compare(repair.op13_conversation_repair(spark, sf_dir), connect(sf_dir), ORACLE_SQL["op13_conversation_repair"]) == []


def test_repair_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert repair.op13_conversation_repair(spark, str(tmp_path)).collect() == []
