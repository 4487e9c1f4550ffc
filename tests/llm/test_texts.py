"""BPE, packing, SimHash, repeats and languages against brute force and the tokenizers library."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rungwise.llm import bpe, components, langid, packing, simhash, suffix_dedup
from rungwise.llm.common import BATCH_BYTES, read_table
from tests.llm import odd

BYTES, WORDS = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return odd.documents(spark, tmp_path_factory.mktemp("odd"), odd.texts())


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return odd.documents(spark, tmp_path_factory.mktemp("none"), [])


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_bpe_equals_the_library(spark, folder, nothing):
    tokenizer, want = library(BYTES), []
    for doc_id, text, _ in odd.texts():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe.op6_bpe(spark, folder).collect()]
    assert Counter(got) == Counter(want)
    assert bpe.op6_bpe(spark, nothing).count() == 0


@pytest.mark.parametrize("step", [1, 256])
def test_transducer_equals_the_library_on_long_words(step):
    merges, tokenizer, rng = bpe.Merges.from_json(BYTES), library(BYTES), random.Random(step)
    coder = bpe.Encoder(merges, step)
    for letters in ("ab", "aaaab", "inthereon", "éà漢", "-=", "Ã\x82"):
        word = "".join(rng.choice(letters) for _ in range(2500))
        want = tokenizer.encode(word, add_special_tokens=False).ids
        assert coder.encode(word).tolist() == want
        machine, data = bpe.Transducer(merges, step), word.encode()
        if len(bpe.WORDS.findall(word)) == 1:
            got = [i for k in range(0, len(data), 37) for i in machine.push(data[k : k + 37])]
            assert got and len(machine.held) < 2 * machine.window and got + machine.finish() == want


def test_decoder_is_incremental():
    text = {0: b"\xe6", 1: b"\xbc\xa2", 2: b"a", 3: b"\xff"}
    decoder = bpe.Decoder(text)
    assert [decoder.push([i]) for i in (2, 0, 1, 0, 2, 3)] == ["a", "", "漢", "", "�a", "�"]
    assert decoder.push([0]) + decoder.finish() == "�"


def check_packed(rows, window, tokenizer, docs):
    pieces, doc_of = {}, {d: t for d, t in docs}
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        pieces.setdefault(r["doc_id"], []).append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in own])
        assert [r["offset"] for r in own] == [0, *ends[:-1].tolist()] and ends[-1] <= window
    for doc_id, own in pieces.items():
        ids = np.array([*tokenizer.encode(doc_of[doc_id] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        copies = len([d for d, _ in docs if d == doc_id])
        assert sum(r["length"] for r in own) == copies * len(ids)
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids)
    return by_sequence


@pytest.mark.parametrize("window", [16, 4096])
def test_packing_places_every_id_once(spark, folder, nothing, window):
    docs = [(d, t) for d, t, _ in odd.texts()]
    table = spark.read.parquet(f"{folder}/documents.parquet")
    by_sequence = check_packed(packing.pack(table, WORDS, window).collect(), window, library(WORDS), docs)
    short = [s for s in by_sequence.values() if sum(r["length"] for r in s) < window]
    assert len(short) <= 2
    assert packing.pack(spark.read.parquet(f"{nothing}/documents.parquet"), WORDS).count() == 0


def test_library_memo_equals_whole_texts():
    memo, tokenizer, rng = packing.library_memo(WORDS), library(WORDS), random.Random(3)
    letters = [*"abcΣσςİŉ̧́ \n\t\x0b\xa0\x01'.,!<|>12²ⅧA漢가ﬁ😀\x85", "<|endoftext|>", "'s", "'ll"]
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.choice([3, 10, 60])))
        ids = np.frombuffer(b"".join(memo.values(packing.pieces_of(text))), "<u4")
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_and_marks_are_the_library_s():
    memo, tokenizer, rng = packing.library_memo(WORDS), library(WORDS), random.Random(12)
    texts = ["a <|ENDOFTEXT|> b", "<|StartOfText|>x <|endoftext|>", "T\u0308 J\u030c H\u0331 The\u0301", "ÀB \u212a K"]
    letters = [*"THJKabÀéΣİ \n<|>\u0308\u030c\u0331\u0301\u212a", "<|ENDOFTEXT|>", "<|endoftext|>", "<|EndOfText|>"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.choice([3, 10, 60]))) for _ in range(1500)]
    for text in texts:
        ids = np.frombuffer(b"".join(memo.values(packing.pieces_of(text))), "<u4")
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_different_pieces_equal_whole_texts():
    memo, tokenizer, rng = packing.library_memo(WORDS), library(WORDS), random.Random(5)
    letters = [*"abcZz09ÀéÿßÞ×÷Σςİŉ\u0307.,.,.,   \n\t\x01'!<|>²漢ﬁ😀", "<|endoftext|>", "'s", "</w>", "é.", "İ.", "word,", "<|ENDOFTEXT|>."]
    for _ in range(60):
        texts = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 10, 60]))) for _ in range(40)]
        got = packing.text_ids([text.encode() for text in texts], memo)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert packing.text_ids([], memo) == []


def test_a_piece_is_looked_up_once_for_many_texts():
    asked = []

    def compute(pieces):
        asked.extend(pieces)
        return [piece.encode() for piece in pieces]

    memo = packing.Memo(compute)
    looked_up, values = [], memo.values
    memo.values = lambda pieces: looked_up.extend(pieces) or values(pieces)
    texts = [b"Some words, some words.\nWords again", b"", b"again words."] * 300
    assert packing.text_ids(texts, memo)[:3] == [b"somewords,somewords.wordsagain", b"", b"againwords."]
    assert sorted(asked) == ["", ",", ".", "again", "some", "words"]
    assert len(looked_up) < 20


def test_fill_is_the_best_subset_sum():
    rng = random.Random(4)
    for _ in range(200):
        counts = Counter({rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(0, 5))})
        items, capacity = list(counts.elements()), rng.randint(0, 60)
        chosen = packing.fill(counts, capacity)
        sums = {sum(c) for n in range(len(items) + 1) for c in combinations(items, n)} if len(items) < 12 else None
        total = sum(n * k for n, k in chosen.items())
        assert all(chosen[n] <= counts[n] for n in chosen) and total <= capacity
        assert sums is None or total == max(s for s in sums if s <= capacity)


def brute_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    some = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in some]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, folder, nothing):
    rows = [(d, brute_fingerprint(t)) for d, t, _ in odd.texts()]
    number = list(range(len(rows)))
    near = [(a, b) for a, b in combinations(number, 2) if (rows[a][1] ^ rows[b][1]).bit_count() <= 4]
    group = odd.components(number, near)
    first: dict = {}
    for i in number:
        first[group[i]] = min(filter(lambda d: d is not None, [first.get(group[i]), rows[i][0]]), default=None)
    want = Counter((rows[i][0], f"{rows[i][1]:016x}", first[group[i]]) for i in number)
    assert Counter(tuple(r) for r in simhash.op7_simhash(spark, folder).collect()) == want
    assert simhash.op7_simhash(spark, nothing).count() == 0
    kept = simhash.one_of_each_group(spark.read.parquet(f"{folder}/documents.parquet"))
    assert kept.count() == len(set(group.values())) and "component_id" in kept.columns


@pytest.mark.parametrize("radius", [1, 4, 9])
def test_near_links_keep_connectivity(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = {b for b in base} | {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 6))) % 2**64 for b in base * 12}
    signed = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = simhash.near_links(df, radius)
    bits = {v: v & 2**64 - 1 for v in signed}
    want = odd.components(signed, [(a, b) for a, b in combinations(signed, 2) if (bits[a] ^ bits[b]).bit_count() <= radius])
    found = odd.components(signed, [tuple(r) for r in links.collect()])
    assert found == want
    told = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert all(told.get(v, v) == want[v] for v in signed)


def test_thresholds_cost_least_and_cover():
    work = [[5.0, 9.0, 30.0], [1.0, 2.0, 3.0], [4.0, 50.0, 60.0]]
    cost, chosen = simhash.allocate(work, 2)
    options = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c + 3 == 3]
    best = min(sum(w[t] for w, t in zip(work, o) if t >= 0) for o in options)
    assert cost == best and sum(t + 1 for t in chosen) == 3


def test_large_buckets_are_dealt_in_chunks(spark):
    from pyspark.sql import functions as F

    from rungwise.llm.blocks import chunk_pairs, crossing

    rows = spark.range(60).select((F.col("id") > 49).cast("long").alias("bucket"), "id")
    met = Counter()
    tasks: dict = {}
    for r in chunk_pairs(rows, "bucket", F.col("id"), chunk=10).collect():
        tasks.setdefault((r["bucket"], r["lo"], r["hi"]), []).append((r["id"], r["chunk"]))
    for (_, lo, hi), own in tasks.items():
        across = crossing(np.array([c for _, c in own]), lo, hi)
        met.update(
            frozenset((own[i][0], own[j][0])) for i, j in combinations(range(len(own)), 2) if across is None or across[i, j]
        )
    want = {frozenset(p) for p in combinations(range(50), 2)} | {frozenset(p) for p in combinations(range(50, 60), 2)}
    assert set(met) == want and set(met.values()) == {1}


def brute_repeats(rows, window=200):
    data = [(d, (t or "").encode()) for d, t, _ in rows]
    seen = Counter(b[i : i + window] for _, b in data for i in range(len(b) - window + 1))
    out = []
    for d, b in data:
        covered = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                covered[i : i + window] = b"\1" * window
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((d, len(b), sum(covered), spans, sha(bytes(x for x, c in zip(b, covered) if not c))))
    return out


@pytest.mark.parametrize("limit", [suffix_dedup.LIMIT, 2])
def test_repeats_equal_brute_force(spark, folder, nothing, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (200, 40, limit))
    got = [tuple(r) for r in suffix_dedup.op5_suffix_dedup(spark, folder).collect()]
    assert Counter(got) == Counter(brute_repeats(odd.texts()))
    assert suffix_dedup.op5_suffix_dedup(spark, nothing).count() == 0


def test_texts_without_repeats_keep_their_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = suffix_dedup.without_repeats(docs)
    assert kept.schema == docs.schema and kept.count() == docs.count()
    assert kept.filter("doc_id = 6").first()["text"] == "" and kept.filter("doc_id = 2").first()["text"] is None
    assert kept.filter("n_chars <> length(text)").count() == 0


def test_columns_sort_suffixes_and_prefixes():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(40)]
    columns = suffix_dedup.aligned(strings, np.zeros(40, dtype=np.int64), 12, 0)
    for column, order, differs in suffix_dedup.insert_columns(columns):
        suffixes = [strings[i][column:] for i in order]
        assert suffixes == sorted(suffixes)
        for k in range(1, 40):
            a, b = suffixes[k - 1], suffixes[k]
            common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
            assert differs[k] == column + common


LANGUAGES = {"en": "the of and ing tion wh", "de": "der und sch ung ei ü", "fr": "le eau et é ç que"}


def made_up(n):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(LANGUAGES))
        words = LANGUAGES[lang].split()
        text = " ".join("".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 40)))
        rows.append((i, text, lang))
    return rows


def test_language_on_held_out_rows(spark, tmp_path):
    rows = made_up(900)
    folder = odd.documents(spark, tmp_path, rows + [(None, "the and", None), (901, None, "en"), (902, "12 !", "de")])
    got = langid.op10_langid(spark, folder).collect()
    truth = {d: lang for d, _, lang in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)
    assert len(held) > 150 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) > 0.98 * len(held)
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert told[901] == told[902] == ("und", 0.0) and told[None][0] in LANGUAGES and all(0 <= s <= 1 for _, s in told.values())
    kept = langid.keep_known(spark.read.parquet(f"{folder}/documents.parquet"))
    assert kept.count() == 901 and kept.columns == spark.read.parquet(f"{folder}/documents.parquet").columns


def test_every_row_that_may_be_learnt_from_sets_the_limits(spark, monkeypatch):
    rng = random.Random(5)
    words = [chr(c) * 2 + chr(c + 1) for c in range(0x4E00, 0x4E00 + 600)]
    # Rare but good: too few to be in a sample of some rows, and a language with no other row of their length.
    rare = [(20_000 + i, " ".join(rng.choices(words, k=500)), "zh") for i in range(8)]
    docs = spark.createDataFrame(made_up(600) + rare, "doc_id long, text string, lang string").cache()
    known = docs.dropna().filter(~langid.held_out())
    frequencies = langid.document_frequencies(known)
    counts = langid.rarity_counts(known, frequencies).collect()
    assert sum(r["n"] for r in counts) == known.count()
    limits = [langid.fit(docs, per_language, limited=True).limits.tolist() for per_language in (1, 4, 1_500)]
    assert limits[0] == limits[1] == limits[2] and np.isfinite(limits[0][-1])
    monkeypatch.setattr(langid.fit, "__defaults__", (1, False))
    assert langid.keep_known(docs).count() == docs.count()


def test_limits_pass_over_a_tail_of_each_language():
    clean = [("en", 12, 500, 1_990), ("en", 12, 510, 9), ("de", 12, 700, 3), ("de", 13, 600, 1), ("fr", 12, 3_000, 3)]
    limits = langid.rarity_limits(clean + [("en", 12, 2_000, 1)])
    assert limits.tolist() == langid.rarity_limits(clean).tolist()
    assert limits[11] == limits[12] == limits[40] == langid.MARGIN * 700 / langid.STEPS and np.isinf(limits[9])
    assert np.isinf(langid.rarity_limits([])).all() and np.isinf(langid.rarity_limits([("fr", 12, 900, 3)])).all()


def test_language_without_anything_to_learn(spark, folder, nothing):
    assert langid.op10_langid(spark, nothing).count() == 0
    assert langid.op10_langid(spark, folder).count() == len(odd.texts())


def test_unlabelled_documents_with_letters_stay(spark):
    rows = [(1, "some text", None), (2, "12 !", None), (3, None, None), (4, "ж", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in langid.keep_known(docs).collect()} == {1, 4}


def test_garbled_and_unlearnt_texts_go_clean_ones_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rng, clean = random.Random(11), docs.collect()
    long_ones = [r["text"] for r in clean if len(r["text"]) > 400][:60]
    junk = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz  ", k=len(t))) for t in long_ones]
    unlearnt = ["".join(rng.choices([chr(c) for c in range(0x430, 0x450)] + [" "] * 5, k=len(t))) for t in long_ones]
    blobs = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=len(t))) for t in long_ones]
    odd_rows = [(10**6 + i, t, None) for i, t in enumerate(junk + unlearnt + blobs)]
    both = docs.unionByName(spark.createDataFrame(odd_rows, docs.schema))
    kept = {r["doc_id"] for r in langid.keep_known(both).collect()}
    assert kept == {r["doc_id"] for r in clean}


def brute_grams(text):
    """Counts by place, one n-gram at a time."""
    line = [32]
    for c in text.lower():
        if c.isalpha():
            line.append(ord(c))
        elif line[-1] != 32 or len(line) == 1:
            line.append(32)
    if not any(c.isalpha() for c in text):
        return Counter()
    line = [32] + (line[2:] if line[1:2] == [32] else line[1:]) + [32]
    counts = Counter()
    for size in (1, 2, 3):
        for start in range(len(line) - size + 1):
            value = 0
            for point in line[start : start + size]:
                value = (value + point) * 0x9E3779B1 % 2**32
                value ^= value >> 15
            counts[value * 0x85EBCA77 % 2**32 >> 32 - langid.FEATURE_BITS] += 1
    return counts


def test_prediction_equals_a_plain_multinomial(spark, tmp_path):
    rows = made_up(300) + [(400 + i, t, None) for i, t in enumerate(["The und, ça va?", "ü", "  le 12 eau! ", "x" * 5000])]
    folder = odd.documents(spark, tmp_path, rows)
    model = langid.fit(read_table(spark, folder, "documents"))
    known = [t for d, t, lang in rows if lang and zlib.crc32(str(d).encode()) % 4 != 2]
    holding = Counter(place for t in known for place in brute_grams(t))
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.op10_langid(spark, folder).collect()}
    for d, text, _ in rows:
        values = {p: math.log1p(n) * (math.log((1 + len(known)) / (1 + holding[p])) + 1) for p, n in brute_grams(text).items()}
        length = math.sqrt(sum(v * v for v in values.values()))
        logits = [sum(v / length * model.weights[p, k] for p, v in values.items()) / model.temperature for k in range(len(model.languages))]
        odds = [math.exp(x - max(logits)) for x in logits]
        best = max(range(len(odds)), key=lambda k: odds[k])
        assert told[d][0] == model.languages[best] and abs(told[d][1] - odds[best] / sum(odds)) < 1e-9


def test_temperature_calibrates():
    rng = np.random.default_rng(7)
    labels = rng.integers(0, 3, 3000)
    logits = rng.standard_normal((3000, 3))
    logits[np.arange(3000), labels] += 1.0
    assert abs(langid.fit_temperature(logits * 8, labels) / langid.fit_temperature(logits, labels) / 8 - 1) < 0.02


def test_most_weights_are_zero():
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(400):
        label = int(rng.integers(0, 2))
        places = np.unique(np.r_[label, rng.integers(100, 2000, 30)])
        rows.append((places, np.full(len(places), 1 / np.sqrt(len(places))), label))
    weights = langid.fit_weights(rows, 2)
    assert weights[0, 0] > 0 > weights[1, 0] and (weights == 0).mean() > 0.9


@pytest.mark.parametrize("segment", [1 << 22, 500, 64])
def test_cut_texts_keep_every_window_and_its_anchor(monkeypatch, segment):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abcdefgh ") for _ in range(n)) for n in (0, 199, 200, 201, 777, 5000)] + [b"a" * 3000]
    seen: dict = {}
    near: set = set()
    for rows, shifts, pieces in suffix_dedup.segments(texts, 200):
        bounds = np.cumsum([0, *map(len, pieces)])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        (text, first, left, more, hashes), spans = suffix_dedup.anchors_of(data, bounds, 200, 40)
        near |= {(rows[t], start + shifts[t] + k) for t, start, end in zip(*spans) for k in range(end - start - 199)}
        for row, start, shift, distance, further, value in zip(
            np.array(rows)[text], first, np.array(shifts)[text], left, more, hashes
        ):
            for k in range(further + 1):
                window = (int(row), int(start + shift + k))
                assert window not in seen
                seen[window] = (int(distance - k), int(value))
    # Windows that repeat nearby are spans; all others are kept, and one at least of each content.
    every = {(row, k) for row, text in enumerate(texts) for k in range(len(text) - 199)}
    assert set(seen) | near == every
    contents = Counter(texts[row][k : k + 200] for row, k in every)
    assert all(contents[texts[row][k : k + 200]] > 1 for row, k in near)
    assert {texts[row][k : k + 200] for row, k in seen} == set(contents)
    assert segment < 1 << 22 or sum(row == 6 for row, _ in seen) == 1
    by_content: dict = {}
    for (row, k), anchor in seen.items():
        assert by_content.setdefault(texts[row][k : k + 200], anchor) == anchor


def repeating_rows():
    rng = random.Random(12)

    def prose(size):
        return "".join(rng.choices("abcdefgh éñ,.", k=size))

    period, ruler, shared = prose(37), prose(90), prose(400)
    rows = [(i, t, None) for i, t in enumerate([
        "x" * 100_000, "=" * 500 + prose(300) + "=" * 700, period * 40 + prose(80), prose(50) + period * 9, ruler * 6, ruler * 3,
        "-" * 260, "ab" * 150, "ab" * 99, "ab" * 101, "b" + "ab" * 100, prose(300) + "y" * 201, "y" * 200, "y" * 199, shared + "z" * 205,
    ])]
    once = prose(2_000)
    rows += [(50, once, None)] * 300 + [(None, shared + prose(20), None)] * 40 + [(60 + i, once[:900], None) for i in range(30)]
    return rows


def test_runs_and_repeated_rows_equal_brute_force(spark, tmp_path):
    rows = repeating_rows()
    folder = odd.documents(spark, tmp_path, rows)
    got = [tuple(r) for r in suffix_dedup.op5_suffix_dedup(spark, folder).collect()]
    assert Counter(got) == Counter(brute_repeats(rows))


def strings_sent(spark, rows) -> int:
    docs = suffix_dedup.keyed(spark.createDataFrame(rows, "doc_id long, text string"))
    anchors = suffix_dedup.anchor_rows(docs).filter("h IS NOT NULL").drop("until")
    counts = anchors.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    return suffix_dedup.context_rows(docs, anchors.join(counts, "h"), 200, suffix_dedup.LIMIT).count()


def test_strings_grow_with_the_rows(spark):
    text = "".join(random.Random(3).choices("abcdefgh ,.", k=2_000))
    sent = {n: strings_sent(spark, [(7, text)] * n) for n in (2, 400, 2_000)}
    assert sent[2] < 100 and sent[400] <= 400 * sent[2] and sent[2_000] <= 2_000 * sent[2]
    assert strings_sent(spark, [(None, text)] * 500) <= 500 * sent[2]
    assert strings_sent(spark, [(1, "a" * 100_000), (2, "a" * 100_000)]) == 2
    assert strings_sent(spark, [(1, "abcdefg" * 10_000), (2, "abcdefg" * 10_000)]) < 40


def test_anchors_of_long_texts_take_little_memory():
    texts = [random.Random(8).randbytes(9_000_000)]
    tracemalloc.start()
    for _, _, pieces in suffix_dedup.segments(texts, 200):
        suffix_dedup.anchors_of(np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([0, *map(len, pieces)]), 200, 40)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 150 << 20


def test_repeats_bound_arrow_batches(spark, folder):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        suffix_dedup.op5_suffix_dedup(spark, folder)
        assert 0 < int(spark.conf.get(key)) <= BATCH_BYTES
    finally:
        spark.conf.set(key, before)
