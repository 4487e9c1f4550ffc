"""Language identification by sparse multinomial logistic regression.

Features are the character n-grams of one to ``LONGEST`` letters of the lower-cased text, runs
of anything else being one blank, hashed to ``1 << FEATURE_BITS`` places; their
weight is log(1 + count) times the inverse document frequency, vectors have length one. Document
frequencies come from all rows that may be learnt from. The classifier is fitted on a sample
of them, bounded by ``PER_LANGUAGE`` rows of each language (chosen by a hash of the id),
with follow-the-regularised-leader steps and an elastic-net penalty, so most weights
are zero. A temperature, fitted on a quarter of the sample that the weights never
saw, makes the scores probabilities. Every row is predicted, in one pass.

The chances compare learnt languages with one another; they are near one for garbled text and languages never seen, too.
So whether a text is in any learnt language is told by how rare its n-grams are: their mean inverse document
frequency, against a limit by length that all rows set which may be learnt from, each held against the others
(``MARGIN`` times the most among texts of up to four times its length, a ``TAIL`` of each language's apart).
``strict`` predictions beyond the limit are ``und``; neither weights nor temperature have a part in that.

Null text, and text without a letter, is ``und`` with score zero. Rows without
language or id are predicted, not learnt from. If nothing can be learnt, every row
is ``und``. Repeated rows give repeated rows; other columns are not read. The
number of different languages must be small: weights are a table of places by languages.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from rungwise.llm.common import Memo, read_table, slices

FEATURE_BITS, LONGEST = 15, 3
PER_LANGUAGE = 1_500
EPOCHS, ALPHA, BETA, L1, L2 = 3, 1.0, 1.0, 0.02, 1e-4
UNKNOWN = "und"
MARGIN = 1.25  # rarity beyond that of learnt texts at which a text counts as unrecognised
TAIL, STEPS = 1e-3, 256  # share of a language's texts of one band that sets no limit; steps of rarity that are counted, per unit
ENOUGH = 4  # rows of a language that sets limits
BANDS, SHORT = 48, 10  # lengths by powers of two of n-grams; up to 2^SHORT of them one limit, as few texts are that short


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of the text's n-grams and their counts; none if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    is_letter = letters()[points]
    if not is_letter.any():
        return np.empty(0, dtype=np.int64), np.empty(0)
    spaced = np.where(is_letter, points, 32).astype(np.uint32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    line = np.concatenate(([32], spaced[keep], [32])).astype(np.uint32)
    counts = np.zeros(1 << FEATURE_BITS, dtype=np.int64)
    value = np.zeros(len(line), dtype=np.uint32)
    for size in range(1, LONGEST + 1):
        if len(line) < size:
            break
        value = (value[: len(line) - size + 1] + line[size - 1 :]) * np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        counts += np.bincount((value * np.uint32(0x85EBCA77)) >> np.uint32(32 - FEATURE_BITS), minlength=len(counts))
    places = np.flatnonzero(counts)
    return places, counts[places].astype(np.float64)


def vector(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[places]
    return values / max(math.sqrt(float(values @ values)), 1e-12)


def rarity(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> float:
    """Mean inverse document frequency of a text's n-grams, each weighing the logarithm of its count."""
    weight = np.log1p(counts)
    return float(weight @ idf[places] / weight.sum())


def band(counts: np.ndarray) -> int:
    return max(SHORT, int(counts.sum()).bit_length())


def rarity_counts(docs: DataFrame, frequencies: np.ndarray) -> DataFrame:
    """(lang, band, step, n): all rows by the rarity of their n-grams in the other rows, rounded up to a step.

    ``frequencies`` are of the same rows, so a text is left out of them before it is measured.
    """

    def run(batches):
        idf = np.log(max(frequencies[-1], 1) / np.maximum(frequencies[:-1], 1)) + 1
        for batch in slices(batches):
            found = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places, counts = grams(text)
                if len(places):
                    found.append((lang, band(counts), math.ceil(rarity(places, counts, idf) * STEPS)))
            columns = list(zip(*found)) or [[], [], []]
            kinds = (pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "band", "step"])

    told = docs.select("lang", "text").mapInArrow(run, "lang string, band int, step int")
    return told.groupBy("lang", "band", "step").agg(F.count("*").alias("n"))


def rarity_limits(counts: list[tuple[str, int, int, int]]) -> np.ndarray:
    """The limit of each band from ``rarity_counts``: the most among bands up to two higher, with the margin; none without rows.

    The most of a band is the highest of its languages', each without its ``TAIL``: a few garbled rows set no limit.
    """
    rows: dict[str, int] = {}
    steps: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for lang, own, step, n in counts:
        rows[lang] = rows.get(lang, 0) + n
        steps.setdefault((lang, own), []).append((step, n))
    most = np.zeros(BANDS)
    for (lang, own), found in steps.items():
        if rows[lang] >= ENOUGH:
            step, n = np.array(sorted(found)).T
            above = n.sum() - np.cumsum(n)  # rows beyond each step
            most[own] = max(most[own], step[above <= TAIL * n.sum()][0] / STEPS)
    reach = np.maximum.accumulate(most)[np.minimum(np.arange(BANDS) + 2, BANDS - 1)]
    return np.where(reach > 0, MARGIN * reach, np.inf)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents that hold each place; one small table per task, summed by Spark. The last value is the number of documents."""
    size = (1 << FEATURE_BITS) + 1

    def run(batches):
        Memo.forget()
        total = np.zeros(size, dtype=np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                total[grams(text)[0]] += 1
                total[-1] += 1
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total[places])], names=["place", "n"])

    counts = np.zeros(size)
    for row in docs.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[row["place"]] = row["n"]
    return counts


def sampled(docs: DataFrame, per_language: int) -> list[tuple[str, bool, np.ndarray, np.ndarray]]:
    """At most ``per_language`` rows of each language as features: (language, for calibration, places, counts)."""
    order = F.xxhash64(F.col("doc_id").cast("string"), "text")
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * per_language) / F.col("n"))
    likely = docs.join(F.broadcast(sizes), "lang").withColumn("order", order)
    likely = likely.filter(F.pmod("order", F.lit(1 << 20)) < share * (1 << 20))
    first = Window.partitionBy("lang").orderBy("order", "doc_id")
    chosen = likely.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language)

    def run(batches):
        for batch in slices(batches):
            found = [grams(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0].astype("<u2").tobytes() for f in found], pa.binary()),
                 pa.array([f[1].astype("<u4").tobytes() for f in found], pa.binary())],
                names=["lang", "nth", "places", "counts"],
            )

    rows = chosen.select("lang", "nth", "text").mapInArrow(run, "lang string, nth int, places binary, counts binary")
    table = rows.toArrow().sort_by([("nth", "ascending"), ("lang", "ascending")])
    return [
        (lang, nth % 4 == 0, np.frombuffer(places, "<u2"), np.frombuffer(counts, "<u4"))
        for lang, nth, places, counts in zip(*(table[name].to_pylist() for name in ("lang", "nth", "places", "counts")))
        if places
    ]


def softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return odds / odds.sum(axis=-1, keepdims=True)


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Follow the regularised leader: ``rows`` are (places, values, class); weights by place and class."""
    z = np.zeros((1 << FEATURE_BITS, classes))
    n = np.zeros_like(z)

    def leader(places):
        zp = z[places]
        return np.where(
            np.abs(zp) <= L1, 0.0, -(zp - np.sign(zp) * L1) / ((BETA + np.sqrt(n[places])) / ALPHA + L2)
        )

    for _ in range(EPOCHS):
        for places, values, label in rows:
            w = leader(places)
            error = softmax(values @ w)
            error[label] -= 1
            gradient = values[:, None] * error[None, :]
            squares = n[places] + gradient**2
            z[places] += gradient - (np.sqrt(squares) - np.sqrt(n[places])) / ALPHA * w
            n[places] = squares
    return leader(np.arange(len(z)))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden sections of its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        return -float(np.log(softmax(logits / math.exp(log_t))[np.arange(len(labels)), labels] + 1e-12).mean())

    low, high, ratio = math.log(0.02), math.log(20), (math.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


class Model:
    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float, limits: np.ndarray):
        self.languages, self.idf, self.weights, self.temperature, self.limits = languages, idf, weights, temperature, limits

    def predict(self, text: str | None, strict: bool = False) -> tuple[str, float]:
        places, counts = grams(text or "")
        if not len(places) or not self.languages:
            return UNKNOWN, 0.0
        if strict and rarity(places, counts, self.idf) > self.limits[band(counts)]:
            return UNKNOWN, 0.0
        chances = softmax(vector(places, counts, self.idf) @ self.weights[places] / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, limited: bool = False) -> Model:
    """Learn from rows that have text, language and id and are not held out; ``limited`` also what ``strict`` predictions need."""
    known = docs.select("doc_id", "text", "lang").dropna().filter(~held_out())
    frequencies = document_frequencies(known)
    idf = np.log((1 + frequencies[-1]) / (1 + frequencies[:-1])) + 1
    sample = sampled(known, per_language)
    languages = sorted({row[0] for row in sample})
    number = {lang: i for i, lang in enumerate(languages)}
    rows = [(places, vector(places, counts, idf), number[lang], apart) for lang, apart, places, counts in sample]
    limits = rarity_limits([tuple(row) for row in rarity_counts(known, frequencies).collect()] if limited else [])
    if not rows:
        return Model([], idf, np.zeros((1 << FEATURE_BITS, 0)), 1.0, limits)
    weights = fit_weights([row[:3] for row in rows if not row[3]], len(languages))
    apart = [row for row in rows if row[3]]
    logits = np.array([values @ weights[places] for places, values, _, _ in apart]).reshape(-1, len(languages))
    return Model(languages, idf, weights, fit_temperature(logits, np.array([row[2] for row in apart], dtype=int)), limits)


def predict(
    docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score"), strict: bool = False
) -> DataFrame:
    """The columns of ``docs`` (``text`` among them, ``names`` not) with the language and its chance."""

    place, columns_out = docs.columns.index("text"), [*docs.columns, *names]

    def run(batches):
        for batch in slices(batches):
            found = [model.predict(text, strict) for text in batch.column(place).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=columns_out)

    added = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *added])
    return docs.mapInArrow(run, schema)


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a language that can be learnt from them; those with a letter if none can."""
    model = fit(docs, limited=True)
    if not model.languages:  # nothing to tell texts apart by: every text with a letter stays
        model = Model(["any"], model.idf, np.zeros((1 << FEATURE_BITS, 1)), 1.0, model.limits)
    told = predict(docs, model, ("_language", "_chance"), strict=True)
    return told.filter(F.col("_language") != UNKNOWN).select(*docs.columns)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    told = predict(docs.select("doc_id", "text"), fit(docs))
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
