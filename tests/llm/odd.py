"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

LONG = " ".join(f"word{i * i % 977}" for i in range(40_000))
PASSAGE = "".join(random.Random(1).choices("abcdefgh éñ,.", k=260))


def texts() -> list[tuple]:
    rng = random.Random(2)
    noise = ["".join(rng.choice("stuvwxyz  ß\n") for _ in range(rng.randint(0, 700))) for _ in range(12)]
    rows = [(10 + i, text, "en") for i, text in enumerate(noise)]
    rows += [(30 + i, noise[i] + PASSAGE + noise[i + 1], "fr") for i in range(5)]
    rows += [(1, noise[3], "en"), (1, noise[3], "en"), (None, "no id at all", None), (2, None, "en"), (3, "", None)]
    rows += [(4, LONG, "en"), (5, "1234 !!", "de"), (6, PASSAGE, "fr"), (7, "a" * 700, "en"), (8, "one two three", "en")]
    rows += [(9, "One  TWO\tthree", "en"), (50, "x<|endoftext|>y  \x0b z\xa0 ", "es")]
    return rows


def documents(spark, folder, rows) -> str:
    """A folder with a documents table; extra columns have the names of the operators' own."""
    df = spark.createDataFrame(
        [(d, t, lang, "src", None if t is None else len(t), "d", 1.0, 7, 8) for d, t, lang in rows],
        "doc_id long, text string, lang string, source string, n_chars long, d string, score double, fp long, component_id long",
    )
    df.repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)


def components(ids, linked):
    """Smallest id of each id's group; ``linked`` yields pairs."""
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
