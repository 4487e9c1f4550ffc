"""Run a registered query and its SQL on the same tables and compare whole results."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    for kind, names in {
        "int": ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"),
        "float": ("float", "double"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
    }.items():
        if dtype in names:
            return kind
    return dtype


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(df, connection, sql: str) -> list[str]:
    """Differences between a DataFrame and the SQL's result; empty if none."""
    expected = connection.execute(sql)
    names = [c[0] for c in expected.description]
    kinds = {c[0]: _kind(str(c[1])) for c in expected.description}
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, dtype in df.dtypes:
        if _kind(dtype) != kinds[name]:
            problems.append(f"type of {name}: {dtype} against {kinds[name]}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(names, expected.fetchall())
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}")
    return problems
