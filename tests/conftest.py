from __future__ import annotations

import random
from pathlib import Path

import pytest

from rungwise.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "rungwise-tests",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def census_csv(tmp_path_factory) -> str:
    """About 500 made-up census rows: comma and blank, an empty last line, ``?``
    in two columns, 42 countries, one missing number, two duplicate rows and one
    pair of equal features with different labels."""
    rng = random.Random(7)
    work, school = ["Private", "State-gov", "?"], ["HS-grad", "Masters", "10th"]
    rows = []
    for i in range(500):
        hours = rng.randint(10, 70)
        rows.append(
            [
                rng.randint(17, 80), work[i % 3], rng.randint(10000, 900000), school[i * 7 % 3], rng.randint(1, 16),
                "Divorced" if i % 2 else "Widowed", "Sales" if i % 5 else "?", "Wife", "White",
                "Female" if i % 2 else "Male", 0, 0, hours, f"C{i % 42:02d}", ">50K" if hours > 40 else "<=50K",
            ]
        )
    rows += [rows[0], rows[1]]
    rows.append(rows[2][:-1] + ["<=50K" if rows[2][-1] == ">50K" else ">50K"])
    rows.append(rows[3][:2] + [""] + rows[3][3:])
    path = tmp_path_factory.mktemp("census") / "census.csv"
    text = "".join(", ".join(map(str, row)) + "\n" for row in rows) + "\n"
    path.write_text(text.replace(", , ", ",, "))
    return str(path)
