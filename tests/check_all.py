"""Time and check registered queries by hand: python -m tests.check_all <sf_dir> [keys...]"""

from __future__ import annotations

import sys
import time

from __spark_entry__ import oracle_sql, queries
from rungwise.session import build_session
from tests.oracle import compare, connect


def main(sf_dir: str, keys: list[str]) -> None:
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls = connect(sf_dir), oracle_sql()
    for key, run in queries().items():
        if keys and key not in keys:
            continue
        start = time.perf_counter()
        try:
            df = run(spark, sf_dir)
            if key in sqls:
                found = compare(df, connection, sqls[key])
                state = "ok" if not found else f"DIFFERS {found}"
            else:
                rows = df.collect()
                state = f"rows {len(rows)}: {rows[:6]}"
        except Exception as error:  # report and go on with the next query
            state = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{key:22s} {time.perf_counter() - start:6.2f}s {state}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
