"""Compare registered queries with their SQL in DuckDB.

    python -m tests.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

from tallyworks.plans.registry import TABLES
from tallyworks.session import build_session


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float) and v == 0:
        return "0.0"
    return "null" if v is None else f"{type(v).__name__}:{v!r}"


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None if both sides hold the same rows."""
    result = con.sql(sql)
    columns, expected = list(result.columns), result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    actual = [tuple(r) for r in df.collect()]
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    a, e = _normal(df.columns, actual), _normal(columns, expected)
    wrong = [(x, y) for x, y in zip(a, e) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[:2]}" if wrong else None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        began = time.time()
        try:
            df = run(spark, folder)
            wrong = differences(df, con, sql[name]) if name in sql else None
            note = wrong or ("ok" if name in sql else f"rows only: {len(df.collect())}")
        except Exception as error:  # noqa: BLE001
            wrong = note = f"failed: {str(error)[:600]}"
            if names:
                traceback.print_exc()
        bad += wrong is not None
        print(f"{name:32s} {time.time() - began:6.2f}s {note}", flush=True)
    print(f"{bad} wrong")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
