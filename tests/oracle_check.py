"""Run registered queries next to their SQL and compare the results.

    python -m tests.oracle_check /root/testdata/sf0.01 [name-part ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs. Columns are matched by name, rows in
    any order, values exactly."""
    got_names = sorted(df.columns)
    got = [tuple(row[c] for c in got_names) for row in df.collect()]
    compare.split = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != got_names:
        return f"columns {got_names} != {sorted(names)}"
    order = [names.index(c) for c in got_names]
    want = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for row in want:
        for value in row:
            if not isinstance(value, (int, float, str, bool, type(None))):
                return f"type {type(value)} in SQL result"
    got.sort(key=repr)
    want.sort(key=repr)
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            for name, x, y in zip(got_names, a, b):
                if repr(x) != repr(y):
                    at = 0
                    if isinstance(x, str) and isinstance(y, str):
                        at = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), 0)
                        x, y = x[max(at - 60, 0):at + 60], y[max(at - 60, 0):at + 60]
                    return f"{name}: spark {x!r} != sql {y!r} (row {str(a)[:120]} / {str(b)[:120]})"
    return None


compare.split = 0.0


def main(folder: str, parts: list[str]) -> int:
    from pagemill.session import build_session

    import __spark_entry__ as entry

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="10g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        sql = entry.oracle_sql().get(name)
        started = time.time()
        try:
            df = fn(spark, folder)
            result = compare(df, con, sql) if sql else f"rows {df.count()}"
        except Exception as exc:  # report and go on
            result = f"ERROR {type(exc).__name__}: {str(exc)[:700]}"
        ok = result is None or (sql is None and result.startswith("rows"))
        bad += not ok
        now = time.time()
        mid = compare.split if sql and compare.split > started else now
        print(f"{'ok ' if ok else 'BAD'} {name} spark {mid - started:.1f}s sql {now - mid:.1f}s {result or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
