"""Run catalog queries against the SQL oracle: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path("/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both engines return the same columns and the same bag of rows."""
    df = query(spark, sf_dir)
    ours = [tuple(row) for row in df.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    left, right = bag(df.columns, ours), bag(columns, theirs)
    if left == right:
        return None
    extra, missing = left - right, right - left
    return (f"rows {len(ours)} vs {len(theirs)}, {sum(extra.values())} differ: "
            f"{list(extra)[:2]} vs {list(missing)[:2]}")


def main() -> None:
    from ledgerwake.catalog import QUERIES
    from ledgerwake.oracle import oracle_sql
    from ledgerwake.session import build_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"{ROOT}/sf{sf}"
    spark = build_session("compare", "local[8]", 8, spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), oracle_sql()
    failed = 0
    for name in names or QUERIES:
        began = time.time()
        try:
            found = difference(spark, con, QUERIES[name], sql[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - began:.2f}s "
              f"{found or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
