"""Run queries in Spark and their SQL in DuckDB and compare by value.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

from millrace.plans.oracles import ORACLES
from millrace.plans.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    order = sorted((d[0], i) for i, d in enumerate(result.description))
    rows = [tuple(r[i] for _, i in order) for r in result.fetchall()]
    return [name for name, _ in order], sorted(rows, key=repr)


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None if the query and its SQL agree, otherwise what differs."""
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    want_columns, want = duck_rows(con, ORACLES[name])
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(rows) != len(want):
        return f"{len(rows)} rows, want {len(want)}"
    # repr keeps 1, 1.0, True and -0.0 apart.
    bad = [(a, b) for a, b in zip(rows, want) if repr(a) != repr(b)]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problem = difference(spark, con, sf_dir, name)
            else:
                problem = None if QUERIES[name](spark, sf_dir).collect() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
        failed += problem is not None
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
