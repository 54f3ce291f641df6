"""Run registered queries against their SQL twins and report differences."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def given_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in GIVEN:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("a twin returned a decimal")
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    columns, rows = normal(spark_df.columns, spark_df.collect())
    answer = con.execute(sql)
    want_columns, want = normal([d[0] for d in answer.description], answer.fetchall())
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(rows) != len(want):
        return f"{len(rows)} rows, twin has {len(want)}"
    for got, expected in zip(rows, want):
        if repr(got) != repr(expected):
            return f"{got} != {expected}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.session import local_session

    spark = local_session()
    con = given_views(sf_dir)
    queries, twins = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = difference(df, con, twins[name]) if name in twins else f"(rows only) {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        if problem and not problem.startswith("(rows only)"):
            failed += 1
        print(f"{'ok  ' if not problem else 'ONLY' if problem.startswith('(') else 'FAIL'} "
              f"{name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
