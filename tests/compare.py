"""Run queries against their SQL: `python -m tests.compare [sf_dir] [query ...]`."""

import math
import os
import sys
import time
from datetime import date, datetime

import duckdb

import __spark_entry__ as spark_entry


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return repr(value)


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def duckdb_rows(sf_dir, sql):
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    result = con.execute(sql)
    columns = [column[0] for column in result.description]
    return columns, result.fetchall()


def mismatch(spark, sf_dir, name):
    """None if both engines agree, else a short text."""
    df = spark_entry.queries()[name](spark, sf_dir)
    got = df.collect()
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    columns, want = duckdb_rows(sf_dir, sql)
    if sorted(df.columns) != sorted(columns):
        return f"columns {df.columns} != {columns}"
    left, right = normal_rows(df.columns, got), normal_rows(columns, want)
    if left == right:
        return None
    only = [(a, b) for a, b in zip(left, right) if a != b][:1]
    return f"{len(left)} != {len(right)} rows, first difference {str(only)[:600]}"


if __name__ == "__main__":
    from tests.conftest import build_session

    session = build_session()
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    for query in sys.argv[2:] or spark_entry.queries():
        start = time.time()
        difference = mismatch(session, folder, query)
        print(f"{query:34s} {time.time() - start:6.2f}s {difference or 'ok'}", flush=True)
