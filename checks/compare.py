"""Run registered queries on Spark and their SQL on DuckDB and compare rows.

    python -m checks.compare [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE, statement
from checks.queries import QUERIES
from pulselake.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            con.execute(f"create view {file[:-8]} as select * from read_parquet('{sf_dir}/{file}')")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(statement(ORACLE[name]))
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if ours != theirs:
        return (f"rows {sum(ours.values())} vs {sum(theirs.values())}; only ours "
                f"{list((ours - theirs).items())[:3]}; only oracle {list((theirs - ours).items())[:3]}")
    return None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(8), connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, name, args.sf)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
