"""Run queries in Spark and their SQL in DuckDB and compare schema names, row counts and values."""

from __future__ import annotations

import argparse
import collections
import datetime
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        if math.isnan(value):
            return ("float", "nan")
        return ("float", repr(value + 0.0 if value else 0.0))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("date", str(value))
    return (type(value).__name__, value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(frame, con, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    actual = rows_of(frame.columns, frame.collect())
    if actual == expected:
        return None
    extra, lost = actual - expected, expected - actual
    return (
        f"rows {sum(actual.values())} vs {sum(expected.values())}, {sum(extra.values())} differ; "
        f"spark {next(iter(extra), None)} sql {next(iter(lost), None)}"
    )


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()

    from flowmosaic.catalog import ORACLES, QUERIES
    from flowmosaic.session import build_session

    spark = build_session("compare", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, args.sf)
            if name in ORACLES:
                problem = compare(frame, con, ORACLES[name])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                problem, state = None, f"rows only: {len(frame.collect())}"
        except Exception as error:  # report and go on with the next query
            problem = state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {state}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
