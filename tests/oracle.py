"""Run queries and their SQL on the same files and compare the rows.

    python -m tests.oracle [folder] [name ...]

ROWS_PER_TASK=20 makes nearly every key a hot one.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, function, sql):
    """An explanation of the first difference, or None; and the number of rows."""
    df = function(spark, folder)
    names, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got)
    res = con.sql(sql)
    want_names, want = _sorted(res.columns, res.fetchall())
    if names != want_names:
        return f"columns {names} but expected {want_names}", len(got)
    if got != want:
        extra = sorted(set(got) - set(want))[:3]
        missing = sorted(set(want) - set(got))[:3]
        return f"{len(got)} rows, expected {len(want)}; extra {extra}, missing {missing}", len(got)
    return None, len(got)


def main():
    from pyspark.sql import SparkSession

    from stayflow.queries import QUERIES, SQL

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "ROWS_PER_TASK" in os.environ:
        spark.conf.set("stayflow.rowsPerTask", os.environ["ROWS_PER_TASK"])
    con = connect(folder)
    bad = 0
    for name in chosen:
        started = time.time()
        try:
            problem, n = compare(spark, con, folder, QUERIES[name], SQL.get(name))
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:400]}", -1
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {n:7d} rows {time.time() - started:6.2f}s {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")


if __name__ == "__main__":
    main()
