"""Run registered queries and their SQL on one data folder and compare all rows."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, run, sql, folder):
    """None when equal, else a short text of the difference."""
    df = run(spark, folder)
    got_cols, got = canonical(df.columns, df.collect())
    if sql is None:
        return None
    rel = con.sql(sql)
    want_cols, want = canonical(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} / {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference {a} / {b}"
    return None


def main(folder: str, *names: str) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from stratamart.operators.skew import MIN_HOT_ROWS_CONF
    from stratamart.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="6g")
    spark.sparkContext.setLogLevel("ERROR")
    if "MIN_HOT_ROWS" in os.environ:  # a low value sends the queries through the split paths
        spark.conf.set(MIN_HOT_ROWS_CONF, os.environ["MIN_HOT_ROWS"])
    con, oracles, bad = connect(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            problem = compare(spark, con, name, run, oracles.get(name), folder)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - begin:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(*sys.argv[1:])))
