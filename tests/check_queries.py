"""Run every query beside its SQL and compare the rows.

``python tests/check_queries.py [sf_dir] [query prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(_value(row[i])) for i in order) for row in rows))


def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, name, sf_dir):
    """None when the rows agree, otherwise what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, cursor.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, want {len(want)}"
    if not want:
        return "empty result proves nothing"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None


def main(sf_dir="/root/testdata/sf0.01", *prefixes):
    from commutewell.session import build_session

    spark = build_session("check", "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    bad = 0
    for name in entry.queries():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - reported per query
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += verdict is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
