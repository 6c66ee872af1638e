"""Compare every registered query with its SQL: python tests/check.py [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registry  # noqa: E402
from tarmac.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, folder: str) -> str:
    """Empty when equal, else what differs."""
    df = registry.queries()[name](spark, folder)
    got_names, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_names, want = _sorted_rows(names, cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{sum(x != y for x, y in zip(got, want))} rows differ, e.g.\n  {a}\n  {b}"
    return ""


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark, con = local_session(), connect(folder)
    bad = 0
    for name in sys.argv[2:] or registry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{time.time() - start:6.1f}s {'ok  ' if not problem else 'FAIL'} {name} {problem}",
              flush=True)
    print(f"{bad} problems")
