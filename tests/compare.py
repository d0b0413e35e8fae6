"""Run queries beside their check in DuckDB: same columns, same rows, any order."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as spark_entry  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else format(v, ".10g")
    return str(v)


def _rows(frame) -> list[tuple]:
    columns = sorted(frame.columns)
    lists = [frame[c].tolist() for c in columns]
    return sorted(tuple(_cell(None if v is None or v != v and not isinstance(v, float) else v) for v in row)
                  for row in zip(*lists))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    got = spark_entry.queries()[name](spark, sf_dir).toArrow()
    spent = time.time() - start
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return got.num_rows > 0, f"rows {got.num_rows} {spent:.1f}s"
    want = con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return False, f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    types = {n: (str(got.schema.field(n).type), str(want.schema.field(n).type)) for n in got.column_names}
    odd = {n: t for n, t in types.items() if t[0] != t[1] and "timestamp" not in t[0]}
    a = sorted(tuple(map(_cell, r)) for r in zip(*[got.column(c).to_pylist() for c in sorted(got.column_names)]))
    b = sorted(tuple(map(_cell, r)) for r in zip(*[want.column(c).to_pylist() for c in sorted(got.column_names)]))
    if a == b:
        note = f" types {odd}" if odd else ""
        return True, f"{len(a)} rows {spent:.1f}s{note}"
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return False, f"{len(a)} / {len(b)} rows; spark only {only_a}; check only {only_b}; {sorted(got.column_names)}"


if __name__ == "__main__":
    from vizquarry.session import get_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = get_session(cpus=8), duck(sf_dir)
    bad = 0
    for name in spark_entry.queries():
        if wanted and name not in wanted:
            continue
        try:
            ok, text = compare(spark, con, name, sf_dir)
        except Exception as why:  # a failed query must not hide the others
            ok, text = False, f"{type(why).__name__}: {str(why)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, text, flush=True)
    print("failed:", bad)
