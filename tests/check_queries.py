"""Run registered queries next to their SQL: python tests/check_queries.py [sf] [name ...]."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(canonical(r[i]) for i in order) for r in rows], key=lambda t: [str(v) for v in t])


def compare(df, con, sql: str) -> str:
    """'' when equal, else the first difference."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {d[0]: str(d[1]).lower() for d in res.description}
    same = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean"}
    for name, kind in df.dtypes:
        if same.get(kind, kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(names)}: {g} != {w}"
    return ""


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from odoscore.session import get_spark

    sf_dir = f"/root/testdata/{argv[0] if argv else 'sf0.01'}"
    spark = get_spark("check", master="local[8]", extra={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            verdict = compare(df, con, checks[name]) if name in checks else f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        good = verdict == "" or verdict.startswith("rows only")
        bad += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
