"""Runs registered queries against their SQL on DuckDB.

    python tests/check.py [sf] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

DATA = "/root/testdata"


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        if isinstance(v, list):
            return str([cell(x) for x in v])
        return str(v)

    return ([columns[i] for i in order],
            sorted(tuple(cell(r[i]) for i in order) for r in rows))


def compare(spark, con, query, sql, sf_dir):
    """Empty string when equal, else a short description of the difference."""
    start = time.time()
    df = query(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    compare.spark_secs = time.time() - start
    if sql is None:
        return "" if got[1] else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = [str(d[1]) for d in cur.description]
    want = canonical(names, cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN"}
    for n, kind in zip(names, kinds):
        want_kind = same.get(spark_kinds[n])
        if want_kind and want_kind != kind.upper() and kind.upper() not in ("STRING", "NUMBER"):
            return f"type of {n}: {spark_kinds[n]} vs {kind}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(want[1])} rows differ, e.g. {bad[0]}"
    return "" if want[1] else "both empty"


compare.spark_secs = 0.0


def main():
    import __spark_entry__ as registry
    from oreline.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    spark = local_session()
    con = connect(sf)
    queries, sqls = registry.queries(), registry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(spark, con, queries[name], sqls.get(name), f"{DATA}/{sf}")
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(problem)
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:32s} {compare.spark_secs:6.2f}s of {time.time() - start:6.2f}s "
              f"{problem}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
