"""Run registered queries next to their SQL and compare whole results.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canonical(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "~"
    if hasattr(value, "isoformat"):
        return value.isoformat().removesuffix("T00:00:00")
    if isinstance(value, (list, tuple)):
        return str([_canonical(v) for v in value])
    return repr(value.item() if hasattr(value, "item") else value)


def rows(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canonical(r[i]) for i in order) for r in records)


def differences(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both results hold the same rows, else a short description."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first: {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    import __spark_entry__ as contract
    from tallyloom.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("compare", 8, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracle = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            if name in oracle:
                problem = differences(spark, con, queries[name], oracle[name], sf_dir)
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        note = "" if name in oracle else " (rows only)"
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}{note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
