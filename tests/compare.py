"""Runs registered queries next to their SQL and compares the rows regardless of order."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if type(value).__name__ == "Decimal":
        return repr(float(value))
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(con, spark, folder, name, query, sql):
    """(problem or None, rows, seconds)"""
    start = time.time()
    frame = query(spark, folder)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        if unwanted in plan:
            return f"{unwanted} in the plan", 0, time.time() - start
    got_columns, got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    seconds = time.time() - start
    if sql is None:
        return None, len(got), seconds
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_columns, want = _rows(names, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}", len(got), seconds
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows against {len(want)}; only here {extra}; only in SQL {missing}", len(got), seconds
    return None, len(got), seconds


def main(folder: str, wanted: list[str]) -> int:
    from conftest import make_session

    import __spark_entry__ as entry

    spark = make_session()
    con = connect(folder)
    queries, checks = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            problem, rows, seconds = compare(con, spark, folder, name, query, checks.get(name))
        except Exception as error:  # noqa: BLE001
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:1500]}", -1, 0.0
        bad += problem is not None
        state = "BAD " if problem else ("ok  " if name in checks else "rows")
        print(f"{state} {name:32s} rows={rows:<7d} {seconds:6.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parent))
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
