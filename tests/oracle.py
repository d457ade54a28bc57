"""Compare registered queries with their SQL on the same Parquet tables."""

from __future__ import annotations

import math
import sys
import time
import traceback
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{round(value, 6) + 0.0:.6f}"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def kind(values) -> set[str]:
    return {type(v).__name__ for v in values if v is not None}


def compare(con, frame, sql: str | None):
    """None when equal, else what differs; with the row count."""
    names = frame.columns
    rows = [tuple(r) for r in frame.collect()]
    if sql is None:
        return (None if rows else "no rows"), len(rows)
    found = con.execute(sql)
    other_names = [d[0] for d in found.description]
    other = found.fetchall()
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(set(names) ^ set(other_names))}", len(rows)
    order = sorted(range(len(names)), key=lambda i: names[i])
    other_order = sorted(range(len(names)), key=lambda i: other_names[i])
    mine = [[r[i] for i in order] for r in rows]
    theirs = [[r[i] for i in other_order] for r in other]
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}", len(rows)
    for j, i in enumerate(order):
        a, b = kind(r[j] for r in mine), kind(r[j] for r in theirs)
        if a != b and mine:
            return f"types of {names[i]}: {a} != {b}", len(rows)
    left = sorted([cell(v) for v in r] for r in mine)
    right = sorted([cell(v) for v in r] for r in theirs)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first {[(n, x, y) for n, x, y in zip(sorted(names), *bad[0]) if x != y]}", len(rows)
    return None, len(rows)


def main(sf: str, wanted: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as spark_entry
    from tidemark.session import build_session

    spark = build_session(
        "check",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="10g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    jobs, sqls = spark_entry.queries(), spark_entry.oracle_sql()
    failed = 0
    for name in wanted or jobs:
        start = time.time()
        try:
            problem, n = compare(con, jobs[name](spark, sf_dir), sqls.get(name))
        except Exception as error:  # report and go on
            lines = str(error).strip().splitlines() or [repr(error)]
            problem, n = " | ".join(lines[:4])[:600], -1
            if "-v" in sys.argv:
                traceback.print_exc()
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {n} rows {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(wanted or jobs)}")
    return failed


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "-v"]
    sys.exit(main(args[0], args[1:]) > 0)
