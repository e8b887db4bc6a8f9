"""Compare a query with its SQL on the same files; run as a script over all or some queries."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def sql_rows(data: str, sql: str) -> tuple[list[str], Counter]:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    cursor = db.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), _count(names, cursor.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), _count(df.columns, [tuple(row) for row in df.collect()])


def _count(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    """Types must agree but for the width of a number."""
    if isinstance(value, float) and value == 0:
        return 0.0
    return (type(value).__name__, value)


def difference(spark, data: str, run, sql: str) -> str | None:
    names, want = sql_rows(data, sql)
    have_names, have = spark_rows(run(spark, data))
    if names != have_names:
        return f"columns {have_names} instead of {names}"
    if not want:
        return "no rows to compare"
    if have != want:
        extra, lacking = list((have - want).items()), list((want - have).items())
        return (
            f"{sum(have.values())} rows against {sum(want.values())};"
            f" extra {extra[:2]}; lacking {lacking[:2]}"
        )
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from conftest import new_session

    from tablestream.plans import ORACLES, QUERIES

    folder = sys.argv[1]
    session = new_session()
    failed = 0
    for query in sys.argv[2:] or QUERIES:
        began = time.time()
        try:
            problem = difference(session, folder, QUERIES[query], ORACLES[query])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{query:28} {time.time() - began:6.2f}s {problem or 'ok'}", flush=True)
    print("failed:", failed)
