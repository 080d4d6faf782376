"""Runs registered queries next to their SQL on the same tables and compares the rows.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

from checks.queries import ORACLES, QUERIES
from ledgerloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def canonical(value):
    if value is None or isinstance(value, (str, bool)):
        return repr(value)
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else f"{float(value) + 0.0:.6f}"
    if hasattr(value, "as_tuple"):
        return f"{float(value):.6f}"
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, db, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    left = sorted_rows(frame.columns, frame.collect())
    if name not in ORACLES:
        return None if left[1] else "no rows"
    result = db.execute(ORACLES[name])
    right = sorted_rows([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(wrong)} of {len(left[1])} rows differ, first: {wrong[0]}" if wrong else None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(
        "checks", f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, db, name, sf_dir)
        except Exception:
            problem = traceback.format_exc()[-1500:]
        failed += problem is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - started:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
