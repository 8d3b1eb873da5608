"""Compare registered queries with their SQL on the same tables.

Usage: python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# Table names registered as views.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(plain(v) for v in value.values()) + "}"
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, run, sql: str) -> str | None:
    """None if both sides give the same rows, else what differs."""
    df = run(spark, folder)
    mine = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = canonical(df.columns, mine), canonical(names, theirs)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        x, y = wrong[0]
        parts = [(n, p, r) for n, p, r in zip(sorted(names), x, y) if p != r]
        return f"{len(wrong)} of {len(a)} rows differ, first: {str(parts)[:400]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, folder, queries[name], sql[name])
            else:
                problem = None if queries[name](spark, folder).collect() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(names)} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
