"""Run the registered queries next to their SQL and report differences.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

from checks import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark, con, folder: str, name: str) -> str | None:
    """None if both sides agree on columns and values."""
    df = catalog.queries()[name](spark, folder)
    mine = canonical(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    theirs = canonical(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if mine != theirs:
        first = next(((a, b) for a, b in zip(mine, theirs) if a != b), None)
        return f"rows {len(mine)} / {len(theirs)}; first difference {first}"
    return None


def main() -> int:
    from cadastra.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    con, failed = connect(folder), 0
    for name in args or catalog.queries():
        start = time.time()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.1f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
