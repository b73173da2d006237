"""Runs every registered query and its DuckDB statement and compares the rows.

Usage: python tests/check_against_duckdb.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from souk.session import local_session  # noqa: E402


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def difference(spark_df, con, sql: str) -> str | None:
    """What differs between the two results, or None. Rows are compared without order."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    expected = result.fetchall()
    order = sorted(range(len(names)), key=names.__getitem__)
    left = sorted((repr(tuple(row[names[i]] for i in order)) for row in spark_df.collect()))
    right = sorted(repr(tuple(row[i] for i in order)) for row in expected)
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    unlike = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(unlike)} of {len(left)} rows, first {unlike[0]}" if unlike else None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    con, sql, queries = duck(folder), contract.oracle_sql(), contract.queries()
    wrong = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            problem = difference(df, con, sql[name]) if name in sql else "no SQL"
        except Exception as e:  # keep going, the summary counts it
            problem = f"{type(e).__name__}: {str(e)[:500]}"
        wrong += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
    print(f"{wrong} differ")
    sys.exit(bool(wrong))


if __name__ == "__main__":
    main()
