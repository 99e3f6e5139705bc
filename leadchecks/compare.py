"""Runs every query in Spark and its SQL in DuckDB, and compares the rows.

Usage: python -m leadchecks.compare [data folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

from leadchecks.oracle import ORACLE
from leadchecks.queries import ALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _rows(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> dict:
    """Row counts, and whether columns and values agree."""
    started = time.time()
    df = ALL[name](spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    result = {"name": name, "rows": len(ours), "seconds": round(seconds, 2)}
    if name in ORACLE:
        cursor = connection.execute(ORACLE[name])
        columns = [d[0] for d in cursor.description]
        theirs = _rows(columns, cursor.fetchall())
        result["columns_equal"] = sorted(columns) == sorted(df.columns)
        result["oracle_rows"] = len(theirs)
        result["equal"] = result["columns_equal"] and ours == theirs
        if not result["equal"]:
            extra, missing = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
            result["only_spark"], result["only_sql"] = extra[:2], missing[:2]
    return result


if __name__ == "__main__":
    from leadchecks.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(ALL)
    session, db = local_session("compare"), connect(folder)
    bad = 0
    for query in names:
        try:
            outcome = compare(session, db, folder, query)
        except Exception as error:  # report and go on with the next query
            outcome = {"name": query, "equal": False, "error": str(error)[:1500]}
        bad += outcome.get("equal") is False or not outcome.get("rows")
        print(outcome, flush=True)
    print("differing or empty:", bad)
