"""Run catalog queries in Spark and their SQL in DuckDB, and compare every value.

    python tests/compare.py sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.plans import bank_view, catalog  # noqa: E402

DATA = os.environ.get("LEDGERLAKE_TESTDATA", "/root/testdata")


def values(df, *columns):
    """Rows as tuples, in order of their text."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in bank_view.TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if v != v else (0.0 if v == 0 else v)
    if isinstance(v, int):
        return v
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_value(r[i]) for i in order] for r in rows), key=repr)


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None when both sides agree on columns, rows and values."""
    df = catalog.QUERIES[name](spark, folder)
    mine = df.collect()
    cursor = connection.execute(catalog.ANSWERS[name])
    theirs_names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(theirs_names):
        return f"columns {sorted(df.columns)} != {sorted(theirs_names)}"
    a, b = _rows(df.columns, mine), _rows(theirs_names, theirs)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; e.g. {next((x for x in a if x not in b), None)} / {next((x for x in b if x not in a), None)}"
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    if unequal:
        kinds = [(type(p).__name__, type(q).__name__) for p, q in zip(*unequal[0]) if p != q][:3]
        return f"{len(unequal)} of {len(a)} rows differ {kinds}, columns {sorted(df.columns)}: {unequal[0]}"
    return None if a else "no rows"


if __name__ == "__main__":
    from ledgerlake.session import local_session

    catalog.load()
    session = local_session("8")
    where = f"{DATA}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    duck_connection = duck(where)
    bad = 0
    for query_name in sys.argv[2:] or catalog.QUERIES:
        began = time.time()
        try:
            found = difference(session, duck_connection, where, query_name) if query_name in catalog.ANSWERS else "no answer"
        except Exception as error:  # report and go on to the next query
            found = f"{type(error).__name__}: {str(error)[:900]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {time.time() - began:6.2f}s {query_name} {found or ''}", flush=True)
    print(f"{bad} bad")
    sys.exit(bool(bad))
