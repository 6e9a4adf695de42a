"""Run registered queries next to their SQL twins and compare all values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark, folder: str, name: str, queries, oracle, connection) -> str | None:
    """What differs between a query and its twin; None if nothing does."""
    df = queries[name](spark, folder)
    ours = _rows(df.columns, df.collect())
    cursor = connection.execute(oracle[name])
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"{str(a)[:600]} != {str(b)[:600]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries
    from gleaner.session import local_session

    folder = sys.argv[1]
    session, twins, known = local_session(8), oracle_sql(), queries()
    connection = connect(folder)
    for name in sys.argv[2:] or known:
        start = time.time()
        if name not in twins:
            print(f"{name}: no twin, {known[name](session, folder).count()} rows", flush=True)
            continue
        try:
            result = difference(session, folder, name, known, twins, connection)
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{name}: {result or 'ok'} ({time.time() - start:.1f}s)", flush=True)
