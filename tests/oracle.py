"""Compare a Spark result with DuckDB: columns by name, rows as a multiset."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(value):
    if value is None:
        return ("", "")
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("d", str(value))
    return ("s", str(value))


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(canonical(r[i]) for i in order) for r in rows), key=repr
    )


def differences(df, connection, sql: str) -> list[str]:
    """Reasons why the two results are not the same; empty when they are."""
    mine = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    theirs = rows_by_name([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return [f"columns {mine[0]} != {theirs[0]}"]
    if len(mine[1]) != len(theirs[1]):
        return [f"rows {len(mine[1])} != {len(theirs[1])}"]
    return [f"{a} != {b}" for a, b in zip(mine[1], theirs[1]) if a != b]


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tests.conftest import build_session
    from workload.catalog import ORACLES, QUERIES

    directory = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark, connection = build_session(), connect(directory)
    for key, run in QUERIES.items():
        if wanted and not any(w in key for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, directory)
            if key in ORACLES:
                found = differences(df, connection, ORACLES[key])
                verdict = "same" if not found else f"DIFFERENT {len(found)}: " + " | ".join(found[:3])
            else:
                verdict = f"{df.count()} rows, no SQL"
        except Exception as error:  # report and go on
            verdict = f"FAILED {type(error).__name__}: {str(error)[:700]}"
        print(f"{key:32s} {time.time() - start:6.1f}s {verdict}", flush=True)
