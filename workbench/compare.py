"""Run queries beside their SQL twins and compare every row.

    python -m workbench.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from tallyspark.session import local_session
from workbench.lake import drop_lakes
from workbench.registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    return f"{type(value).__name__}:{value}"


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted(tuple(_plain(row[at]) for at in order) for row in rows)


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None when equal, else what differs first."""
    frame = QUERIES[name](spark, folder)
    columns = frame.columns
    mine = _sorted_rows(columns, frame.collect())
    if name not in ORACLES:
        return None
    result = connection.execute(ORACLES[name])
    their_columns = [part[0] for part in result.description]
    if sorted(columns) != sorted(their_columns):
        return f"columns {sorted(columns)} against {sorted(their_columns)}"
    theirs = _sorted_rows(their_columns, result.fetchall())
    if len(mine) != len(theirs):
        extra = sorted(set(mine) - set(theirs))[:2], sorted(set(theirs) - set(mine))[:2]
        return f"{len(mine)} rows against {len(theirs)}: {extra}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows: {wrong[0]}" if wrong else None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    drop_lakes(spark)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
