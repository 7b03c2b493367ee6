"""Order-insensitive comparison of a Spark result with DuckDB's result of the check SQL."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

DATA = Path("/root/testdata")


def connect(folder: Path) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, sql: str, connection) -> list[str]:
    """Problems found; empty when column names, kinds, row counts and values agree."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]).upper() for d in cursor.description}
    expected = rows_of(names, cursor.fetchall())
    found = rows_of(df.columns, [tuple(row) for row in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if name in kinds and same.get(kind) != kinds[name]:
            problems.append(f"column {name}: {kind} != {kinds[name]}")
    if found.total() != expected.total():
        problems.append(f"rows {found.total()} != {expected.total()}")
    if found != expected:
        problems.append(f"only here {list((found - expected).items())[:3]}")
        problems.append(f"only there {list((expected - found).items())[:3]}")
    return problems
