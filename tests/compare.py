"""Run queries and their SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def _kind(name: str) -> str:
    name = name.lower().replace(" ", "")
    return {
        "varchar": "string", "long": "bigint", "integer": "int", "timestamp_ntz": "timestamp", "hugeint": "bigint",
    }.get(name, name)


def spark_side(df):
    columns = sorted(df.columns)
    types = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    return columns, types, Counter(tuple(_plain(row[c]) for c in columns) for row in df.collect())


def duckdb_side(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: _kind(str(d[1])) for d in cursor.description}
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    return sorted(names), types, rows


def differences(df, con, sql) -> list[str]:
    """Empty when columns, types and rows agree."""
    columns, types, rows = spark_side(df)
    other_columns, other_types, other_rows = duckdb_side(con, sql)
    found = []
    if columns != other_columns:
        return [f"columns {columns} != {other_columns}"]
    found += [f"type of {c}: {types[c]} != {other_types[c]}" for c in columns if types[c] != other_types[c]]
    if rows != other_rows:
        found.append(f"rows {sum(rows.values())} != {sum(other_rows.values())}")
        found += [f"only spark: {r}" for r in list((rows - other_rows))[:3]]
        found += [f"only duckdb: {r}" for r in list((other_rows - rows))[:3]]
    return found
