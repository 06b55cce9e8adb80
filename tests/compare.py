"""Run catalog queries and their SQL side by side."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Spark type -> accepted DuckDB types.
TYPES = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value) -> str:
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def mismatch(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = query(spark, sf_dir)
    want = con.execute(sql)
    description = [(d[0], str(d[1])) for d in want.description]
    names = [n for n, _ in description]
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    types = dict(description)
    for name, spark_type in got.dtypes:
        accepted = TYPES.get(spark_type, {spark_type.upper()})
        if types[name] not in accepted:
            return f"type of {name}: {spark_type} vs {types[name]}"
    left = rows_of(got.columns, [tuple(r) for r in got.collect()])
    right = rows_of(names, want.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows, expected {len(right)}"
    if left != right:
        wrong = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(wrong)} of {len(left)} rows differ, first: {wrong[0]}"
    return None
