"""Runs a registered query and its twin on the same files and compares them value by value."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

from tillwork.plans.catalog import comparable  # noqa: F401


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def mismatch(spark_df, db, sql: str, exact: bool = False) -> str | None:
    """None when columns, row count and all values agree; otherwise what differs."""
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    types = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
             "INTEGER": "int", "TIMESTAMP": "timestamp_ntz"}
    kinds = dict(spark_df.dtypes)
    odd = [(d[0], str(d[1]), kinds[d[0]]) for d in cursor.description if types.get(str(d[1]).upper()) != kinds[d[0]]]
    if odd:
        return f"types {odd}"
    actual_rows = [tuple(r) for r in spark_df.collect()]
    if len(actual_rows) != len(expected_rows):
        return f"rows {len(actual_rows)} != {len(expected_rows)}"
    got, want = rows_of(spark_df.columns, actual_rows), rows_of(names, expected_rows)
    if got != want:
        return f"values: extra {list((got - want).items())[:2]} missing {list((want - got).items())[:2]}"
    return None
