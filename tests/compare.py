"""Runs a registered query and its checking SQL on the same folder and compares the rows."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def duck(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float | Decimal):
        value = float(value)
        return None if math.isnan(value) else round(value, 6)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_df, con, sql, show=5):
    """Empty when names, row count and values agree, else a description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = canonical(names, result.fetchall())
    actual = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(spark_df.columns)} and {sorted(names)}"
    if actual == expected:
        return ""
    extra = [r for r in actual if r not in set(expected)][:show] if len(actual) < 200000 else []
    lost = [r for r in expected if r not in set(actual)][:show] if len(expected) < 200000 else []
    return f"{len(actual)} and {len(expected)} rows; only here: {extra}; only there: {lost}"
