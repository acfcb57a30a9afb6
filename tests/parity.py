"""Compare a Spark result with a DuckDB result, order-free, column by name."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def as_multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when both sides agree in columns and in the multiset of rows."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns: spark {sorted(spark_df.columns)} sql {sorted(columns)}"]
    got = as_multiset(spark_df.columns, spark_df.collect())
    want = as_multiset(columns, expected)
    if got == want:
        return []
    extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
    return [f"rows: spark {sum(got.values())} sql {sum(want.values())}", f"only spark: {extra}", f"only sql: {missing}"]
