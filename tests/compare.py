"""Runs a query on Spark and its SQL on DuckDB and compares rows, columns by name, order ignored."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(_value(r[k]) for k in order) for r in data)


def difference(spark_df, con, sql: str):
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    actual = rows(spark_df.columns, spark_df.collect())
    if actual == expected:
        return None
    return {
        "rows": (sum(actual.values()), sum(expected.values())),
        "only_spark": list((actual - expected).items())[:3],
        "only_sql": list((expected - actual).items())[:3],
    }
