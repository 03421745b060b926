"""Compares a query's rows with DuckDB's, regardless of row and column order."""

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql):
    """None if both give the same columns and the same rows, else what differs."""
    result = con.sql(sql)
    columns = list(result.columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    ours = _bag(df.columns, df.collect())
    theirs = _bag(columns, result.fetchall())
    if ours == theirs:
        return None
    return (
        f"{ours.total()} rows, {theirs.total()} expected; extra {list((ours - theirs).items())[:3]}, "
        f"missing {list((theirs - ours).items())[:3]}"
    )
