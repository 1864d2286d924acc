"""Rows of a Spark result and of DuckDB over the same tables, in one form."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return tuple(map(cell, v)) if isinstance(v, list | tuple) else v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(cell(r[i]) for i in order) for r in found), key=repr)


def same(spark, query, sql, sf_dir, tables=None):
    df = query(spark, sf_dir)
    left = rows(df.columns, df.collect())
    db = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        db.execute(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    got = db.execute(sql)
    right = rows([d[0] for d in got.description], got.fetchall())
    assert left[0] == right[0]
    assert left[1] == right[1]
    return len(left[1])
