"""Comparing Spark's rows with DuckDB's."""

import datetime
import decimal
import glob
import math
import os

import duckdb


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return "NaN" if math.isnan(v) else repr(round(float(v), 6) + 0.0)
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return "[" + ",".join(map(plain, v)) + "]"
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{plain(x)}" for k, x in v.items()) + "}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def same_rows(df, con, sql):
    names = sorted(df.columns)
    relation = con.sql(sql)
    assert sorted(relation.columns) == names
    at = [relation.columns.index(n) for n in names]
    theirs = sorted("|".join(plain(row[k]) for k in at) for row in relation.fetchall())
    ours = sorted("|".join(plain(row[n]) for n in names) for row in df.collect())
    assert ours == theirs
