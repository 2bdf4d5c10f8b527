"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    if isinstance(v, (bool, str)):
        return str(v)
    if isinstance(v, float):
        v = decimal.Decimal(repr(v))
    if isinstance(v, (int, decimal.Decimal)):
        d = decimal.Decimal(v).normalize()
        return format(d, "f")
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        t = pd.Timestamp(v)
        return t.date().isoformat() if t == t.normalize() else t.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canonical_rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_canon(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    s = spark_df.toPandas()
    d = con.sql(sql).df()
    res = {"spark_rows": len(s), "oracle_rows": len(d),
           "columns_match": sorted(s.columns) == sorted(d.columns)}
    res["values_match"] = res["columns_match"] and canonical_rows(s) == canonical_rows(d)
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s.columns), sorted(d.columns)
    return res
