"""Spark-vs-DuckDB parity check, shaped like the driver's: column names sorted,
row count, then an order-insensitive comparison of the values."""

from __future__ import annotations

import datetime as _dt
import math

import duckdb
import pandas as pd

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), digits)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, _dt.date):
        return _dt.datetime(v.year, v.month, v.day)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def rows_of(pdf: pd.DataFrame, digits: int = 6) -> list[tuple]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    out = [tuple(_norm(v, digits) for v in r) for r in pdf.itertuples(index=False)]
    return sorted(out, key=repr)


def compare(spark_df, con, sql: str, digits: int = 6) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    res = {"spark_rows": len(s), "oracle_rows": len(d),
           "spark_cols": sorted(s.columns), "oracle_cols": sorted(d.columns)}
    res["cols_match"] = res["spark_cols"] == res["oracle_cols"]
    res["rows_match"] = len(s) == len(d)
    if res["cols_match"] and res["rows_match"]:
        a, b = rows_of(s, digits), rows_of(d, digits)
        res["values_match"] = a == b
        if not res["values_match"]:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            res["first_diffs"] = diff
    else:
        res["values_match"] = False
    return res
