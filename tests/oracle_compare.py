"""Run a catalog query in Spark and its SQL in DuckDB; compare row count,
column names and an order-insensitive value multiset."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v if isinstance(v, (int, str, bool)) else str(v)


def canon(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, name: str, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = duck(sf_dir).sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    res = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
    }
    res["values_match"] = res["columns_match"] and canon(s_cols, s_rows) == canon(d_cols, d_rows)
    if res["columns_match"] and not res["values_match"]:
        a, b = set(canon(s_cols, s_rows)), set(canon(d_cols, d_rows))
        res["only_spark"] = sorted(a - b, key=str)[:3]
        res["only_oracle"] = sorted(b - a, key=str)[:3]
    elif not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    return res
