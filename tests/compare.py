"""Run queries against their SQL twins: same columns, same rows, in any order."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = ["lineitem", "labels", "documents"]


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "M" or (df[c].dtype == object and df[c].map(lambda v: hasattr(v, "year")).any()):
            df[c] = pd.to_datetime(df[c]).dt.strftime("%Y-%m-%d")
    return df.sort_values(list(df.columns), ignore_index=True)


def difference(spark: SparkSession, con, query, sql: str, sf_dir: str) -> str | None:
    got, want = query(spark, sf_dir).toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = normal(got), normal(want)
    for c in got.columns:
        if got[c].dtype.kind != want[c].dtype.kind and {got[c].dtype.kind, want[c].dtype.kind} != {"O", "U"}:
            if not (got[c].isna().all() or want[c].isna().all()) and {got[c].dtype.kind, want[c].dtype.kind} & {"i", "f", "b", "u"}:
                return f"{c}: type {got[c].dtype} != {want[c].dtype}"
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{c}: {(~same).sum()} differ, first {got[c][at]!r} != {want[c][at]!r}"
    return None
