"""Spark result against DuckDB result, as multisets of rows."""

import glob
import math
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def _value(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(float(v) + 0.0) if isinstance(v, float) else str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_value(v) for v in r) for r in frame.itertuples(index=False))


def assert_same(spark_df, con, sql):
    left, right = spark_df.toPandas(), con.execute(sql).df()
    assert sorted(left.columns) == sorted(right.columns)
    assert len(left) == len(right)
    types = [(c, left[c].dtype.kind, right[c].dtype.kind) for c in left.columns]
    assert all(a == b for _, a, b in types), types
    assert rows(left) == rows(right)
