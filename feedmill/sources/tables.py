"""Parquet scans of the click-log layout.

``<root>/train``, ``<root>/validation`` and ``<root>/test`` each hold
``behaviors.parquet`` and ``history.parquet``; ``<root>/articles.parquet`` is
shared.  All scans stay lazy, so later column selections and filters reach the
Parquet reader.
"""

from pyspark.sql import DataFrame, SparkSession

from feedmill.schema import HISTORY, USER_ID, check_columns

SPLITS = ("train", "validation", "test")


def scan_history(spark: SparkSession, path: str) -> DataFrame:
    """User and history list, and ``first_pos`` of paged histories, only; the other columns are never read."""
    df = spark.read.parquet(f"{path}/history.parquet")
    check_columns(df, [USER_ID, HISTORY])
    return df.select(USER_ID, HISTORY, *[c for c in df.columns if c == "first_pos"])


def scan_behaviors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/behaviors.parquet")


def scan_articles(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/articles.parquet")


def read_split(spark: SparkSession, root: str, split: str) -> tuple[DataFrame, DataFrame]:
    """(behaviors, history) of one split."""
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, not {split!r}")
    path = f"{root.rstrip('/')}/{split}"
    return scan_behaviors(spark, path), scan_history(spark, path)
