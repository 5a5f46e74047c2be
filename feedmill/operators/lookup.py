"""Lookup tables: key -> value, dense indexes, matrices with a row for unknown ids."""

from pyspark.sql import DataFrame, functions as F, types as T

from feedmill import schema as S
from feedmill.operators.ordering import dense_index
from feedmill.operators.skew import lookup_join


def lookup_table(df: DataFrame, key: str, value: str, order: list) -> DataFrame:
    """One value per key: that of the last row in ``order``.  Combined before the shuffle."""
    S.check_columns(df, [key, value])
    return df.groupBy(F.col(key).alias("key")).agg(
        F.max_by(F.col(value), F.struct(*order)).alias("value")
    )


def dense_ids(df: DataFrame, key: str, name: str = "id", start: int = 0) -> DataFrame:
    """Distinct keys numbered from ``start`` in key order."""
    S.check_columns(df, [key])
    return dense_index(df.select(key).distinct(), [F.col(key)], name, start)


def lookup_matrix(df: DataFrame, key: str, vector: str, unknown: str = "zeros") -> DataFrame:
    """Rows (idx, key, vector): keys numbered from 1 in key order, plus row 0 for unknown ids.

    Row 0 is all zeros, or the mean of the rows per dimension cast to the
    element type.  Keys must be unique.
    """
    if unknown not in ("zeros", "mean"):
        raise ValueError(f"unknown must be 'zeros' or 'mean', not {unknown!r}")
    S.check_columns(df, [key, vector])
    known = df.select(F.col(key), F.col(vector))
    vector_type = df.schema[vector].dataType
    element = vector_type.elementType
    if unknown == "mean":
        mean = F.avg("x")
        if isinstance(element, T.IntegralType):
            mean = F.signum(mean) * F.floor(F.abs(mean))
        per_dim = (
            known.select(F.posexplode(vector).alias("d", "x")).groupBy("d").agg(mean.cast(element).alias("x"))
        )
        # One value per dimension is left here.
        row0 = per_dim.agg(F.sort_array(F.collect_list(F.struct("d", "x"))).alias("l")).select(
            F.transform("l", lambda t: t["x"]).alias(vector)
        )
    else:
        row0 = known.agg(F.max(F.size(vector)).alias("n")).select(
            F.array_repeat(F.lit(0).cast(element), F.col("n")).alias(vector)
        )
    row0 = row0.select(
        F.lit(0).cast("bigint").alias("idx"), F.lit(None).cast(df.schema[key].dataType).alias(key), vector
    )
    numbered = dense_index(known, [F.col(key)], "idx", start=1).select("idx", key, vector)
    return row0.unionByName(numbered)


def embed(df: DataFrame, column: str, matrix: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """Add ``idx`` and the vector of the id in ``column``; unknown ids get row 0 of the matrix."""
    S.check_columns(df, [column])
    known = matrix.where(F.col("idx") > 0).select(F.col(key).alias(column), "idx", vector)
    row0 = matrix.where(F.col("idx") == 0).select(vector)
    return lookup_join(df, known, column, "left").withColumns(
        {"idx": F.coalesce("idx", F.lit(0).cast("bigint")), vector: F.coalesce(F.col(vector), row0.scalar())}
    )
