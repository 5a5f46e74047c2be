"""Global and per-group numbering without pulling a whole order into one task."""

from pyspark.sql import DataFrame, Window, functions as F

from feedmill.operators.skew import fits_a_task, largest_group
from feedmill.operators.storage import materialised

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def ranged(df: DataFrame, order: list) -> DataFrame:
    """``df`` range partitioned and sorted by ``order``, with its partition ``_part`` and row ``_row`` in it.

    Written out, because the range bounds are sampled: the two readers below must
    see one and the same layout.
    """
    row_id = F.monotonically_increasing_id()
    laid_out = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", row_id)
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_place")
    )
    return materialised(laid_out, "ranged")


def dense_index(df: DataFrame, order: list, name: str, start: int = 0) -> DataFrame:
    """Number the rows 0,1,2,... (plus ``start``) in ``order``, which must be unique.

    Two levels: a row number within each range partition, plus the number of rows
    in the partitions before it.  Only the per-partition counts meet in one task.
    """
    laid_out = ranged(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        laid_out.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_row") + F.col("_before") + F.lit(start).cast("bigint"))
        .drop("_part", "_row", "_before")
    )


def running_sum(df: DataFrame, order: list, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all earlier rows in ``order`` (unique), the row itself excluded."""
    laid_out = ranged(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy("_part")
        .agg(F.sum(value).alias("_s"))
        .select("_part", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        laid_out.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_part", "_row", "_inside", "_before")
    )


def number_within(
    df: DataFrame,
    group: list[str],
    order: list,
    name: str,
    start: int = 1,
    largest: int | None = None,
) -> DataFrame:
    """Number the rows of each group in ``order`` (unique within the group), from ``start``.

    ``largest`` is a known bound on the group size; without it the sizes are
    counted.  Groups that fit a task are numbered by a window.  Otherwise the
    rows are range partitioned by (group, order), so that a big group spans many
    tasks, and each piece is offset by the rows of its group in earlier pieces.
    """
    if largest is None:
        largest = largest_group(df, group)
    shift = F.lit(start - 1)
    if fits_a_task(largest):
        numbered = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        return df.withColumn(name, (numbered + shift).cast("bigint"))
    laid_out = ranged(df, [F.col(g) for g in group] + list(order))
    pieces = laid_out.groupBy("_part", *group).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    keys = ["_part", *group]
    return (
        laid_out.join(offsets, keys)
        .withColumn(name, (F.col("_row") - F.col("_first") + F.col("_before") + 1 + shift).cast("bigint"))
        .drop("_part", "_row", "_first", "_before")
    )


def first_within(df: DataFrame, group: list[str], order: list, n: int, name: str) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, numbered from 1.

    Spark limits each group before the shuffle (WindowGroupLimit), so a big group
    sends at most ``n`` rows per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).withColumn(name, F.col("_rank").cast("bigint")).drop("_rank")
