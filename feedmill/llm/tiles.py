"""Integer vectors in blocks of bounded size, and the cells that bring two blocks together."""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmill.operators.ordering import dense_index
from feedmill.operators.storage import materialised

SCALE = 256
BLOCK_ROWS = 16_384  # a block is held in memory by one task
LEAST_ROWS = 64


def quantised(df: DataFrame, id_col: str, vector_col: str, **others: Column) -> DataFrame:
    """(id, ``others``, v): each component x of a vector as the whole number floor(256 * x), x as double.

    Rows without an id or a vector, and those with a null or non-finite component, are left out.
    A component too large for a long is an error.  No other column is looked at.
    """
    vector = F.col(f"`{vector_col}`")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))

    def whole(x):
        scaled = x.cast("double") * SCALE
        error = F.raise_error(F.lit("a vector component is too large for a long")).cast("bigint")
        return F.when(F.abs(scaled) < 2.0**62, F.floor(scaled).cast("bigint")).otherwise(error)

    kept = df.where(F.col(f"`{id_col}`").isNotNull() & vector.isNotNull() & ~bad)
    return kept.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), *[c.alias(n) for n, c in others.items()], F.transform(vector, whole).alias("v"))


def rows_of_a_block(spark: SparkSession, n: int) -> int:
    """Rows of a block: bounded, and few enough that every core has work on a small table."""
    return min(BLOCK_ROWS, max(LEAST_ROWS, -(-n // (2 * spark.sparkContext.defaultParallelism))))


def blocked(rows: DataFrame, order: list[str], name: str, block_rows: int, group: str | None = None) -> tuple[DataFrame, int]:
    """(table (``name``, lo, hi, ``name``_items), number of blocks) of ``rows`` cut in ``order``.

    Every block holds its rows as structs with their ``place`` in the whole order; ``lo`` and
    ``hi`` bound the values of ``group`` in it.  Places come from range partitions, so no task sees more than its range.
    """
    placed = dense_index(rows, [F.col(c) for c in order], "place")
    item = F.struct("place", *rows.columns)
    low, high = (F.min(group), F.max(group)) if group else (F.lit(0), F.lit(0))
    packed = placed.groupBy(F.expr(f"place div {block_rows}").alias(name)).agg(
        low.alias("lo"), high.alias("hi"), F.sort_array(F.collect_list(item)).alias(f"{name}_items")
    )
    packed = materialised(packed, f"blocks-{name}")
    return packed, packed.count()


def cells(groups: DataFrame, blocks: DataFrame, n_blocks: int, keep: Callable[[DataFrame], DataFrame], compute, schema: str) -> DataFrame:
    """What ``compute`` gives for each kept pair of a group ``g`` and a block ``b``, one pair in a task's memory at a time.

    The pairs are chosen on rows of a few numbers (``lo`` and ``hi`` of the group, ``b_lo`` and
    ``b_hi`` of the block); only kept pairs get their vectors.  ``compute`` maps the items of both to an Arrow table.
    """
    spark = groups.sparkSession
    every = groups.select("g", "lo", "hi").withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
    bounds = blocks.select("b", F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    pairs = keep(every.join(bounds, "b")).select("g", "b")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = pairs.join(groups.select("g", "g_items"), "g").repartition(parts, "g", "b")
    right = pairs.join(blocks.select("b", "b_items"), "b").select(F.col("g").alias("_g"), F.col("b").alias("_b"), "b_items")
    right = right.repartition(parts, "_g", "_b")

    def run(group, block):
        return compute(Items(group.column("g_items")), Items(block.column("b_items")))

    return left.groupBy("g", "b").cogroup(right.groupBy("_g", "_b")).applyInArrow(run, schema)


class Items:
    """The rows of one block as arrays."""

    def __init__(self, column: pa.ChunkedArray):
        self.rows = pa.concat_arrays([c.flatten() for c in column.chunks])

    def field(self, name: str) -> np.ndarray:
        return self.rows.field(name).to_numpy(zero_copy_only=False)

    def lists(self, name: str) -> list:
        return self.rows.field(name).to_pylist()

    def matrix(self) -> np.ndarray:
        """The vectors as rows of whole numbers; shorter ones end in zeros."""
        v = self.rows.field("v")
        lengths = np.diff(v.offsets.to_numpy())
        values = v.flatten().to_numpy(zero_copy_only=False)
        out = np.zeros((len(v), int(lengths.max(initial=0))), np.int64)
        out[np.arange(out.shape[1]) < lengths[:, None]] = values
        return out


def largest_component(a: np.ndarray) -> int:
    """The size of the largest component of ``a``."""
    return max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0))))


def largest_product(a: np.ndarray, b: np.ndarray) -> int:
    """A bound on the size of every inner product of rows of ``a`` and ``b``."""
    return largest_component(a) * largest_component(b) * max(1, min(a.shape[1], b.shape[1]))


def as_long(scores: np.ndarray) -> np.ndarray:
    """Python integers as 64-bit ones; a score that does not fit is an error."""
    if scores.size and not -(1 << 63) <= min(scores.flat) <= max(scores.flat) < 1 << 63:
        raise OverflowError("an inner product does not fit a long")
    return scores.astype(np.int64)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices with the columns that both have: beyond them every product is zero."""
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def first_by_score(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id, best first."""
    if len(scores) > 4 * k:
        among = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return among[np.lexsort((ids[among], ~scores[among]))[:k]]
    return np.lexsort((ids, ~scores))[:k]
