"""Columns computed in Python from one column, in bounded slices of Arrow batches."""

import ctypes
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_type

ROWS = 2_000  # rows held as Python objects at a time
SLICE_BYTES = 4 << 20  # and about so many bytes of their texts, or one row
_BATCH_ROWS, _BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Documents are long rows: unless the session says otherwise, a batch has a quarter of Spark's usual rows.

    Workers and executors hold whole batches outside the heap.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "2500")


def small_batches(spark: SparkSession) -> None:
    """As :func:`bounded_batches`, and a batch has about 2 MB, or one row: an executor holds each several times over, in buffers of twice its size."""
    bounded_batches(spark)
    if spark.conf.get(_BATCH_BYTES) == "67108864b":
        spark.conf.set(_BATCH_BYTES, "2m")


_remembered = []


def remembered(load):
    """``load`` with its results kept in a worker until that begins a task of another operator (:func:`begin_task`)."""
    kept = lru_cache(maxsize=4)(load)
    _remembered.append(kept)
    return kept


def begin_task(*used) -> None:
    """Drop what this worker remembers of other loaders than ``used``, and give back what an earlier stage left: Spark keeps workers."""
    for kept in _remembered:
        if kept not in used:
            kept.cache_clear()
    release_memory()


def release_memory() -> None:
    """Give the unused memory of this worker back to the system: Spark keeps workers for the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # freed arrays stay with the C library otherwise
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, rows: int = ROWS, limit: int = SLICE_BYTES):
    """Slices of a batch of at most ``rows`` rows and about ``limit`` bytes of texts, or one row; unused memory is given back."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        held = ends[start - 1] if start else 0
        stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, held + limit, side="right"))))
        yield batch.slice(start, stop - start)
        start = stop
    release_memory()


def with_columns(df: DataFrame, source: str, new: dict[str, T.DataType], values, rows: int = ROWS) -> DataFrame:
    """``df`` with the columns ``new`` after its own.

    ``values`` maps the list of ``source`` values of a slice to one list per new column.
    """
    small_batches(df.sparkSession)
    place = df.columns.index(source)
    names, types = list(new), [to_arrow_type(t) for t in new.values()]

    def run(batches):
        begin_task()
        for batch in batches:
            for part in slices(batch, rows):
                lists = values(part.column(place).to_pylist())
                arrays = [pa.array(v, t) for v, t in zip(lists, types)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*part.schema.names, *names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in new.items()]]))


def by_size(texts: list[str | None], chars: int = 1 << 17):
    """Consecutive texts, about ``chars`` characters or one text at a time."""
    group, held = [], 0
    for text in texts:
        group.append(text or "")
        held += len(group[-1])
        if held >= chars:
            yield group
            group, held = [], 0
    if group:
        yield group
