"""Intermediate tables in the shared folder of the cluster."""

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


def scratch_root(spark: SparkSession) -> str:
    """The folder of this session's intermediate tables, for every master alike.

    It lies in the folder named by ``spark.checkpoint.dir`` or, without that
    setting, in the session's warehouse: both are reachable by every executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/feedmill-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes in memory, about; texts and lists by their real lengths."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 16
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
        size = F.size(value) * 8 + 16
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(value.alias("v")))) + 16
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("bigint"), F.lit(8).cast("bigint"))


def size_of_rows(df: DataFrame) -> list[Column]:
    """Aggregates ``n`` and ``bytes``: the rows and the sum of their real widths."""
    width = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(16).cast("bigint"))
    return [F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")]


def materialised(df: DataFrame, name: str = "table", codec: str | None = None, sized: bool = False) -> DataFrame:
    """``df`` written once as Parquet (``codec``: another compression than the session's) and read back.

    Cuts the lineage like a checkpoint, computes ``df`` a single time, survives
    the loss of any executor, and later readers still prune columns.  With ``sized`` rows and
    widths are added up while it is written, so that whoever joins it need not (see :func:`known_size`).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation() if sized else None
    watched = df.observe(seen, *size_of_rows(df)) if sized else df
    writer = watched.write.option("compression", codec) if codec else watched.write
    writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    if sized:
        back._written_size = (seen.get["n"], seen.get["bytes"] or 0)
    return back


def known_size(df: DataFrame) -> tuple[int, int] | None:
    """(rows, bytes) of a table written with ``sized``, or bounds from :func:`no_larger`; else None."""
    return vars(df).get("_written_size")


def no_larger(derived: DataFrame, source: DataFrame) -> DataFrame:
    """``derived``, known to have no more rows than ``source`` and none that is wider."""
    if known_size(source):
        derived._written_size = known_size(source)
    return derived


def _delete(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def discard(table: DataFrame) -> None:
    """Delete a table made by :func:`materialised` when everything computed from it is written as well."""
    root = scratch_root(table.sparkSession)
    for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        if f"/{root.rsplit('/', 1)[1]}/" in path:
            _delete(table.sparkSession, path)


def remove_scratch(spark: SparkSession) -> bool:
    """Delete every intermediate table of this session; results still to be computed from them are lost."""
    return _delete(spark, scratch_root(spark))
