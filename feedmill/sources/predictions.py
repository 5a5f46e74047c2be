"""Prediction files: one line ``<impression id> [v1,v2,...]`` per impression."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmill.functions.lists import fail
from feedmill.operators.limits import LIMITS

# The codecs Spark's text writer knows.
CODECS = ("none", "gzip", "bzip2", "lz4", "snappy", "deflate")


def prediction_line(impression_id: Column, values: Column) -> Column:
    """``<impression id> [v1,v2,...]``; a missing value or list is an error that names the impression.

    The format wants all values of an impression in one line, so they are one record: more than
    LIMITS.line_max_values of them are an error as well.
    """
    name = impression_id.cast("string")
    line = F.concat(name, F.lit(" ["), F.array_join(values.cast("array<string>"), ","), F.lit("]"))
    complete = values.isNotNull() & ~F.exists(values, lambda v: v.isNull())
    missing = fail(F.lit("a prediction is missing for impression "), F.coalesce(name, F.lit("null")))
    long = fail(F.lit(f"more than {LIMITS.line_max_values} values for one line, impression "), F.coalesce(name, F.lit("null")))
    return F.when(F.size(values) > LIMITS.line_max_values, long).when(complete, line).otherwise(missing)


def value_lists(rows: DataFrame, id_col: str, pos: str, value: str, name: str, largest: int | None = None) -> DataFrame:
    """(``id_col``, ``name``): the values of each impression by position, from one row per candidate.

    ``largest`` is a known bound on the rows of an impression.  Without it, or beyond LIMITS.line_max_values,
    the rows are counted before any list is built, and the first impression with too many is named in the error.
    """
    if largest is None or largest > LIMITS.line_max_values:
        most = rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), id_col).first()
        if most and most["_n"] > LIMITS.line_max_values:
            raise ValueError(f"impression {most[id_col]} has {most['_n']} values, more than {LIMITS.line_max_values} for one line")
    lists = rows.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v")))).alias("_l"))
    return lists.select(id_col, F.transform("_l", lambda t: t["v"]).alias(name))


def write_predictions(
    df: DataFrame, path: str, id_col: str, values_col: str, compression: str = "none", single_file: bool = False
) -> None:
    """Write part files of prediction lines below ``path``.

    ``single_file`` gathers them into one part; leave it off for large results.
    """
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}, not {compression!r}")
    lines = df.select(prediction_line(F.col(id_col), F.col(values_col)).alias("value"))
    if single_file:
        lines = lines.repartition(1)
    lines.write.option("compression", compression).text(path)


_NUMBERS = r"^\[(?:\s*-?[0-9][0-9.eE+-]*\s*(?:,\s*-?[0-9][0-9.eE+-]*\s*)*)?\]$"


def _parsed(spark: SparkSession, path: str, id_col: str, values_col: str) -> DataFrame:
    """(id, values, file, line, reason) of every line; ``reason`` is null for a good one."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    parts = F.split("line", " ", 2)
    rest = F.get(parts, F.lit(1))
    parsed = lines.select(
        F.get(parts, F.lit(0)).try_cast("bigint").alias(id_col),
        F.when(rest.rlike(_NUMBERS), F.from_json(rest, "array<double>")).alias(values_col),
        rest.isNull().alias("_no_list"), "file", "line",
    )
    values = F.col(values_col)
    reason = (
        F.when(F.col(id_col).isNull(), "the id is not a whole number")
        .when(F.col("_no_list"), "there is no list")
        .when(values.isNull() | F.exists(values, lambda v: v.isNull()), "the list does not hold numbers only")
    )
    return parsed.withColumn("reason", reason)


def read_predictions(spark: SparkSession, path: str, id_col: str, values_col: str, strict: bool = True) -> DataFrame:
    """Lines back to (id bigint, values array<double>); compressed parts are recognised.

    A line that is not ``<whole number> [numbers]`` is an error that names file and line, when it is read.  With
    ``strict=False`` such lines are left out: :func:`rejected_lines` gives them.  An empty line is one of them.
    """
    parsed = _parsed(spark, path, id_col, values_col)
    if not strict:
        return parsed.where("reason IS NULL").select(id_col, values_col)
    problem = fail(F.col("reason"), F.lit(" in "), F.col("file"), F.lit(": "), F.substring("line", 1, 200))
    return parsed.select(F.when(F.col("reason").isNull(), F.col(id_col)).otherwise(problem.cast("bigint")).alias(id_col), values_col)


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, reason) of the lines that are no predictions."""
    return _parsed(spark, path, "id", "values").where("reason IS NOT NULL").select("file", "line", "reason")
