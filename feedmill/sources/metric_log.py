"""Metric logs: headerless CSV files of (epoch, ignored, value)."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_metric_log(spark: SparkSession, path: str, metric: str) -> DataFrame:
    """Columns are named by position: ``epoch``, ``ignore`` and the metric."""
    schema = T.StructType(
        [
            T.StructField("epoch", T.LongType()),
            T.StructField("ignore", T.StringType()),
            T.StructField(metric, T.DoubleType()),
        ]
    )
    return spark.read.schema(schema).csv(path, header=False)


def write_metric_log(df: DataFrame, path: str, metric: str, mode: str = "error") -> None:
    df.select("epoch", "ignore", metric).write.mode(mode).csv(path, header=False)


def metric_curves(training: DataFrame, validation: DataFrame, metric: str) -> DataFrame:
    """Both curves stacked, tagged ``Training`` / ``Validation``, with the largest epoch."""
    both = training.withColumn("set", F.lit("Training")).unionByName(
        validation.withColumn("set", F.lit("Validation"))
    )
    last = both.agg(F.max("epoch"))
    return both.select("epoch", metric, "set", last.scalar().alias("max_epoch"))
