"""Joins of tables in which one key holds a third of the rows of both sides."""

import pytest
from pyspark.sql import functions as F

from feedmill.operators import skew
from tests.compare import rows

KINDS = ["inner", "left", "right", "full", "left_semi", "left_anti"]


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(skew.LIMITS, "hot_min_rows", 20)
    monkeypatch.setattr(skew.LIMITS, "hot_share", 0.05)
    monkeypatch.setattr(skew.LIMITS, "hot_cell_rows", 25)
    return skew.LIMITS


def tables(spark):
    """Key 7 is hot on both sides, 8 and 9 on one side only; some keys are null; equal rows repeat."""
    left = [(7, "a", 1)] * 120 + [(8, "b", 2)] * 60 + [(i % 40, f"c{i % 9}", i % 4) for i in range(150)] + [(None, "d", None)] * 30
    right = [(7, 1, "x")] * 90 + [(9, None, "y")] * 50 + [(i % 60, i % 5, f"z{i}") for i in range(120)] + [(None, 4, "w")] * 3
    left = [r for r in left if r[0] not in (9, 59)]
    right = [r for r in right if r[0] != 8]
    l = spark.createDataFrame(left, "k int, v string, w int").repartition(5)
    return l, spark.createDataFrame(right, "k int, v int, t string").repartition(4)


@pytest.mark.parametrize("how", KINDS)
def test_any_join_with_hot_keys(spark, small_cells, how):
    left, right = tables(spark)
    want = left.join(right, "k", how)
    found = skew.join_tables(left, right, "k", how)
    assert found.columns == want.columns
    names = [f"c{i}" for i in range(len(want.columns))]
    assert rows(found.toDF(*names).toPandas()) == rows(want.toDF(*names).toPandas())


@pytest.mark.parametrize("how", KINDS)
def test_several_key_columns(spark, small_cells, how):
    left, right = tables(spark)
    left = left.withColumnRenamed("w", "m")
    right = right.withColumn("m", F.col("v").cast("bigint")).select("m", "t", "k")
    want = left.join(right, ["k", "m"], how)
    found = skew.join_tables(left, right, ["k", "m"], how)
    assert found.columns == want.columns
    assert rows(found.toPandas()) == rows(want.toPandas())


@pytest.mark.parametrize("flip", [False, True])
def test_keys_of_different_types(spark, small_cells, flip):
    """Whole numbers of two widths, one beyond the narrow type."""
    left, right = tables(spark)
    left = left.withColumn("k", F.when(F.col("k") == 8, F.lit(1 << 40)).otherwise(F.col("k").cast("bigint")))
    one, other = (right, left) if flip else (left, right)
    want, found = one.join(other, "k", "full"), skew.join_tables(one, other, "k", "full")
    names = [f"c{i}" for i in range(len(want.columns))]
    assert rows(found.toDF(*names).toPandas()) == rows(want.toDF(*names).toPandas())
    texts = right.withColumn("k", F.col("k").cast("string"))
    assert skew.join_tables(left, texts, "k", "inner").count() == left.join(texts, "k", "inner").count()


@pytest.mark.parametrize("how", KINDS)
def test_empty_sides(spark, small_cells, how):
    left, right = tables(spark)
    for one, other in ((left, right.limit(0)), (left.limit(0), right)):
        assert skew.join_tables(one, other, "k", how).count() == one.join(other, "k", how).count()


def test_no_task_gets_a_hot_key(spark, small_cells):
    """Rows of the largest partition of the join, against those of the plain one."""
    small_cells.hot_cell_rows = 10
    left, right = tables(spark)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)

        def largest(joined):
            counts = joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
            return counts.agg(F.max("n"), F.sum("n")).first()

        most, total = largest(left.join(right, "k", "inner"))
        assert most > 0.9 * total
        most, total = largest(skew.join_tables(left, right, "k", "inner"))
        assert most < 0.12 * total  # 108 cells over 64 partitions, none with more than 100 pairs
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_unknown_kind(spark):
    left, right = tables(spark)
    with pytest.raises(ValueError, match="sideways"):
        skew.join_tables(left, right, "k", "sideways")
