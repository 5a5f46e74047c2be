"""The memory of a task does not grow with the tables: more lines are dealt to more partitions."""

import pytest
from pyspark.sql import functions as F

from feedmill.operators import skew
from feedmill.operators.limits import LIMITS
from feedmill.operators.storage import size_of_rows
from feedmill.plans import tables as D
from feedmill.plans.oracles import ORACLES
from feedmill.plans.queries import QUERIES
from tests.compare import assert_same, connect
from tests.conftest import SMALL


@pytest.fixture(params=["orders broadcast", "orders shuffled", "hot orders apart"])
def small_partitions(request, monkeypatch):
    monkeypatch.setattr(LIMITS, "partition_rows", 300)
    if request.param != "orders broadcast":
        monkeypatch.setattr(LIMITS, "broadcast_max_rows", 20)
    if request.param == "hot orders apart":
        monkeypatch.setattr(LIMITS, "hot_min_rows", 5)
        monkeypatch.setattr(LIMITS, "hot_share", 0.001)


def test_a_task_holds_a_bounded_number_of_lines(spark, small_partitions):
    lines = D.table(spark, SMALL, "lineitem").count()
    parts = skew.parts_of(spark, lines)
    assert parts == -(-lines // 300) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    if LIMITS.hot_min_rows == 5:
        return  # hot orders are dealt by order and article together
    for rows in (D.items(spark, SMALL), D.id_pairs(spark, SMALL)):
        per_task = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(per_task) >= 0.9 * parts
        assert max(r["count"] for r in per_task) < 3 * 300


def test_a_task_numbers_a_bounded_number_of_clicks(spark, small_partitions):
    parts = skew.parts_of(spark, D.table(spark, SMALL, "lineitem").count())
    numbered = D.history_rows(spark, SMALL).where("hist_pos > 0")  # else Spark leaves the numbering out
    per_task = numbered.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert 0.9 * parts <= len(per_task) <= parts
    assert max(r["count"] for r in per_task) <= 300


def test_small_tables_keep_the_partitions_of_the_session(spark):
    assert skew.parts_of(spark, D.table(spark, SMALL, "lineitem").count()) is None


@pytest.mark.parametrize("name", ["npratio", "binary_labels", "history_positions", "map_ids_drop"])
def test_same_results(spark, small_partitions, name):
    assert_same(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name])


@pytest.mark.parametrize(
    "name",
    ["softmax_scores", "filter_min_candidates", "paged_behaviors", "remove_positives", "sample_with_replacement", "sample_without_replacement", "scan_behaviors"],
)
def test_same_results_of_records(spark, small_partitions, name):
    assert_same(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name])


def test_a_wide_lookup_table_is_not_broadcast(spark, monkeypatch):
    wide = spark.range(100).select("id", F.array_repeat(F.lit(1.0), 50).alias("v"))
    size = wide.agg(*size_of_rows(wide)).first()["bytes"]
    monkeypatch.setattr(LIMITS, "lookup_max_bytes", size)
    assert skew.small_enough(wide)
    monkeypatch.setattr(LIMITS, "lookup_max_bytes", size - 1)
    assert not skew.small_enough(wide)
