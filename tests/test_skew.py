"""One order, one part and one customer each hold a third of the rows or more."""

import pytest
from pyspark.sql import functions as F

from feedmill.plans.oracles import ORACLES
from feedmill.plans.queries import QUERIES
from feedmill.operators import skew
from tests.compare import assert_same, connect
from tests.conftest import SMALL

TABLES = ["customer", "part", "embeddings", "documents", "events"]

HOT_USER, HOT_PART = 7, 9


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables, bent: see the module docstring."""
    root = tmp_path_factory.mktemp("skewed")

    def read(name):
        return spark.read.parquet(f"{SMALL}/{name}.parquet")

    for name in TABLES:
        read(name).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    orders, lines = read("orders"), read("lineitem")
    train = (F.col("o_orderdate") >= "1998-01-01") & (F.col("o_orderdate") < "2000-01-01")
    hot_order = orders.where(train).agg(F.min("o_orderkey")).first()[0]
    third = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0
    bent = orders.withColumn("o_custkey", F.when(third, HOT_USER).otherwise(F.col("o_custkey")).cast("bigint"))
    bent.coalesce(1).write.parquet(f"{root}/orders.parquet")
    pick = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"), F.lit(3))
    lines.select(
        F.when(pick == 0, hot_order).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        F.when(pick == 1, HOT_PART).otherwise(F.col("l_partkey")).alias("l_partkey"),
        *lines.columns[2:],
    ).coalesce(1).write.parquet(f"{root}/lineitem.parquet")
    return str(root)


def test_hot_keys_are_found(spark, skewed, tiny_limits):
    tiny_limits.hot_min_rows, tiny_limits.hot_share = 500, 0.1
    lines = spark.read.parquet(f"{skewed}/lineitem.parquet")
    assert skew.hot_keys(lines, "l_partkey") == [HOT_PART]
    assert skew.largest_group(lines, ["l_partkey"]) > 1500


@pytest.mark.parametrize(
    "name",
    ["scan_history", "binary_labels", "negative_sampling_shuffled", "behaviors_with_history",
     "impressions_with_clicks", "clicks_with_impressions", "impressions_and_clicks", "map_ids_fill", "map_ids_drop", "map_ids_keep", "loss_batch", "embedding_lookup", "click_scores"],
)
def test_query_on_skewed_tables(spark, skewed, tiny_limits, name):
    tiny_limits.group_max_rows = tiny_limits.list_max_items = 50
    assert_same(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name])


@pytest.mark.parametrize("name", ["negative_sampling", "candidate_rows"])
def test_query_on_skewed_tables_within_the_bounds(spark, skewed, name):
    assert_same(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name])
