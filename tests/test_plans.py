"""What the physical plans must and must not contain."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from feedmill.plans.queries import QUERIES
from feedmill.operators import attention as A
from feedmill.operators import rows as R
from feedmill.operators import skew
from feedmill.operators.storage import known_size, materialised, no_larger, scratch_path
from feedmill.plans import tables as D
from tests.conftest import SMALL

VECTOR_QUERIES = {
    "attention_pool", "attention_pool_masked", "self_attention", "self_attention_causal",
    "self_attention_lengths", "article_vectors",
}
# These read files they wrote or train a model; their plans show only the last step.
EAGER = {"train_click_model"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(q(spark, SMALL)) for n, q in QUERIES.items() if n not in EAGER}


def test_no_cross_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_python_runs_only_for_vectors_and_once(plans):
    for name, text in plans.items():
        assert "BatchEvalPython" not in text.replace("ArrowEvalPython", ""), name
        assert text.count("ArrowEvalPython") == (1 if name in VECTOR_QUERIES else 0), name


def test_windows_have_groups(plans):
    """A window over the whole table appears only above per-partition counts."""
    for name, text in plans.items():
        for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", text):
            first = spec.split(",")[0].strip()
            if first.startswith("_part#") and "ASC" in first:
                continue  # offsets of dense_index: one row per partition
            if name == "build_vocabulary" or name.startswith("encode_text") or name == "article_vectors":
                continue  # numbers the bounded vocabulary
            assert "ASC" not in first and "DESC" not in first, (name, spec)


@pytest.mark.parametrize(
    "name", ["binary_labels", "negative_sampling_shuffled", "candidate_rows", "rank_scores", "softmax_scores", "npratio"]
)
def test_one_shuffle_per_impression_query(plans, name):
    assert plans[name].count("Exchange hashpartitioning") == 1


def test_recent_history_limits_before_the_shuffle(spark):
    text = plan(D.recent_history(spark, SMALL, 5))
    assert text.count("WindowGroupLimit") == 2
    top, bottom = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert "hashpartitioning(user_id" in text[top:bottom]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(D.candidates(spark, SMALL, "train"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", text)
    scan = next(line for line in text.splitlines() if "l_orderkey" in line and "ReadSchema" in line)
    read = scan[scan.index("ReadSchema") :]
    assert "l_returnflag" in read and "l_extendedprice" not in read and "l_tax" not in read


def test_sample_is_a_filter(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert "Exchange" not in plan(R.sample_exact(df, 0.3, ["k"]))
    assert "Exchange" not in plan(R.sample_by_hash(df, 0.3, ["k"]))


def test_lookup_join_ways(spark, tiny_limits):
    left = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tiny_limits.hot_min_rows, tiny_limits.hot_share = 500, 0.1
        split = skew.lookup_join(left, right, "k")
        assert "SortMergeJoin" in plan(split) and "BroadcastHashJoin" in plan(split)
        assert "BroadcastHashJoin" not in plan(skew.lookup_join(left, right, "k", hot_from=right))
        tiny_limits.broadcast_max_rows = 5000
        small = skew.lookup_join(left, right, "k")
        assert "SortMergeJoin" not in plan(small)
        for df in (split, small):
            assert df.count() == 3000 and df.where("v <> k * 2 or v is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="full"):
        skew.lookup_join(left, right, "k", "full")


def test_results_do_not_depend_on_partitioning(spark):
    names = ["negative_sampling_shuffled", "shuffle_rows", "sample_fraction_exact", "batch_assignment", "user_vectors"]

    def run():
        return {n: sorted(map(tuple, QUERIES[n](spark, SMALL).collect())) for n in names}

    before = run()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert run() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_scratch_tables_go_to_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_without_a_key_are_not_shuffled(spark, tiny_limits):
    """Three of four keys are missing: every partition of the join gets its share of the others alone."""
    left = spark.range(4000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), "id")
    right = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    tiny_limits.hot_min_rows = 1 << 30
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(key, value)
    try:
        joined = skew.lookup_join(left, right, "k")
        assert "SortMergeJoin" in plan(joined)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 800
        assert joined.where("k is null and v is not null").count() == 0
        assert joined.where("v = k * 2").count() == 1000
        assert skew.lookup_join(left, right, "k", "inner").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_wide_rows_are_measured_before_a_broadcast(spark, monkeypatch):
    histories = spark.range(50).select("id", F.sequence(F.lit(1), F.lit(20_000)).alias("ids"))
    monkeypatch.setattr(skew.LIMITS, "broadcast_max_bytes", 4 << 20)
    assert not skew.small_enough(histories) and skew.small_enough(histories.select("id"))
    assert not skew.small_enough(spark.range(50).select(F.repeat(F.lit("x"), 200_000).alias("t")))


def test_predictions_read_the_lines_once(spark):
    text = plan(QUERIES["attach_scores"](spark, SMALL))
    assert len(re.findall(r"FileScan parquet \[l_orderkey", text)) == 1
    assert "rangepartitioning" not in plan(QUERIES["loss_listwise"](spark, SMALL))


def _jobs(spark, run):
    """How many Spark jobs ``run`` starts, and what it gives."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), result


def test_written_tables_are_not_counted_again(spark):
    """Sizes come with the write: joins of both vector tables plan without a job of their own."""
    keys = spark.range(100)
    users = materialised(keys.select(F.col("id").alias("user_id"), F.array(F.lit(0.5), F.lit(1.0)).alias("vec")), "u", sized=True)
    articles = materialised(keys.select(F.col("id").alias("article_id"), F.array(F.lit(2.0), F.lit(0.5)).alias("vec")), "a", sized=True)
    assert known_size(users) == (100, 100 * (16 + 8 + 32))
    rows = keys.select(F.col("id").alias("user_id"), F.col("id").alias("article_id"))
    n, scored = _jobs(spark, lambda: A.click_scores(rows, users, articles, 2))
    assert n == 0 and scored.agg(F.sum("score")).first()[0] == 150.0
    empty = materialised(users.limit(0), "e", sized=True)
    assert known_size(empty) == (0, 0) and skew.small_enough(empty)


def test_a_known_size_beyond_the_bound_is_not_broadcast(spark, tiny_limits):
    keys = spark.range(100).withColumnRenamed("id", "k")
    written = materialised(keys, "k", sized=True)
    assert not skew.small_enough(written) and not skew.small_enough(no_larger(written.select("k"), written))
