"""Every registered query against its SQL, the usual way and the way for big groups."""

import pytest

import __spark_entry__ as entry
from feedmill.plans.oracles import ORACLES
from feedmill.plans.queries import QUERIES
from tests.compare import assert_same, connect
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_only_training_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"train_click_model"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert_same(QUERIES[name](spark, SMALL), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_beyond_the_bounds(spark, con, tiny_limits, name):
    assert_same(QUERIES[name](spark, SMALL), con, ORACLES[name])


def test_train_click_model(spark):
    report = {r["split"]: r for r in QUERIES["train_click_model"](spark, SMALL).collect()}
    assert set(report) == {"train", "validation", "test"}
    assert all(0 < r["auc"] < 1 and 0 < r["accuracy"] <= 1 for r in report.values())
    # Four of five candidates of a training list are not clicked.
    assert report["train"]["accuracy"] >= 0.79


def test_entry(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"impression_id", "user_id", "history", "pos", "article_id", "label"}
    assert df.count() > 0
