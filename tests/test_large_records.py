"""Queries over the click-log layout on impressions and histories too large for one record."""

import pytest

from feedmill.plans import tables as D
from feedmill.plans.oracles import ORACLES
from feedmill.plans.queries import QUERIES
from tests.compare import assert_same, connect
from tests.conftest import SMALL
from tests.test_skew import skewed  # noqa: F401

LAYOUT = ["scan_behaviors", "scan_history", "split_counts", "train_rows", "validation_rows"]


@pytest.mark.parametrize("name", LAYOUT)
def test_layout_beyond_the_bounds(spark, tiny_limits, name):
    assert_same(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name])


@pytest.mark.parametrize("name", LAYOUT)
def test_layout_with_an_order_of_a_third_of_the_rows(spark, skewed, tiny_limits, name):  # noqa: F811
    tiny_limits.group_max_rows = tiny_limits.list_max_items = 50
    assert_same(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name])


@pytest.mark.parametrize("name", ["behaviors_with_history", "map_ids_fill", "map_ids_drop", "map_ids_keep"])
def test_long_histories(spark, skewed, tiny_limits, name):  # noqa: F811
    tiny_limits.group_max_rows = tiny_limits.list_max_items = 50
    assert_same(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name])


def test_a_history_beyond_the_bounds_is_not_one_record(spark, tiny_limits):
    with pytest.raises(ValueError, match="too many for one record"):
        D.histories(spark, SMALL)
    clicks = {(r.user_id, r.hist_pos): r.article_id for r in D.history_rows(spark, SMALL).collect()}
    pages = D.history_pages(spark, SMALL).collect()
    assert max(len(p.article_id_fixed) for p in pages) == 3
    assert {(p.user_id, p.first_pos + i): a for p in pages for i, a in enumerate(p.article_id_fixed)} == clicks
