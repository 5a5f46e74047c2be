"""map_ids_*: one record per customer with all its clicks, however many."""

import datetime

import pytest

from feedmill.plans import queries
from feedmill.plans.oracles import ORACLES
from feedmill.plans.queries import QUERIES
from tests.compare import connect

CLICKS = {1: 230, 2: 100, 3: 101, 4: 0}  # by customer
CUSTOMERS = [1, 2, 2, 3, 4, 4, 5, None, None]


def label(article):
    """Of two in three articles; none of the first hundred of customer 3."""
    return None if article % 3 == 0 or 30_000 <= article < 30_100 else article % 7


@pytest.fixture
def sf_dir(spark, tmp_path):
    day = datetime.datetime(1995, 1, 1)
    clicks = [(c, i, c * 10_000 + i) for c, n in CLICKS.items() for i in range(n)]
    clicks += [(None, 0, 50_001)]
    orders = [(k, c, day + datetime.timedelta(days=i)) for k, (c, i, _) in enumerate(clicks)]
    orders += [(len(orders), 5, datetime.datetime(1999, 1, 1))]  # after the history
    lines = [(k, a, 1, "R") for k, (_, _, a) in enumerate(clicks)] + [(len(clicks), 11, 1, "R")]
    labels = [(a, label(a), [1.0]) for _, _, a in clicks if label(a) is not None]
    for name, rows, schema in [
        ("customer", [(c,) for c in CUSTOMERS], "c_custkey long"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string"),
        ("embeddings", labels, "vec_id long, label int, embedding array<float>"),
    ]:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def expected(unknown):
    """``unknown`` stands for an id without a label; None: it is dropped."""
    out = {}
    for c in set(CUSTOMERS):
        found = [label(c * 10_000 + i) for i in range(CLICKS.get(c, 0))] if c else []
        values = [unknown if v is None else str(v) for v in found or [None] for _ in range(CUSTOMERS.count(c))]
        out[c] = ",".join(v for v in values if v is not None) or None
    return out


@pytest.mark.parametrize("page", [100, 3])
@pytest.mark.parametrize("name, unknown", [("map_ids_fill", "-1"), ("map_ids_drop", None), ("map_ids_keep", "null")])
def test_a_history_is_one_record(spark, sf_dir, monkeypatch, name, unknown, page):
    monkeypatch.setattr(queries, "HISTORY_PAGE", page)
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == len(set(CUSTOMERS))
    assert {r["user_id"]: r["labels"] for r in rows} == expected(unknown)
    assert dict(connect(sf_dir).execute(ORACLES[name]).fetchall()) == expected(unknown)
