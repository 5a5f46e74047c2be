"""Top-k search and hard negatives against SQL and a plain computation, on odd vectors and hot labels."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from feedmill.llm.negatives import Heap, hard_negatives, products, strassen
from feedmill.llm.threshold import SortedLists, top_k
from tests.compare import assert_same, connect
from tests.conftest import SMALL

_SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, v string, place int, g int, b int, score int, rank int"


@pytest.mark.parametrize("name", ["op12_top_k_search", "op13_hard_negatives"])
def test_query_against_sql(spark, name):
    assert_same(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name])


def table(spark, rows):
    """Rows of (id, vector, label) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, v, y, "a", "b", 1, 2, 3, 4, 5) for i, v, y in rows], _SCHEMA)


def odd_rows():
    """Ties, repeated ids, equal vectors, lists of several lengths, a hot label, and rows that take no part."""
    draw = random.Random(3)
    rows = [(i, [draw.choice([-0.5, -0.004, 0.0, 0.25, 0.126, 1.0]) for _ in range(6)], draw.choice([1, 1, 1, 2, 3])) for i in range(120)]
    rows += [(7, [0.5] * 6, 1), (7, [0.5] * 6, 1), (50, [0.25] * 6, 2), (50, [-0.25] * 6, 2), (-100, [1.0] * 6, 1), (200, [0.0] * 6, 3)]
    rows += [(201, [], 1), (250, [], 2), (202, [1.0, 1.0], 2), (300, [0.5] * 9, 1), (400, [-1.0] * 6, 9)]
    rows += [(None, [1.0] * 6, 1), (500, None, 1), (501, [1.0, None], 1), (502, [math.nan] * 6, 1), (550, [math.inf], 2), (600, [1.0] * 6, None)]
    return rows


def valid(rows):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return whole


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, k):
    out = []
    for q, v, _ in valid(rows):
        if q % 50 == 0:
            scored = sorted((-dot(v, w), c) for c, w, _ in valid(rows) if c != q)[:k]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [None, 7, 64])
def test_top_k_of_odd_rows(spark, block_rows):
    rows = odd_rows()
    found = top_k(table(spark, rows), F.col("id") % 50 == 0, 4, block_rows=block_rows)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, 4)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 2)]
    found = top_k(table(spark, rows), F.col("id") % 50 == 0, 5).collect()
    assert sorted(tuple(r) for r in found) == brute_top(rows, 5) and len(found) == 2
    assert top_k(table(spark, rows[:1]), F.col("id") % 50 == 0).count() == 0


def test_large_and_overflowing_components(spark):
    rows = [(0, [2.0**40, 1.0], 1), (1, [2.0**-8, 3.0], 1), (2, [3.0, -(2.0**44)], 1)]
    found = top_k(table(spark, rows), F.col("id") % 50 == 0, 5).collect()
    assert sorted(tuple(r) for r in found) == brute_top(rows, 5)
    with pytest.raises(Exception, match="does not fit a long"):
        top_k(table(spark, [(0, [2.0**50], 1), (1, [2.0**50], 1)]), F.col("id") % 50 == 0).count()
    with pytest.raises(Exception, match="too large for a long"):
        top_k(table(spark, [(0, [2.0**60], 1), (1, [1.0], 1)]), F.col("id") % 50 == 0).count()


def brute_negatives(rows, n_positives, n_negatives):
    rows, out = [(i, v, y) for i, v, y in valid(rows) if y is not None], []
    for a, v, label in rows:
        if a % 100:
            continue
        positives = sorted((-dot(v, w), c) for c, w, y in rows if y == label and c != a)[:n_positives]
        negatives = sorted((-dot(v, w), c) for c, w, y in rows if y != label)
        for p, (score, pos) in enumerate(positives):
            inside = [(s, c) for s, c in negatives if 30 * -score <= 100 * -s <= 90 * -score][:n_negatives]
            out += [(a, pos, rank, c, -score, -s) for rank, (s, c) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [None, 9, 64])
def test_negatives_of_odd_rows(spark, block_rows):
    rows = odd_rows() + [(1000 + i, [0.25 * (i % 5), 0.5, 0.25, 0.0, 0.126, 0.5], 1 + i % 2) for i in range(40)]
    want = brute_negatives(rows, 5, 6)
    found = hard_negatives(table(spark, rows), F.col("id") % 100 == 0, F.col("label"), 5, 6, block_rows=block_rows)
    assert len(want) > 100 and sorted(tuple(r) for r in found.collect()) == want


def test_anchors_without_positives_or_negatives(spark):
    rows = [(100, [1.0], 1), (101, [0.5], 2), (200, [1.0], 3), (201, [0.9], 3)]
    found = hard_negatives(table(spark, rows), F.col("id") % 100 == 0, F.col("label"))
    assert sorted(tuple(r) for r in found.collect()) == brute_negatives(rows, 5, 10)
    assert hard_negatives(table(spark, rows[1:2]), F.col("id") % 100 == 0, F.col("label")).count() == 0


def test_empty_tables(spark):
    found = top_k(table(spark, []), F.col("id") % 50 == 0)
    assert found.count() == 0 and found.columns == ["query_id", "rank", "vec_id", "score"]
    found = hard_negatives(table(spark, []), F.col("id") % 100 == 0, F.col("label"))
    assert found.count() == 0 and found.columns[0] == "anchor_id"


def test_search_stops_early_where_it_may():
    """A few near vectors among many far ones: the lists are hardly read; the answer is that of a full scan."""
    numbers = np.random.default_rng(1)
    vectors = numbers.integers(-20, 20, (5_000, 8))
    vectors[:10] = 250
    lists = SortedLists(np.arange(5_000), vectors)
    query = np.full(8, 200)
    ids, scores = lists.search(query, 0, 5)
    assert ids.tolist() == [1, 2, 3, 4, 5] and set(scores.tolist()) == {250 * 200 * 8}
    assert 0 < lists.places_read < 5_000
    every = vectors @ query
    ids, scores = lists.search(query, -1, 12)
    assert scores.tolist() == sorted(every.tolist(), reverse=True)[:12]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(1, 9), st.integers(1, 4), st.integers(0, 2**32))
def test_strassen(rows, inner, columns, leaf, seed):
    numbers = np.random.default_rng(seed)
    a, b = numbers.integers(-(2**28), 2**28, (rows, inner)), numbers.integers(-(2**28), 2**28, (inner, columns))
    assert (strassen(a, b, leaf) == a @ b).all()


def test_products_that_only_fit_in_the_end():
    a = np.array([[2**40, -(2**40), 1]], np.int64)
    b = np.array([[2**40, 2**40, 5], [2**22, 0, 0]], np.int64)
    assert products(a, b).tolist() == [[5, 2**62]]
    with pytest.raises(OverflowError):
        products(a, np.array([[2**30, 0, 0]], np.int64))


def test_heaps_merge_like_one_sort():
    numbers = np.random.default_rng(2)
    scores, ids = numbers.integers(-3, 3, 300), numbers.permutation(300)
    heap = Heap(7)
    for part in range(0, 300, 23):
        heap.merge(scores[part : part + 23], ids[part : part + 23])
    assert list(zip(heap.scores.tolist(), heap.ids.tolist())) == sorted(zip(scores.tolist(), ids.tolist()), key=lambda x: (-x[0], x[1]))[:7]
