"""A block of the top-k search is held once, and searched exactly whatever the size of its numbers."""

import numpy as np
import pytest

from feedmill.llm import threshold
from feedmill.llm.threshold import SortedLists


def best(ids, vectors, query, own, k):
    scored = [(-sum(int(a) * int(b) for a, b in zip(v, query)), int(i)) for i, v in zip(ids, vectors) if i != own]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def found(lists, query, own, k):
    return [(int(i), int(s)) for i, s in zip(*lists.search(query, own, k))]


def test_a_block_is_held_as_rows_and_one_order_of_them():
    lists = SortedLists(np.arange(500), np.random.default_rng(1).integers(-99, 99, (500, 16)))
    lists.search(np.arange(16), 3, 5)
    held = sum(v.size for v in vars(lists).values() if isinstance(v, np.ndarray) and v.ndim == 2)
    assert held == 2 * 500 * 16


def test_the_rows_of_a_block_are_bounded_once(monkeypatch):
    seen = []
    bound = threshold.largest_component
    monkeypatch.setattr(threshold, "largest_component", lambda a: seen.append(a.ndim) or bound(a))
    lists = SortedLists(np.arange(300), np.random.default_rng(1).integers(-9, 9, (300, 4)))
    for own in range(20):
        lists.search(np.array([1, -2, 0, 3]), own, 5)
    assert seen.count(2) == 1


@pytest.mark.parametrize("of_rows", [1, 3, 200, 2**27, 2**40, 2**53, 2**61])
@pytest.mark.parametrize("of_query", [1, 100, 2**26, 2**53 + 1])
def test_search_as_defined(of_rows, of_query):
    draw = np.random.default_rng(of_rows % 97 + of_query % 89)
    vectors, ids = draw.integers(-of_rows, of_rows + 1, (150, 6)), draw.integers(0, 120, 150)  # some ids come twice
    vectors[40:60] = vectors[0]  # ties
    vectors[70:80] = 0
    lists = SortedLists(ids, vectors)
    for query in [*draw.integers(-of_query, of_query + 1, (6, 6)), np.zeros(6, np.int64), vectors[0] // max(1, of_rows // of_query)]:
        want = best(ids, vectors, query, ids[0], 5)
        every = [sum(int(x) * int(y) for x, y in zip(v, query)) for v in vectors]
        if max(map(abs, every)) < 2**63:  # else it is an error
            assert found(lists, query, ids[0], 5) == want


def test_short_and_empty_blocks():
    none = SortedLists(np.zeros(0, np.int64), np.zeros((0, 3), np.int64))
    assert found(none, np.array([1, 2, 3]), 0, 5) == []
    few = SortedLists(np.array([7, 7, 9]), np.array([[1, 0], [0, 1], [2, 2]]))
    assert found(few, np.array([1, 1]), 9, 5) == [(7, 1), (7, 1)]
    assert found(few, np.array([1, 1]), 7, 5) == [(9, 4)]
    flat = SortedLists(np.array([4, 2]), np.zeros((2, 0), np.int64))
    assert found(flat, np.zeros(0, np.int64), 8, 5) == [(2, 0), (4, 0)]
