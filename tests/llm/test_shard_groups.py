"""Groups that fit a shard stay whole, on tables full of links."""

import math
import zlib

import pytest
from pyspark.sql import functions as F

from feedmill.llm import sharding
from tests.llm.fixtures import odd_documents
from tests.llm.test_documents import check_shards

N = 2400  # 300 rows a shard


def _pairs(ids):
    return [(i, f"pair {k // 2}") for k, i in enumerate(ids)]


TABLES = {
    "all pairs": (_pairs(range(N)), 0),
    "nine of ten in pairs": (_pairs(range(N * 9 // 10)) + [(i, f"alone {i}") for i in range(N * 9 // 10, N)], 0),
    "a hot third and pairs": ([(i, "hot") for i in range(N // 3)] + _pairs(range(N // 3, N)), 0),
    # 9, 10, 11 and 12 of a hundred each: one shard holds only one of them.
    "groups near a quota": (
        [(i, f"group {i % 100 // 9}" if i % 100 < 27 else f"ten {i % 100 // 10}" if 30 <= i % 100 < 50 else f"alone {i}") for i in range(N)], 0),
    "triples": ([(i, f"triple {i // 3}") for i in range(N)], 0),
    # Eight places for nine groups.
    "nine groups": ([(i, f"group {i % 9}") for i in range(N)], 1),
}


@pytest.mark.parametrize("packed", [8000, 5, 1])
@pytest.mark.parametrize("table", sorted(TABLES))
def test_groups_that_fit_stay_whole(spark, monkeypatch, table, packed):
    """With few groups packed one by one, the groups on a border may be cut: fewer than there are shards."""
    monkeypatch.setattr(sharding, "PACKED", packed)
    texts, allowed = TABLES[table]
    found = sharding.shard_rows(odd_documents(spark, [(i, t, "en", "a") for i, t in texts])).collect()
    check_shards(found, N)
    shards, sizes, text_of = {}, {}, dict(texts)
    for r in found:
        shards.setdefault(text_of[r.doc_id], set()).add(r.shard)
        sizes[text_of[r.doc_id]] = sizes.get(text_of[r.doc_id], 0) + 1
    quota = N // 8
    cut = [t for t, s in shards.items() if sizes[t] <= quota and len(s) > 1]
    assert len(cut) <= (allowed if packed == 8000 else 7)
    assert all(len(shards[t]) <= math.ceil(n / quota) + 1 for t, n in sizes.items() if n > quota)


def _state(rows):
    return rows.groupBy("_h1", "_h2", "_shard").agg(F.count(F.lit(1)).alias("_n"))


@pytest.mark.parametrize("table", ["all pairs", "triples", "groups near a quota"])
def test_cut_links_fall_from_round_to_round(spark, table):
    """Propagation alone, on full shards as well: each round cuts fewer links and no shard grows beyond its quota."""
    rows = [(zlib.crc32(t.encode()), 0, (i * 2654435761 >> 7) % 8) for i, t in TABLES[table][0] if not t.startswith("alone")]
    state = _state(spark.createDataFrame(rows, "_h1 bigint, _h2 bigint, _shard int"))
    before = {r._shard: r.n for r in state.groupBy("_shard").agg(F.sum("_n").alias("n")).collect()}
    found, cuts = sharding.propagate(state, [N // 8] * 8)
    assert all(b < a for a, b in zip(cuts, cuts[1:-1])) and cuts[-1] <= cuts[0] / 5
    after = {r._shard: r.n for r in found.groupBy("_shard").agg(F.sum("_n").alias("n")).collect()}
    assert sum(after.values()) == len(rows)
    widest = max(r[0] for r in found.select(F.max("_n")).collect())
    assert all(n <= max(N // 8, before.get(s, 0)) + widest for s, n in after.items())


def test_links_that_are_not_equal_texts(spark):
    """Rings of twenty documents with other texts: few of their links are cut, and shards stay even."""
    rings, size = 120, 20
    docs = odd_documents(spark, [(i, f"text {i}", "en", "a") for i in range(rings * size)])
    pairs = [(r * size + k, r * size + (k + step) % size) for r in range(rings) for k in range(size) for step in (1, 2, 3)]
    odd = [(5, 5), (None, 7), (3, 10**9), pairs[0], pairs[0][::-1]]
    found = sharding.shard_rows(docs, links=spark.createDataFrame(pairs + odd, "a bigint, b bigint")).collect()
    check_shards(found, rings * size)
    shard = {r.doc_id: r.shard for r in found}
    assert sum(shard[a] != shard[b] for a, b in pairs) <= len(pairs) * 0.45  # 7/8 by chance


def test_flows_count_departures_as_room():
    full = [10, 10, 10]
    assert sharding._flows({(0, 1): 4, (1, 0): 4}, full, full) == {(0, 1): 4, (1, 0): 4}
    assert sharding._flows({(0, 1): 4, (1, 0): 1}, full, full) == {(0, 1): 1, (1, 0): 1}
    assert sharding._flows({(0, 1): 2, (1, 2): 2, (2, 0): 2}, full, full) == {(0, 1): 2, (1, 2): 2, (2, 0): 2}
    assert sharding._flows({(0, 1): 4}, [10, 7, 10], full) == {(0, 1): 3}
