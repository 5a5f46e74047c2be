"""Near duplicates whose centers have no candidate, and random near-subset texts."""

import random

import pyarrow as pa
import pytest

from feedmill.llm.arrow import slices
from feedmill.llm.jaccard import near_groups
from tests.llm.fixtures import jaccard_components, odd_documents


def grouped(spark, rows):
    found = near_groups(odd_documents(spark, [(i, t, "en", "a") for i, t in rows])).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


def near_subsets(seed):
    """Texts that are runs of the words of one text."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(7, 14))]
    rows = []
    for i in range(draw.randrange(3, 9)):
        start = draw.randrange(0, 3)
        rows.append((i + 1, " ".join(words[start : start + draw.randrange(4, 12)])))
    return rows


def link_of_sets_inside_one_another(draw):
    """A (two shingles) lies inside B (four), B inside C (five); only B and C are linked."""
    words = [f"w{draw.randrange(10**6)}" for _ in range(9)]
    at = draw.randrange(1, 4)
    start = draw.choice([0, 1])
    return [(1, " ".join(words[at : at + 6])), (2, " ".join(words[1:9])), (3, " ".join(words[0:9] if start == 0 else words[1:9] + ["x"]))]


def test_sets_inside_one_another(spark):
    draw = random.Random(11)
    tables = [link_of_sets_inside_one_another(draw) for _ in range(120)]
    # All at once, each with words of its own: one table, hundreds of groups.
    rows = [(10 * k + i, text.replace("w", f"k{k}w")) for k, table in enumerate(tables) for i, text in table]
    assert grouped(spark, rows) == jaccard_components(rows)


@pytest.mark.parametrize("seed", range(1))
def test_a_link_does_not_depend_on_other_rows(spark, seed):
    """Tables of one group, where no center may have a candidate, with and without unrelated rows."""
    from feedmill.llm.jaccard import signatures
    from feedmill.llm.shingles import shingle_sets
    import numpy as np

    draw = random.Random(seed)
    none = np.zeros(0, np.uint64)
    while True:  # B and C share a single signature, and A has it too
        rows = link_of_sets_inside_one_another(draw)
        a, b, c = [set(signatures(s, frozenset(), none).tolist()) for s in shingle_sets([t for _, t in rows])]
        if len(b & c) == 1 and b & c <= a:
            break
    want = jaccard_components(rows)
    assert want[2][1] == want[3][1] == 2
    assert grouped(spark, rows) == want
    more = rows + [(50 + i, f"other words that stand beside {i} all the time and more of them here") for i in range(3)]
    assert grouped(spark, more) == jaccard_components(more)


@pytest.mark.parametrize("seed", range(2))
def test_random_near_subsets(spark, seed):
    rows = near_subsets(seed)
    assert grouped(spark, rows) == jaccard_components(rows)


def test_slices_are_bounded_by_bytes():
    texts = ["x" * n for n in (5, 0, 300, 2, 2, 2, 1000, 1, 50)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    parts = list(slices(batch, 4, 100))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows <= 4 for p in parts)
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 100 for p in parts)
    assert list(slices(batch.slice(0, 0))) == []
