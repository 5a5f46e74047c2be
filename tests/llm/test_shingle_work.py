"""Shingles and signatures are found with little work, and are what their definitions say."""

import numpy as np
import pyarrow as pa
import pytest

from feedmill.llm import jaccard
from feedmill.llm.shingles import _BYTE, _PLACE, _word_hashes, distinct, mix, shingle_sets

TEXTS = ["", " \t\n", "One", "a b c d", "a a a a a a a a a", " lead  and\ttrail in a text ", "x" * 4096 + " b c d e f", "x" * 9000 + " y z w v u", "é É ß 漢 語 a B", None]


class Streamed:
    """Stands for the sorted rows: gives back the function that they are passed through."""

    def __getattr__(self, _):
        return lambda *args, **kwargs: self

    def mapInArrow(self, run, schema):
        return run


def posted(*batches):
    rows = [pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(d, pa.int64()), pa.array(n, pa.int32())], ["sig", "node", "n"]) for s, d, n in batches]
    return list(jaccard._shared_signatures(Streamed())(iter(rows)))


def test_signatures_of_one_set_are_not_taken_further():
    assert posted(([1, 2, 3], [7, 8, 9], [5, 5, 5]), ([4], [1], [5]), ([], [], [])) == []


def test_groups_that_cross_batches():
    found = posted(([1, 2, 2], [7, 8, 9], [5, 6, 7]), ([2, 3], [4, 1], [8, 9]), ([4, 4], [2, 3], [1, 2]))
    rows = [tuple(r.values()) for b in found for r in b.to_pylist()]
    assert rows == [(2, 8, 6, 8, 6, 3), (2, 9, 7, 8, 6, 3), (2, 4, 8, 8, 6, 3), (4, 2, 1, 2, 1, 2), (4, 3, 2, 2, 1, 2)]


def test_large_groups_keep_their_center_over_batches():
    many = jaccard.LARGE_GROUP + 5
    found = posted(([5] * many, list(range(many)), [4] * many), ([5], [900], [3]), ([5, 6], [901, 902], [3, 3]))
    rows = [tuple(r.values()) for b in found for r in b.to_pylist()]
    assert rows == [(5, d, 4 if d < many else 3, 0, 4, jaccard.LARGE_GROUP + 1) for d in [*range(many), 900, 901]]


def test_texts_are_taken_in_groups_that_stay_in_the_cache(monkeypatch):
    seen = []
    monkeypatch.setattr(jaccard, "shingle_sets", lambda texts: seen.append(sum(map(len, texts))) or shingle_sets(texts))
    texts = [f"text {i} " + "with some words " * 30 for i in range(400)]
    sets = jaccard._sets([*texts, *TEXTS])
    assert max(seen) < 1 << 16 and len(seen) > 5
    for text, found in zip([*texts, *TEXTS], sets):
        assert np.array_equal(found, shingle_sets([text or ""])[0])


def test_word_hashes_as_defined():
    data = "  ab c\t" .encode() + b"x" * 9000 + b"\n" + "é".encode()
    hashes, starts = _word_hashes(np.frombuffer(data, np.uint8))
    assert starts.tolist() == [2, 5, 7, 9008]
    for word, got in zip([b"ab", b"c", b"x" * 9000, "é".encode()], hashes):
        place = np.arange(len(word))
        factor = _PLACE[place & 4095] + ((place >> 12) << 1).astype(np.uint64)
        assert got == mix((_BYTE[np.frombuffer(word, np.uint8)] * factor).sum(dtype=np.uint64, keepdims=True))[0]


def test_distinct():
    for values in ([], [3], [3, 3], [5, 1, 5, 2**64 - 1, 0, 1]):
        assert distinct(np.array(values, np.uint64)).tolist() == sorted(set(values))


def defined(shingles, fine, common):
    """The signatures of a set, slot by slot."""
    found = set()
    one = lambda x, salt: int(mix(np.array([x % 2**64], np.uint64), salt)[0])
    for scheme in jaccard.schemes(len(shingles)):
        need, way = jaccard.borne(len(shingles), scheme), jaccard.allocation(scheme)
        if scheme in fine or not way.segments:
            order = sorted((x in common, one(x, 500 + scheme)) for x in shingles)
            found |= {sig for _, sig in order[:need]}
            continue
        slots = {}
        for x in shingles:
            value = one(x, 100 + scheme)
            slots.setdefault((value >> 32) * way.segments >> 32, []).append((value, x in common))
        order = []
        for segment, slot in slots.items():
            name, deletes = one(segment, 900 + scheme), segment < way.deleting
            total = sum(v for v, _ in slot)
            sig = one(total % 2**64 ^ name, 1)
            fewer = [one((total - v) % 2**64 ^ name, 1) for v, _ in slot] if deletes and len(slot) > 1 else []
            order.append((not deletes and all(c for _, c in slot), name if deletes else sig, sig, fewer))
        for *_, sig, fewer in sorted(order):
            if need <= 0:
                break
            found |= {sig, *fewer}
            need -= 2 if fewer else 1
    return sorted(found)


@pytest.mark.parametrize("size", [1, 4, 31, 70, 100, 150, 255, 300, 400, 700])
def test_signatures_as_defined(size):
    draw = np.random.default_rng(size)
    shingles = np.sort(draw.integers(0, 1 << 63, size, dtype=np.uint64))
    for common in (shingles[:0], shingles[::3], shingles, np.sort(draw.integers(0, 1 << 63, 50, dtype=np.uint64))):
        for fine in (frozenset(), frozenset(jaccard.schemes(size)[:1])):
            got = jaccard.signatures(shingles, fine, common).tolist()
            assert got == defined(shingles.tolist(), fine, set(common.tolist()))
