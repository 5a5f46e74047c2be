"""Pieces that a worker remembers: found again exactly, at a cost that does not grow with their number."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from feedmill.llm import pieces as P


def plain(strings):
    """The code points of each string as its ids."""
    return np.array([ord(c) for s in strings for c in s], "<u4"), np.array([len(s) for s in strings], np.int64)


def texts(seed, n):
    draw = random.Random(seed)
    alphabet = ["a", "b", "\0", "é", "語", "😀", "-"]
    words = ["".join(draw.choices(alphabet, k=draw.choice([0, 1, 2, 3, 7, 8, 9, 15, 16, 17, 63, 64, 65, 90]))) for _ in range(40)]
    return [None if draw.random() < 0.05 else " ".join(draw.choices(words, k=draw.randint(0, 12))) for _ in range(n)]


def check(encoder, batch):
    ids, n = encoder.encode(pa.array(batch, pa.string()))
    assert n.tolist() == [len(t or "") for t in batch]
    assert ids.tolist() == [ord(c) for t in batch for c in t or ""]


@pytest.mark.parametrize("hashed", ["as it is", "two values", "all alike"])
@pytest.mark.parametrize("remembered", [0, 5, 10_000])
def test_the_same_ids_again(monkeypatch, hashed, remembered):
    spread = P._hashes
    if hashed != "as it is":
        monkeypatch.setattr(P, "_hashes", lambda *x: spread(*x) % np.uint32(2 if hashed == "two values" else 1))
    encoder = P.PieceEncoder(plain, [], remembered)
    for seed in (1, 2, 1, 3, 2):
        check(encoder, texts(seed, 60))
        check(encoder, [])
    assert len(encoder.known) <= min(remembered, {"as it is": remembered, "two values": 2, "all alike": 1}[hashed])
    assert (np.diff(encoder.known.hashes.astype(np.int64)) > 0).all()


def test_known_pieces_are_not_encoded_again():
    asked = []
    encoder = P.PieceEncoder(lambda s: asked.append(s) or plain(s), [], 10_000)
    batch = ["x " + " ".join(f"word{i}" for i in range(3_000))]
    check(encoder, batch)
    asked.clear()
    check(encoder, batch)
    assert sum(map(len, asked)) < 10


def test_a_call_costs_no_memory_for_what_is_known():
    encoder = P.PieceEncoder(plain, [], 1_000_000)
    for k in range(4):
        check(encoder, [" ".join(f"{k}w{i}" for i in range(100_000))])
    small = ["x 0w5 1w7 2w9"]
    check(encoder, small)
    tracemalloc.start()
    check(encoder, small)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200_000
