"""Sets of word shingles as sorted arrays of 64-bit hashes."""

import numpy as np

WORDS = 5
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


_GAMMA = 0x9E3779B97F4A7C15
_SHIFT_30, _SHIFT_27, _SHIFT_31 = np.uint64(30), np.uint64(27), np.uint64(31)
_FACTOR_1, _FACTOR_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of a well-known hash)."""
    x = x + np.uint64(salt * _GAMMA & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> _SHIFT_30
    x *= _FACTOR_1
    x ^= x >> _SHIFT_27
    x *= _FACTOR_2
    x ^= x >> _SHIFT_31
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order; for the short arrays here several times faster than ``np.unique``, which hashes them first."""
    x = np.sort(x)
    first = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=first[1:])
    return x[first]


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of lower-cased UTF-8 bytes."""
    inside = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    letters = data[inside]
    begins = (np.cumsum(inside) - 1)[starts]  # of the words among the letters
    lengths = np.diff(begins, append=len(letters))
    place = np.arange(len(letters)) - np.repeat(begins, lengths)
    factor = _PLACE[place & 4095]
    if lengths.max() > 4096:  # beyond the table a word's places repeat with another factor
        factor += ((place >> 12) << 1).astype(np.uint64)
    return mix(np.add.reduceat(_BYTE[letters] * factor, begins)), starts


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted.

    Words are runs without white space, A-Z in lower case.  A text of fewer than
    ``words`` words is one shingle, a text without words the empty set.
    """
    data = [t.encode().translate(_TO_LOWER) for t in texts]
    hashes, starts = _word_hashes(np.frombuffer(b" ".join(data) + b" ", np.uint8))
    ends = np.cumsum([len(d) + 1 for d in data])
    bounds = np.searchsorted(starts, ends)
    weighted = np.zeros(len(hashes), np.uint64)
    n = len(hashes) - words + 1
    if n > 0:
        weighted[:n] = mix(sum(hashes[k : k + n] * _WORD[k] for k in range(words)), 1)
    sets, begin = [], 0
    for end in bounds:
        if end - begin >= words:
            sets.append(distinct(weighted[begin : end - words + 1]))
        elif end > begin:
            own = hashes[begin:end]
            sets.append(mix((own * _WORD[: len(own)]).sum(dtype=np.uint64, keepdims=True), 2 + len(own)))
        else:
            sets.append(np.zeros(0, np.uint64))
        begin = end
    return sets


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set, as two signed 64-bit integers."""
    sums = np.array([mix(shingles, s).sum(dtype=np.uint64) + np.uint64(len(shingles)) for s in (3, 4)], np.uint64)
    return tuple(sums.astype(np.int64).tolist())


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())
