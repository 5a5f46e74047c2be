"""Double-array tries over word numbers, walked by all positions of a text at once."""

from dataclasses import dataclass

import numpy as np

_FREE = -1
_TRIED = 8192  # slots looked at for the children of a node before the array grows


def _grown(array: np.ndarray, size: int, fill: int) -> np.ndarray:
    return array if len(array) >= size else np.concatenate([array, np.full(max(size, 2 * len(array)) - len(array), fill, array.dtype)])


@dataclass
class DoubleArray:
    """A trie of phrases of one length.

    ``symbols`` are the sorted word numbers that occur; a word's code is its place there.  From state s
    code c leads to slot ``base[s] + c``, which belongs to s if ``check`` says so.  ``accept`` numbers the
    phrases, in the order they were given, at their last state.
    """

    depth: int
    symbols: np.ndarray
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray

    def codes(self, words: np.ndarray) -> np.ndarray:
        """The code of each word number; -1 where no phrase has it."""
        at = np.minimum(np.searchsorted(self.symbols, words), len(self.symbols) - 1)
        return np.where(self.symbols[at] == words, at, -1)

    def walk(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, phrase numbers): where in ``words`` a phrase begins.  Every place advances one level at a time."""
        codes = self.codes(words)
        places = np.flatnonzero(codes[: max(0, len(codes) - self.depth + 1)] >= 0)
        states = np.zeros(len(places), np.int64)
        for level in range(self.depth):
            code = codes[places + level]
            to = self.base[states] + code
            known = (code >= 0) & (to >= 0) & (to < len(self.check))
            known[known] = self.check[to[known]] == states[known]
            places, states = places[known], to[known]
        return places, self.accept[states].astype(np.int64)


def build(phrases: np.ndarray) -> DoubleArray:
    """The trie of distinct phrases, one row of word numbers each, sorted by them."""
    n, depth = phrases.shape
    symbols = np.unique(phrases)
    codes = np.searchsorted(symbols, phrases)
    differs = np.ones((n, depth), bool)
    if n > 1:
        differs[1:] = np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1)
    size = 2 + len(symbols) + int(differs.sum())
    base, check = np.zeros(size, np.int64), np.full(size, _FREE, np.int64)
    check[0] = -2  # the root
    top, chosen = 1, np.random.default_rng(7)  # all slots from top on are free
    slot_of = np.zeros(n, np.int64)  # of each phrase's prefix at the level before
    for level in range(depth):
        rows = np.flatnonzero(differs[:, level])  # the first phrase of each child
        parents, code = slot_of[rows], codes[rows, level]
        begins = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        many = np.diff(np.concatenate([begins, [len(rows)]]))
        slots = np.zeros(len(rows), np.int64)
        for i in np.flatnonzero(many > 1)[np.argsort(-many[many > 1], kind="stable")]:
            own = slice(begins[i], begins[i] + many[i])
            # Any base may do: the fuller the array, the more fail, and the array grows until enough succeed.
            starts = chosen.integers(1 - code[own][0], max(2 - code[own][0], top - code[own][-1] + 1), max(16, _TRIED // int(many[i])))
            fits = np.flatnonzero((check[starts[:, None] + code[own]] == _FREE).all(axis=1)) if top > code[own][-1] - code[own][0] + 1 else []
            slots[own] = (starts[fits[0]] if len(fits) else top - code[own][0]) + code[own]
            top = max(top, int(slots[own][-1]) + 1)
            base, check = _grown(base, top, 0), _grown(check, top, _FREE)
            base[parents[begins[i]]], check[slots[own]] = slots[own][0] - code[own][0], parents[begins[i]]
        lone = begins[many == 1]
        free = np.flatnonzero(check[1:top] == _FREE)[: len(lone)] + 1
        slots[lone] = np.concatenate([free, np.arange(top, top + len(lone) - len(free))])
        top += len(lone) - len(free)
        base, check = _grown(base, top, 0), _grown(check, top, _FREE)
        base[parents[lone]], check[slots[lone]] = slots[lone] - code[lone], parents[lone]
        slot_of = slots[np.cumsum(differs[:, level]) - 1]
    accept = np.full(top, -1, np.int64)
    accept[slot_of] = np.arange(n)
    return DoubleArray(depth, symbols, base[:top].astype(np.int32), check[:top].astype(np.int32), accept.astype(np.int32))
