"""Simple-8b: runs of ids in 64-bit words, a selector in the top four bits of each.

Ids are coded in blocks of a fixed number; each block starts a new word and its
first word's offset is kept, so blocks can be found and decoded apart.  All steps
work on whole arrays: encoding advances one word in every block at a time, decoding
unpacks all words of one selector together.
"""

import numpy as np

BLOCK = 1024
# Ids per word and bits per id for selectors 1 to 14.  Selector 0 is an
# escape: its word holds a place in the table of ids of more than 60 bits.
COUNTS = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
_PAYLOAD = np.uint64(60)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, escaped ids) of an array of unsigned 64-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    width = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)  # bits, or one more beyond what a float holds
    escaped = width > 60
    table = ids[escaped]
    grid = np.zeros((blocks, BLOCK + COUNTS[1]), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:n] = np.where(escaped, np.uint64(0), ids)
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    ends = np.minimum(n - np.arange(blocks) * BLOCK, BLOCK)

    # The selector that packs most ids from each place on; an escape stands alone.
    widths = np.zeros(grid.shape, np.uint8)
    narrow = np.zeros(blocks * BLOCK, np.uint8)
    narrow[:n] = width
    widths[:, :BLOCK] = narrow.reshape(blocks, BLOCK)
    stops = widths[:, :BLOCK] > 60
    selector = np.full((blocks, BLOCK), len(BITS) - 1, np.uint8)
    done = np.zeros((blocks, BLOCK), bool)
    wide = np.zeros((blocks, grid.shape[1] + 1), np.int16)
    for s in range(1, len(BITS) - 1):
        gaps = np.diff(np.flatnonzero(width > BITS[s]), prepend=-1, append=n)
        if gaps.max() <= COUNTS[s]:
            continue  # no run is long enough
        np.cumsum(widths > BITS[s], axis=1, out=wide[:, 1:])
        fits = (wide[:, COUNTS[s] : COUNTS[s] + BLOCK] == wide[:, :BLOCK]) & ~done
        selector[fits] = s
        done |= fits
        if done.all():
            break
    selector[stops] = 0

    counts = np.array(COUNTS)
    at, place, chosen = np.zeros(blocks, np.int64), [], []
    rows = np.arange(blocks)
    while len(rows):
        here = at[rows]
        picked = selector[rows, here]
        place.append(rows * grid.shape[1] + here)
        chosen.append(picked)
        at[rows] = here + counts[picked]
        rows = rows[at[rows] < ends[rows]]
    place = np.concatenate(place) if place else np.zeros(0, np.int64)
    chosen = np.concatenate(chosen) if chosen else np.zeros(0, np.uint8)
    order = np.argsort(place, kind="stable")
    place, chosen = place[order], chosen[order]

    words = chosen.astype(np.uint64) << _PAYLOAD
    values = grid.reshape(-1)
    for s in np.unique(chosen):
        mine = np.flatnonzero(chosen == s)
        if s == 0:
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
            continue
        for k in range(COUNTS[s]):
            words[mine] |= values[place[mine] + k] << np.uint64(k * BITS[s])
    offsets = np.searchsorted(place, np.arange(blocks) * grid.shape[1])
    return words, offsets, table


def decode(words: np.ndarray, offsets: np.ndarray, table: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of :func:`encode`, or of any run of whole blocks."""
    chosen = (words >> _PAYLOAD).astype(np.int64)
    counts = np.array(COUNTS)[chosen]
    # A block's last word may be padded: places are counted from the block's start.
    ends = np.cumsum(counts)
    starts = ends - counts
    block = np.searchsorted(offsets, np.arange(len(words)), side="right") - 1
    place = block * BLOCK + starts - starts[offsets][block] if len(words) else starts
    out = np.zeros(-(-n // BLOCK) * BLOCK + COUNTS[1], np.uint64)
    for s in np.unique(chosen):
        mine = np.flatnonzero(chosen == s)
        if s == 0:
            out[place[mine]] = table[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        mask = np.uint64((1 << BITS[s]) - 1)
        limit = (block[mine] + 1) * BLOCK
        for k in range(COUNTS[s]):
            to = place[mine] + k
            inside = to < limit
            out[to[inside]] = words[mine[inside]] >> np.uint64(k * BITS[s]) & mask
    return out[:n]
