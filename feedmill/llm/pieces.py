"""Encoding of many texts by their distinct pieces, on whole Arrow arrays.

No word of the byte-level pattern crosses a cut before a single space, so texts are split
there; only the distinct pieces of a batch are encoded, and their ids are laid out
behind one another by index.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space in a row around a space, where such a cut would tear a word apart.
_SPACE = r"[\s\v\x{1c}-\x{1f}\x{85}\p{Z}]"
_TORN = rf"{_SPACE} {_SPACE}|  |{_SPACE} \z"
SLICE_BYTES = 8 << 20


def byte_slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES):
    """Slices of a batch with about ``limit`` bytes of text, or one row, at a time."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes + 16)
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def laid_out(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``pool[start : start + length]`` behind one another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + len(pool) < 1 << 31 else np.int64
    shift = (starts - (ends - lengths)).astype(kind)
    return pool[np.repeat(shift, lengths) + np.arange(total, dtype=kind)]


def _eight(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int) -> np.ndarray:
    """The bytes ``at`` to ``at + 8`` of each run of bytes as one number, zero behind its end; ``data`` ends in 8 spare bytes."""
    numbers = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))[starts + at]
    return numbers & _ENDS[np.clip(lengths - at, 0, 8)]


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of 32 bits for each run of at most _LONGEST bytes."""
    found = lengths.astype(np.uint64)
    for at in range(0, int(lengths.max(initial=0)), 8):
        some = np.flatnonzero(lengths > at)
        mixed = (found[some] ^ _eight(data, starts[some], lengths[some], at)) * _MIX
        found[some] = mixed ^ (mixed >> np.uint64(29))
    return (found * _MIX >> np.uint64(32)).astype(np.uint32)


_LONGEST = 64  # bytes of a piece that is remembered
_ENDS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd number without a pattern


class KnownPieces:
    """Up to ``most`` pieces of at most _LONGEST bytes with their ids, in the order of their hashes.

    A piece is found by binary search and compared byte by byte.  Of two with the same hash the first
    is kept.  A search costs memory for what is looked for, not for what is known.
    """

    def __init__(self, most: int):
        self.most = most
        self.hashes = np.zeros(0, np.uint32)
        self.bytes, self.byte_starts, self.byte_lengths = np.zeros(8, np.uint8), np.zeros(0, np.uint32), np.zeros(0, np.uint8)
        self.ids, self.id_starts, self.id_lengths = np.zeros(0, "<u4"), np.zeros(0, np.uint32), np.zeros(0, np.uint8)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The place of each piece, -1 for those not known."""
        if not len(self):
            return np.full(len(hashes), -1, np.int64)
        places = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        same = (self.hashes[places] == hashes) & (self.byte_lengths[places] == lengths)
        for at in range(0, int(lengths[same].max(initial=0)), 8):
            some = np.flatnonzero(same & (lengths > at))
            known = _eight(self.bytes, self.byte_starts[places[some]].astype(np.int64), lengths[some], at)
            same[some] = known == _eight(data, starts[some], lengths[some], at)
        return np.where(same, places, -1)

    def add(self, hashes, data, starts, lengths, ids, id_lengths) -> None:
        """Remember pieces that are not known, as far as there is room; ``ids`` of all of them lie behind one another."""
        id_starts = np.cumsum(id_lengths) - id_lengths
        _, first = np.unique(hashes, return_index=True)  # in the order of the hashes
        if len(self):
            first = first[self.hashes[np.minimum(np.searchsorted(self.hashes, hashes[first]), len(self) - 1)] != hashes[first]]
        if len(first) > self.most - len(self):
            first = first[np.sort(np.argsort(first)[: self.most - len(self)])]
        if not len(first):
            return
        at = np.searchsorted(self.hashes, hashes[first])
        lengths, id_lengths = lengths[first], id_lengths[first]
        byte_starts = len(self.bytes) - 8 + np.cumsum(lengths) - lengths
        self.bytes = np.concatenate([self.bytes[:-8], laid_out(data, starts[first], lengths), np.zeros(8, np.uint8)])
        more = len(self.ids) + np.cumsum(id_lengths) - id_lengths
        self.ids = np.concatenate([self.ids, laid_out(ids, id_starts[first], id_lengths)])
        for name, new in [
            ("hashes", hashes[first]), ("byte_starts", byte_starts), ("byte_lengths", lengths), ("id_starts", more), ("id_lengths", id_lengths)
        ]:
            own = getattr(self, name)
            setattr(self, name, np.insert(own, at, new.astype(own.dtype)))


class PieceEncoder:
    """Encodes arrays of texts; ``encode_new`` gives (ids behind one another, number of ids of each) for a list of strings.

    Up to ``remembered`` pieces keep their ids between calls (:class:`KnownPieces`); those of others are found again.
    """

    def __init__(self, encode_new, special: list[str], remembered: int):
        self.encode_new, self.special, self.known = encode_new, special, KnownPieces(remembered)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts behind one another, number of ids of each); null counts as empty."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if not n:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        whole = pc.match_substring_regex(texts, _TORN)
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        whole = whole.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~whole)), " ")
        per_list = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        counts = np.ones(n, np.int64)
        counts[~whole] = per_list
        ends = np.cumsum(counts)
        begins = ends - counts

        pieces = lists.flatten()
        is_first = np.zeros(len(pieces), bool)
        firsts = np.cumsum(per_list) - per_list
        is_first[firsts] = True
        encoded = pieces.filter(pa.array(~is_first)).dictionary_encode()
        distinct = encoded.dictionary
        alone = pieces.take(pa.array(firsts)).to_pylist() + texts.filter(pa.array(whole)).to_pylist()

        entry = np.empty(int(ends[-1]), np.int64)
        place = np.repeat(begins[~whole] - firsts, per_list) + np.arange(len(pieces))
        entry[place[~is_first]] = encoded.indices.to_numpy()
        entry[begins[~whole]] = len(distinct) + np.arange(len(firsts))
        entry[begins[whole]] = len(distinct) + len(firsts) + np.arange(int(whole.sum()))

        pool, starts, lengths = self._ids_after_space(distinct)
        more, more_lengths = self.encode_new(alone)
        starts = np.concatenate([starts, len(pool) + np.cumsum(more_lengths) - more_lengths])
        lengths = np.concatenate([lengths, more_lengths])
        each = lengths[entry]
        flat = laid_out(np.concatenate([pool, more]), starts[entry], each)
        return flat, np.add.reduceat(each, begins)

    def _ids_after_space(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first place, number of ids) of each distinct piece behind a space."""
        data, starts, sizes = _laid_bytes(pieces)
        short = np.flatnonzero(sizes <= _LONGEST)
        hashes = _hashes(data, starts[short], sizes[short])
        place = np.full(len(pieces), -1, np.int64)
        place[short] = self.known.find(hashes, data, starts[short], sizes[short])
        is_new = place < 0
        ids, new_lengths = self.encode_new([" " + p for p in pieces.filter(pa.array(is_new)).to_pylist()])
        old = place[~is_new]
        lengths = np.empty(len(pieces), np.int64)
        lengths[~is_new], lengths[is_new] = self.known.id_lengths[old], new_lengths
        old_ids = laid_out(self.known.ids, self.known.id_starts[old].astype(np.int64), lengths[~is_new])
        first = np.empty(len(pieces), np.int64)
        first[~is_new] = np.cumsum(lengths[~is_new]) - lengths[~is_new]
        first[is_new] = len(old_ids) + np.cumsum(new_lengths) - new_lengths
        pool = np.concatenate([old_ids, ids])
        keep = is_new[short] & (lengths[short] < 256)
        kept = short[keep]
        new_ids = laid_out(pool, first[kept], lengths[kept])
        self.known.add(hashes[keep], data, starts[kept], sizes[kept], new_ids, lengths[kept])
        return pool, first, lengths


def _laid_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(UTF-8 bytes with 8 spare ones, first place, number of bytes) of strings without nulls."""
    if not len(texts):
        return np.zeros(8, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, places, letters = texts.buffers()
    offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(letters or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.concatenate([raw, np.zeros(8, np.uint8)]), offsets[:-1] - offsets[0], np.diff(offsets)


def packed_array(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """One binary of little-endian unsigned 32-bit integers per text."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32) * 4
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.astype("<u4").tobytes())])
