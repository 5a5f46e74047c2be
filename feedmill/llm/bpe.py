"""Byte-pair encoding of whole texts by sharing the prefixes of their distinct words.

The words of a batch go into a trie (their sorted order is a depth-first walk of
it).  For each prefix the last token of its encoding is determined once, from the
last token of a shorter prefix: a token may follow another exactly when encoding
both together gives just these two.  A word's ids are read backwards along its path.
"""

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from feedmill.llm.arrow import begin_task, release_memory, remembered, small_batches
from feedmill.llm.pieces import SLICE_BYTES, PieceEncoder, byte_slices, laid_out, packed_array

# The word pattern of the byte-level vocabulary.
_SPACE = r"\p{White_Space}"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|{_SPACE}+(?!\P{{White_Space}})|{_SPACE}+"
# What a worker remembers; beyond it, the same answers are found again.
_KNOWN_PAIRS, _KNOWN_PIECES = 150_000, 600_000
_SLICE_BYTES = SLICE_BYTES // 16


def _byte_letters() -> dict[str, int]:
    """The printable letter that the vocabulary file writes for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Encoder and decoder of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        self.id_of = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*self.id_of.values(), *self.added.values()]))
        for token, i in self.id_of.items():
            self.bytes_of[i] = token
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.longest = max(map(len, self.id_of))
        self.merges = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            parts = merge.split(" ") if isinstance(merge, str) else merge
            left, right = [bytes(letters[c] for c in part) for part in parts]
            self.merges[self.id_of[left], self.id_of[right]] = (rank, self.id_of[left + right])
        self.word = regex.compile(PATTERN)
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.bytes_of))]
        self.pairs = {}
        self.encoder = PieceEncoder(self._encode_strings, names, _KNOWN_PIECES)
        self.sizes = np.array([len(t) for t in self.bytes_of], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def merged(self, data: bytes) -> list[int]:
        """Encoding by the merge list itself; used on the few bytes of one or two tokens."""
        ids = [self.id_of[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min(range(len(ids) - 1), key=lambda i: self.merges.get((ids[i], ids[i + 1]), (len(self.merges),))[0])
            if (ids[best], ids[best + 1]) not in self.merges:
                break
            ids[best : best + 2] = [self.merges[ids[best], ids[best + 1]][1]]
        return ids

    def _follows(self, last: int, token: int) -> bool:
        """Whether ``last`` (-1: the start of the word) and ``token`` stay as they are side by side."""
        before = self.bytes_of[last] if last >= 0 else b""
        answer = self.merged(before + self.bytes_of[token]) == [last, token][last < 0 :]
        if len(self.pairs) >= _KNOWN_PAIRS:
            self.pairs.clear()
        self.pairs[last, token] = answer
        return answer

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """The packed ids of each word, computing each shared prefix once.

        Sorted words are the trie in depth-first order.  ``last[d]`` is the last token
        of the encoding of the path's first ``d`` bytes and ``begin[d]`` where it starts; a
        word goes on from the depth it shares with the word before.
        """
        encoded, path, last, begin = {}, b"", [-1], [0]
        id_of, longest, pairs, follows, packed = self.id_of, self.longest, self.pairs, self._follows, self.packed
        for data, word in sorted([(w.encode(), w) for w in words]):
            shared = next((i for i, (a, b) in enumerate(zip(path, data)) if a != b), min(len(path), len(data)))
            del last[shared + 1 :], begin[shared + 1 :]
            for depth in range(shared + 1, len(data) + 1):
                # Just one token can be the last; most often it goes on from the one before.
                start = begin[-1]
                token = id_of.get(data[start:depth])
                if token is not None:
                    pair = (last[start], token)
                    if not (pairs[pair] if pair in pairs else follows(*pair)):
                        token = None
                if token is None:
                    for start in range(depth - 1, max(-1, depth - longest - 1), -1):
                        token = id_of.get(data[start:depth])
                        if token is not None:
                            pair = (last[start], token)
                            if pairs[pair] if pair in pairs else follows(*pair):
                                break
                last.append(token)
                begin.append(start)
            path, ids, depth = data, [], len(data)
            while depth:
                ids.append(packed[last[depth]])
                depth = begin[depth]
            ids.reverse()
            encoded[word] = b"".join(ids)
        return encoded

    def _encode_strings(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids behind one another, number of ids of each string): special tokens apart, then word by word."""
        parts = [self.special.split(x) if self.special else [x] for x in strings]
        words = [[self.word.findall(p) if i % 2 == 0 else (p,) for i, p in enumerate(ps)] for ps in parts]
        encoded = self.encode_words({w for ws in words for i, found in enumerate(ws) if i % 2 == 0 for w in found})
        tokens = {(t,): self.packed[i] for t, i in self.added.items()}
        ids = [b"".join([tokens[f] if i % 2 else b"".join([encoded[w] for w in f]) for i, f in enumerate(ws)]) for ws in words]
        return np.frombuffer(b"".join(ids), "<u4"), np.array([len(i) >> 2 for i in ids], np.int64)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes of all texts behind one another, number of bytes of each)."""
        sizes = self.sizes[ids]
        data = laid_out(self.pool, self.starts[ids], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lengths)])]
        return data, np.diff(ends)


@remembered
def vocabulary(path: str) -> ByteBpe:
    """The encoder for a vocabulary file, loaded once per worker."""
    return ByteBpe(path)


def encode(docs: DataFrame, path: str, text_col: str = "text", name: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (by default all) with ``name``: the ids of the whole text, packed as little-endian unsigned 32-bit integers.

    The ids are those of the tokenizers library for this file, without special
    tokens added; a special token's own text is encoded as that token.  A null or
    empty text has no ids.  ``path`` must be readable by every executor; ``name``
    must not be a column of ``docs`` yet.  Rows are encoded where they are read, in
    slices of bounded size; a worker remembers words up to a fixed number.
    """

    def values(texts):
        return [packed_array(*vocabulary(path).encoder.encode(texts))]

    return _with_arrays(docs, path, text_col, {name: T.BinaryType()}, values, keep)


def _texts(path: str, ids: np.ndarray, n: np.ndarray) -> pa.Array:
    """The text of each run of ``n`` ids."""
    data, sizes = vocabulary(path).decode(ids, n)
    ends = np.cumsum(sizes)
    first = data[(ends - sizes)[sizes > 0]]
    raw = data.tobytes()
    try:
        raw.decode()
        valid = not ((first >= 0x80) & (first < 0xC0)).any()
    except UnicodeDecodeError:
        valid = False
    if not valid:
        return pa.array([raw[e - s : e].decode("utf-8", "replace") for e, s in zip(ends, sizes)], pa.string())
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])


def decode(docs: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (by default all) with ``name``: the text of packed ids, special tokens included; null ids give an empty text.

    Ids that do not make valid UTF-8 give replacement characters, as the library does.
    """

    def values(lists):
        lists = pc.fill_null(lists, b"")
        n = pc.binary_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) >> 2
        return [_texts(path, np.frombuffer(b"".join(lists.to_pylist()), "<u4"), n)]

    return _with_arrays(docs, path, ids_col, {name: T.StringType()}, values, keep)


def _with_arrays(df: DataFrame, path: str, source: str, new: dict[str, T.DataType], values, keep: list[str] | None) -> DataFrame:
    """``keep`` and the columns ``new``: ``values`` maps the array of ``source`` in a slice of bounded bytes.

    A worker remembers words, up to a fixed number.
    """
    small_batches(df.sparkSession)
    kept = [i for i, c in enumerate(df.columns) if keep is None or c in keep]
    place, names = df.columns.index(source), [*[df.columns[i] for i in kept], *new]

    def run(batches):
        begin_task(vocabulary)
        for batch in batches:
            for part in byte_slices(batch, place, _SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], *values(part.column(place))], names)
                release_memory()

    return df.mapInArrow(run, T.StructType([*[df.schema[i] for i in kept], *[T.StructField(n, t) for n, t in new.items()]]))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row: of the ids and of the text decoded from them.

    Both ways are gone in one pass, so that a task has one Python worker.
    """

    def values(texts):
        ids, n = vocabulary(path).encoder.encode(texts)
        return [packed_array(ids, n), _texts(path, ids, n)]

    new = {"ids": T.BinaryType(), "decoded": T.StringType()}
    both = _with_arrays(docs.select(id_col, text_col), path, text_col, new, values, [id_col])
    n_tokens = F.expr("octet_length(ids) div 4").alias("n_tokens")
    return both.select(id_col, n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
