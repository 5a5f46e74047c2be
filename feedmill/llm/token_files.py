"""Token files: ids of whole texts in Simple-8b words, in ascending document order.

The table is range partitioned by document.  A task writes the documents of its
range as chunks: whole documents up to a number of ids, coded together (see
:mod:`feedmill.llm.simple8b`), beside their ids, their lengths, and the offsets of
the blocks.  A file is Parquet with the words as one uncompressed binary per chunk, so Spark's
writer commits it and a lost task is written again.  Chunks are read and decoded
independently of each other.
"""

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from feedmill.llm import simple8b
from feedmill.llm.arrow import bounded_batches, release_memory
from feedmill.llm.pieces import SLICE_BYTES, PieceEncoder, byte_slices, laid_out
from feedmill.llm.tables import text_hash, whole
from feedmill.operators.storage import scratch_path

END_ID = 2
_KNOWN_PIECES = 2_000_000  # pieces whose ids a worker remembers, about 45 bytes each
_SLICE_BYTES = SLICE_BYTES // 2
_TOGETHER = 1000  # words encoded in one call
# One space, then no white space and at the end none either: no rule of the pattern looks across its ends.
_SIMPLE = re.compile(r" [^\s\x1c-\x1f]+")
_SPACE_LETTER = "\u0120"  # fixed value: how the vocabulary writes a space
_CHUNK_IDS = 1 << 18  # a chunk is closed by the document that reaches this

SCHEMA = (
    "part int, chunk int, ids_before bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>,"
    " block_offsets array<int>, words binary, escapes array<decimal(20,0)>"
)


@lru_cache(maxsize=4)
def _encoder(path: str) -> PieceEncoder:
    """An encoder for a vocabulary file with the tokenizers library, loaded once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    spaced = np.array([(tokenizer.id_to_token(i) or "").startswith(_SPACE_LETTER) for i in range(tokenizer.get_vocab_size())])

    def each(texts):
        for text in texts:  # what the library makes beside the ids is many times as large: one at a time
            yield np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def encode_new(texts):
        """Words behind a space are encoded many at a time: just their first token begins with that space."""
        simple = [i for i, t in enumerate(texts) if t[:1] == " " and _SIMPLE.fullmatch(t)]
        other = sorted({*range(len(texts))} - {*simple})
        groups = [simple[i : i + _TOGETHER] for i in range(0, len(simple), _TOGETHER)]
        ids, lengths, order = [], [], []
        for group, found in zip(groups, each("".join([texts[i] for i in g]) for g in groups)):
            first = np.flatnonzero(spaced[found])
            if len(first) != len(group) or len(found) and first[0]:
                other += group  # not this vocabulary's way with spaces
                continue
            ids.append(found)
            lengths.append(np.diff(np.concatenate([first, [len(found)]])))
            order += group
        alone = list(each(texts[i] for i in other))
        flat = np.concatenate([*ids, *alone, np.zeros(0, "<u4")])
        many = np.concatenate([*lengths, np.array([len(a) for a in alone], np.int64)])
        order = np.array(order + other, np.int64)
        out = np.zeros(len(texts), np.int64)
        out[order] = many
        starts = np.zeros(len(texts), np.int64)
        starts[order] = np.cumsum(many) - many
        return laid_out(flat, starts, out), out

    return PieceEncoder(encode_new, [t.content for t in tokenizer.get_added_tokens_decoder().values()], _KNOWN_PIECES)


def write_token_files(
    docs: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, as token files under ``path``.

    Documents are in ascending order of their id (null first; rows sharing an id in
    the order of their texts' hashes).  A null or empty text has the end id only.
    An empty table writes files without chunks.  Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    order = [F.col("_id"), text_hash(F.col("_text"), 1)]
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), whole(text_col).alias("_text"))
    rows = rows.repartitionByRange("_id").sortWithinPartitions(*order)

    def run(batches):
        part, chunk, before = TaskContext.get().partitionId(), 0, 0
        held = []  # (document ids, lengths, ids) not written yet

        def closed(docs, lengths, ids):
            words, offsets, escapes = simple8b.encode(ids.astype(np.uint64))
            columns = [
                [part], [chunk], [before], [len(ids)], [docs], [lengths],
                [offsets.tolist()], [words.astype("<u8").tobytes()], [[int(e) for e in escapes]],
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types)], schema=_ARROW)

        def joined():
            docs, lengths, ids = zip(*held)
            return [d for some in docs for d in some], np.concatenate(lengths), np.concatenate(ids)

        release_memory()  # what an earlier stage left in this worker
        for batch in batches:
            for piece in byte_slices(batch, 1, _SLICE_BYTES):
                ids, lengths = _encoder(vocabulary).encode(piece.column(1))
                held.append((piece.column(0).to_pylist(), lengths + 1, np.insert(ids, np.cumsum(lengths), end_id)))
                docs, lengths, ids = joined()
                ends = np.cumsum(lengths)
                at = done = 0
                while ends[-1] - done >= _CHUNK_IDS:
                    upto = int(np.searchsorted(ends, done + _CHUNK_IDS)) + 1
                    last = int(ends[upto - 1])
                    yield closed(docs[at:upto], lengths[at:upto].tolist(), ids[done:last])
                    chunk, before, at, done = chunk + 1, before + last - done, upto, last
                    if at == len(ends):
                        break
                held = [(docs[at:], lengths[at:], ids[done:])] if at < len(ends) else []
                release_memory()
        if held:
            docs, lengths, ids = joined()
            yield closed(docs, lengths.tolist(), ids)

    rows.mapInArrow(run, SCHEMA).write.option("compression", "none").parquet(path)


_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("chunk", pa.int32()), ("ids_before", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("block_offsets", pa.list_(pa.int32())),
        ("words", pa.binary()), ("escapes", pa.list_(pa.decimal128(20, 0))),
    ]
)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of token files: ``start`` counts the ids of all documents before.

    ``ids`` are packed as little-endian unsigned 32-bit integers.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per written partition.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    chunks = files.join(F.broadcast(parts), "part").select(
        (F.col("_offset") + F.col("ids_before")).alias("first"), "doc_ids", "lengths", "block_offsets", "words", "escapes"
    )

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one chunk at a time as Python objects
                first, docs, lengths, offsets, words, escapes = [c[i].as_py() for c in batch.columns]
                ends = np.cumsum(np.array(lengths, np.int64))
                table = np.array([int(e) for e in escapes], np.uint64)
                ids = simple8b.decode(np.frombuffer(words, "<u8"), np.array(offsets, np.int64), table, int(ends[-1])).astype("<u4")
                packed = [ids[end - n : end].tobytes() for end, n in zip(ends, lengths)]
                starts = first + ends - np.array(lengths, np.int64)
                arrays = [pa.array(docs, pa.int64()), pa.array(starts), pa.array(lengths, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids"])
            release_memory()

    return chunks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def through_files(docs: DataFrame, vocabulary: str, **columns) -> DataFrame:
    """What :func:`read_token_files` gives for ``docs`` written to the shared folder."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, vocabulary, path, **columns)
    return read_token_files(docs.sparkSession, path)
