"""One-permutation MinHash fingerprints of whole texts.

The shingles of a text are hashed once.  The top bits of a hash choose a bin, the
smallest hash of a bin represents it, and its low-order bits are kept.  An empty bin
takes the value of the first filled bin in an order of its own, which is the same
for all texts (optimal densification).  Likeness counts equal bins, corrected for bits that agree by chance.
"""

import hashlib
import json

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmill.llm.tables import WHITE_SPACE, text_hash, whole
from feedmill.operators.ordering import dense_index
from feedmill.operators.skew import lookup_join

BINS, BITS, WORDS = 128, 8, 5
_TOP = 64 - (BINS - 1).bit_length()
# Each bin's own order of all bins, drawn by rule.
_ORDERS = [sorted(range(BINS), key=lambda other: hashlib.md5(f"{own}-{other}".encode()).digest()) for own in range(BINS)]
_PROBES = 4
_BLOCK_BITS = 10  # ids that share all but so many low bits are put in order together


def _shingles(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sorted hashes of the text's shingles of lower-case words.

    Fewer words than a shingle has are one shingle; a text without words has none.
    """
    trimmed = F.btrim(F.lower(text), F.lit(WHITE_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    df = df.withColumn("_w", F.transform(words, lambda w: F.xxhash64(w)))
    # Each element looks ahead: five hashes make a shingle.
    ahead = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("_w") - (WORDS - 1), F.lit(1))),
        lambda i: F.xxhash64(*[F.get(F.col("_w"), i + (k - 1)) for k in range(WORDS)]),
    )
    return df.withColumn(name, F.when(F.size("_w") > 0, F.sort_array(ahead)).otherwise(F.array().cast("array<bigint>"))).drop("_w")


def _bin(value: Column) -> Column:
    return F.shiftright(value, _TOP) + BINS // 2


def _bins(df: DataFrame, shingles: str, name: str) -> DataFrame:
    """``df`` with ``name``: the low-order bits of each bin, null for a text without shingles."""
    all_ = F.col(shingles)
    # Sorted hashes keep each bin together, smallest first.
    minima = F.filter(all_, lambda h, i: (i == 0) | (F.shiftright(h, _TOP) != F.shiftright(F.get(all_, i - 1), _TOP)))
    df = df.withColumn("_m", minima)
    low = (1 << BITS) - 1

    def kept(h):
        return h.bitwiseAND(F.lit(low)).cast("int")

    dense = F.transform("_m", kept)
    some = (F.size("_m") < BINS) & (F.size("_m") > 0)
    # Spark computes a column apart, not anew for each bin, if an expression uses it twice.
    df = df.withColumn("_b", F.transform("_m", _bin))
    at = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: kept(F.get("_m", (F.array_position("_b", b.cast("bigint")) - 1).cast("int"))))
    df = df.withColumn("_v", F.when(F.size("_b") < BINS, at))
    # The orders are read as a constant, once.
    orders = F.from_json(F.lit(json.dumps([[b, *order[:_PROBES]] for b, order in enumerate(_ORDERS)])), "array<array<int>>")
    ranks = F.from_json(F.lit(json.dumps(np.argsort(_ORDERS, axis=1).tolist())), "array<array<int>>")

    def first_filled(order, b):
        """The bin itself, or the first filled one in its order: a few probes, then all that are filled."""
        near = [F.get("_v", F.get(order, F.lit(i))) for i in range(_PROBES + 1)]
        rank = F.get(ranks, b)
        far = F.array_min(F.transform("_m", lambda h: F.struct(F.get(rank, _bin(h).cast("int")).alias("rank"), kept(h).alias("v"))))
        return F.coalesce(*near, far["v"])

    filled = F.transform(orders, first_filled)
    return df.withColumn(name, F.when(F.size("_m") == BINS, dense).when(some, filled)).drop("_m", "_b", "_v")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``name``: the fingerprint of ``text`` as an array of ``BINS`` small integers.

    Null for a text without words.  Everything is an expression over one row; nothing is shuffled.
    """
    df = _shingles(df, text, "_s")
    return _bins(df, "_s", name).drop("_s")


def packed(fingerprint: Column) -> Column:
    """The bins' bits as hexadecimal digits; empty for a text without words."""
    digits = F.transform(fingerprint, lambda v: F.lpad(F.hex(v), BITS // 4, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1.

    Two texts without words are alike (1), one without words and another are not (0).
    """
    agree = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (agree / BINS - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(estimate)


def with_next(rows: DataFrame) -> DataFrame:
    """``rows`` (_id, _text) cut into blocks ``_block`` of neighbouring ids, with ``_guest`` rows.

    A block also holds, as a guest that comes last, a copy of the row that follows it: the first row
    of the next block, or after the last block the very first row.  So the next
    row is always found inside the block, and a text is shuffled once.  Null ids come first.
    """
    block = F.coalesce(F.shiftright("_id", _BLOCK_BITS), F.lit(-(1 << 62)))
    rows = rows.withColumn("_block", block).withColumn("_hash", text_hash(F.col("_text"), 1))
    first = F.min(F.struct(F.col("_id"), F.col("_hash")))
    heads = rows.groupBy("_block").agg(first.alias("_head"))
    heads = dense_index(heads, [F.col("_block")], "_n")
    n = heads.count()
    before = heads.select(F.pmod(F.col("_n") + 1, F.lit(max(n, 1))).alias("_n"), F.col("_block").alias("_host"))
    heads = heads.join(before, "_n").select("_block", "_head", "_host")
    found = lookup_join(rows, heads, "_block")
    is_head = (F.struct("_id", "_hash") == F.col("_head")) | (F.col("_id").isNull() & F.col("_head._id").isNull() & (F.col("_hash") == F.col("_head._hash")))
    places = F.array(F.struct(F.col("_block").alias("_block"), F.lit(False).alias("_guest")))
    guest = F.array(F.struct(F.col("_host").alias("_block"), F.lit(True).alias("_guest")))
    spread = found.withColumn("_place", F.explode(F.when(is_head, F.concat(places, guest)).otherwise(places)))
    return spread.select("_id", "_text", "_hash", "_place._block", "_place._guest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its fingerprint, that of its edited text, and their likenesses.

    In the edited text the last half of the code points (rounded down) gives way to as many from the
    start of the next document in ascending order of ids, the first one after the
    last.  Columns: ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.  A null text counts as empty; null ids come first,
    rows that share an id are in the order of their texts' hashes (equal rows may swap).  A
    single row is its own next.  An empty table gives an empty table; extra columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), whole(text_col).alias("_text"))
    inside = Window.partitionBy("_block").orderBy("_guest", "_id", "_hash")
    half = F.expr("length(_text) div 2").cast("int")
    n = F.length("_text")
    following = F.lead("_text").over(inside)
    rows = with_next(rows).withColumn("_next", following)
    rows = rows.withColumn("_edited", F.concat(F.left("_text", n - half), F.left(F.coalesce("_next", F.lit("")), half)))
    rows = rows.withColumns({"_n": n.cast("bigint"), "_sha": F.sha2("_edited", 256)}).drop("_next")
    rows = with_fingerprint(with_fingerprint(rows, "_text", "_f").drop("_text"), "_edited", "_fe").drop("_edited")
    rows = rows.withColumn("_fn", F.lead("_f").over(inside)).where(~F.col("_guest"))
    return rows.select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_chars"), F.col("_sha").alias("edited_sha256"),
        packed(F.col("_f")).alias("fingerprint"), packed(F.col("_fe")).alias("edited_fingerprint"),
        likeness(F.col("_f"), F.col("_fe")).alias("near_edited"), likeness(F.col("_f"), F.col("_fn")).alias("near_next"),
    )
