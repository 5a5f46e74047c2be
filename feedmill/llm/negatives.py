"""Hard negatives: for an anchor and each of its nearest positives, the best rows of other labels in a window of scores.

Scores are inner products of whole numbers.  A tile of anchors times candidates is
multiplied by Strassen's recursion on 64-bit integers.  Additions and
products wrap around alike, so the result is exact whenever it fits 64 bits, which is
checked first.  Each task keeps bounded heaps per anchor; heaps of several tasks are merged by rank.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from feedmill.llm.tiles import Items, as_long, blocked, cells, first_by_score, largest_product, quantised, rows_of_a_block, same_width
from feedmill.operators.storage import materialised

ANCHOR_ROWS = 512  # anchors that meet a block at a time
TILE_ROWS = 2048  # candidates of a tile
LEAF = 32  # sides up to this are multiplied as they are

_RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _even(x: np.ndarray) -> np.ndarray:
    """``x`` with a row or column of zeros where a side is odd."""
    return np.pad(x, [(0, side % 2) for side in x.shape]) if any(side % 2 for side in x.shape) else x


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` with seven products of halves in place of eight; odd sides are padded with zeros."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], columns) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), a.dtype)
    out[:i, :j] = m1 + m4 - m5 + m7
    out[:i, j:] = m3 + m5
    out[i:, :j] = m2 + m4
    out[i:, j:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact inner products of the rows of ``a`` and ``b``; one that does not fit a long is an error."""
    a, b = same_width(a, b)
    if largest_product(a, b) < 1 << 63:
        return strassen(a, np.ascontiguousarray(b.T))
    return as_long(strassen(a.astype(object), b.T.astype(object)))


class Heap:
    """The ``k`` best (score, id) so far; smaller ids first among equal scores."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores) == self.k:
            some = scores >= self.scores[-1]
            scores, ids = scores[some], ids[some]
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            first = first_by_score(scores, ids, self.k)
            self.scores, self.ids = scores[first], ids[first]


def _tiles(anchors: Items, block: Items):
    """(ids, labels, scores with every anchor) of the candidates of a block, a tile at a time."""
    left, right = anchors.matrix(), block.matrix()
    ids, labels = block.field("id"), block.field("label")
    for start in range(0, len(ids), TILE_ROWS):
        tile = slice(start, start + TILE_ROWS)
        yield ids[tile], labels[tile], products(left, right[tile])


def _table(heaps: list[Heap], names: list[str], *columns) -> pa.Table:
    many = [len(h.ids) for h in heaps]
    values = [np.repeat(np.asarray(c, np.int64), many) for c in columns]
    values += [np.concatenate([getattr(h, what) for h in heaps] or [np.zeros(0, np.int64)]) for what in ("ids", "scores")]
    return pa.table([pa.array(v, pa.int64()) for v in values], names=names)


def _positives(k: int):
    def compute(anchors: Items, block: Items) -> pa.Table:
        own, own_labels = anchors.field("id"), anchors.field("label")
        heaps = [Heap(k) for _ in own]
        for ids, labels, scores in _tiles(anchors, block):
            for heap, me, label, row in zip(heaps, own, own_labels, scores):
                keep = (labels == label) & (ids != me)
                heap.merge(row[keep], ids[keep])
        return _table(heaps, ["place", "positive_id", "positive_score"], anchors.field("place"))

    return compute


def _negatives(k: int, low: int, high: int):
    def compute(anchors: Items, block: Items) -> pa.Table:
        own_labels, positives = anchors.field("label"), anchors.lists("positives")
        windows = [[(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in ps] for ps in positives]
        heaps = [[Heap(k) for _ in ps] for ps in positives]
        for ids, labels, scores in _tiles(anchors, block):
            for mine, wanted, label, row in zip(heaps, windows, own_labels, scores):
                wide = [w for w in wanted if w[0] <= w[1]]
                if not wide:
                    continue
                keep = np.flatnonzero((labels != label) & (row >= min(w[0] for w in wide)) & (row <= max(w[1] for w in wide)))
                row, ids_kept = row[keep], ids[keep]
                for heap, (least, most) in zip(mine, wanted):
                    inside = (row >= least) & (row <= most)
                    heap.merge(row[inside], ids_kept[inside])
        flat = [h for mine in heaps for h in mine]
        places = np.repeat(anchors.field("place"), [len(m) for m in heaps])
        ranks = [p["positive_rank"] for ps in positives for p in ps]
        return _table(flat, ["place", "positive_rank", "negative_id", "negative_score"], places, ranks)

    return compute


def hard_negatives(
    df: DataFrame,
    is_anchor,
    label,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the exact inner product with the anchor of the components as floor(256 * x).  Higher
    scores come first, ties by smaller id.  An anchor's positives are its first ``n_positives`` other
    rows of the same label; for each, the first ``n_negatives`` rows of another label with
    ``low * positive <= 100 * negative <= high * positive`` are returned, all if fewer.  Rows
    without an id or a label, and vectors that are null or hold a null or non-finite component, take no part.
    Rows with the anchor's own id are no positives.  Rows sharing an id count each for
    themselves.  Vectors of different lengths are multiplied as far as both go.  An empty table, or one
    without anchors, gives an empty table; extra columns are not looked at.

    ``is_anchor`` is a column over (id), ``label`` one over the columns of ``df``.  Rows are cut into
    blocks in the order of their labels: positives come from blocks that share a label with a
    group of anchors, negatives from those that have another one, so hardly a product is formed twice.
    """
    spark = df.sparkSession
    labelled = df.withColumn("_label", label.cast("bigint"))
    rows = quantised(labelled.where(F.col("_label").isNotNull()), id_col, vector_col, label=F.col("_label"))
    rows = materialised(rows, "quantised")
    anchors = rows.where(is_anchor)
    n = rows.count()
    if not n or anchors.isEmpty():
        return spark.createDataFrame([], _RESULT)
    blocks, n_blocks = blocked(rows, ["label", "id"], "b", block_rows or rows_of_a_block(spark, n), "label")
    groups, _ = blocked(anchors, ["label", "id"], "g", ANCHOR_ROWS, "label")

    def same(pairs):
        return pairs.where("lo <= b_hi AND b_lo <= hi")

    def other(pairs):
        return pairs.where("NOT (lo = hi AND b_lo = b_hi AND lo = b_lo)")

    found = cells(groups, blocks, n_blocks, same, _positives(n_positives), "place bigint, positive_id bigint, positive_score bigint")
    first = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("positive_score"), "positive_id"))
    positives = materialised(found.withColumn("positive_rank", first).where(F.col("positive_rank") <= n_positives), "positives")

    nearest = F.sort_array(F.collect_list(F.struct("positive_rank", "positive_id", "positive_score"))).alias("positives")
    single = groups.select("g", "lo", "hi", F.explode("g_items").alias("_i"))
    with_positives = single.join(positives.groupBy("place").agg(nearest), F.col("_i.place") == F.col("place"))
    item = F.struct("place", F.col("_i.id").alias("id"), F.col("_i.label").alias("label"), "positives", F.col("_i.v").alias("v"))
    regrouped = with_positives.groupBy("g", "lo", "hi").agg(F.sort_array(F.collect_list(item)).alias("g_items"))
    regrouped = materialised(regrouped, "anchors")

    schema = "place bigint, positive_rank bigint, negative_id bigint, negative_score bigint"
    found = cells(regrouped, blocks, n_blocks, other, _negatives(n_negatives, low, high), schema)
    first = F.row_number().over(Window.partitionBy("place", "positive_rank").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = found.withColumn("rank", first).where(F.col("rank") <= n_negatives)
    names = groups.select(F.explode("g_items").alias("_i")).select(F.col("_i.place").alias("place"), F.col("_i.id").alias("anchor_id"))
    return ranked.join(positives, ["place", "positive_rank"]).join(names, "place").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
