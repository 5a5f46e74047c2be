"""Exact top-k search by inner product with the threshold algorithm.

The candidates of a block have one list per dimension, sorted by that component.  A query
reads all lists in parallel from the end that raises its score.  Every row met is
scored in full; a row not met yet scores at most the sum of the products at the places
reached (the threshold), so a query stops as soon as its kth score is above the threshold.
The best of all blocks are merged per query.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from feedmill.llm.tiles import (
    BLOCK_ROWS, Items, as_long, blocked, cells, first_by_score, largest_component, quantised, rows_of_a_block, same_width,
)
from feedmill.operators.storage import materialised

QUERY_ROWS = 1024  # queries that meet a block at a time
_FIRST_STEP = 16

_FOUND = "place bigint, query_id bigint, vec_id bigint, score bigint"
_RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


class SortedLists:
    """One list of rows per dimension, in the order of their components."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.by_dimension = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.most = largest_component(vectors)
        # Whole numbers below 2^53 are exact as doubles, in which rows are multiplied without a cast.
        self.vectors = vectors.astype(np.float64) if self.most < 1 << 53 else vectors
        self.by_id = np.argsort(ids, kind="stable")
        self.places_read = 0  # of all lists, over all searches

    def components(self, at, kind) -> np.ndarray:
        values = self.vectors[at]
        return values.astype(np.int64, copy=False).astype(object) if kind is object else values.astype(kind, copy=False)

    def scores(self, rows: np.ndarray, query: np.ndarray, kind) -> np.ndarray:
        products = self.components(rows, kind) @ query
        return as_long(products) if kind is object else products.astype(np.int64, copy=False)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` best rows whose id is not ``own``."""
        n = len(self.ids)
        met = np.zeros(n, bool)
        sorted_ids = self.ids[self.by_id]
        met[self.by_id[np.searchsorted(sorted_ids, own) : np.searchsorted(sorted_ids, own, side="right")]] = True
        left = n - int(met.sum())
        bound = largest_component(query) * self.most * max(1, len(query))
        kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        dims = np.concatenate([up, down])
        query = query.astype(kind)
        best_ids, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, _FIRST_STEP
        while left:
            upto = min(n, depth + step)
            known = met.copy()
            if len(dims):
                met[self.by_dimension[up, n - upto : n - depth]] = True
                met[self.by_dimension[down, depth:upto]] = True
                self.places_read += len(dims) * (upto - depth)
            else:
                met[:] = True  # all rows tie
            fresh = np.flatnonzero(met & ~known)
            if len(fresh):
                left -= len(fresh)
                ids = np.concatenate([best_ids, self.ids[fresh]])
                scores = np.concatenate([best_scores, self.scores(fresh, query, kind)])
                first = first_by_score(scores, ids, k)
                best_ids, best_scores = ids[first], scores[first]
            if left and len(best_ids) == k:
                ends = np.concatenate([self.by_dimension[up, n - upto], self.by_dimension[down, upto - 1]])
                # A row that only ties may have a smaller id.
                if query[dims] @ self.components((ends, dims), kind) < best_scores[-1]:
                    break
            depth, step = upto, step * 2
        return best_ids, best_scores


def _found(k: int):
    def compute(queries: Items, block: Items) -> pa.Table:
        asked, vectors = same_width(queries.matrix(), block.matrix())
        lists = SortedLists(block.field("id"), vectors)
        found = [lists.search(q, own, k) for q, own in zip(asked, queries.field("id"))]
        many = [len(ids) for ids, _ in found]
        columns = [
            np.repeat(queries.field("place"), many), np.repeat(queries.field("id"), many),
            np.concatenate([ids for ids, _ in found]), np.concatenate([scores for _, scores in found]),
        ]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["place", "query_id", "vec_id", "score"])

    return compute


def top_k(
    df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that meets ``is_query``, the ``k`` rows with the highest scores.

    The score is the exact inner product of the components as floor(256 * x); ties go
    to the smaller id.  Every row but those with the query's own id is a candidate; fewer candidates
    give fewer rows.  Rows without an id, and vectors that are null or hold a null or
    non-finite component, take no part.  Vectors of different lengths are multiplied as far as both go; an
    empty vector scores 0 everywhere.  Rows sharing an id are searched, and found, each for itself.  An empty
    table gives an empty table; extra columns are not looked at.

    ``is_query`` is a column over (id).  Queries and candidates are cut into blocks of
    bounded size; a task holds one block of each.
    """
    spark = df.sparkSession
    rows = materialised(quantised(df, id_col, vector_col), "quantised")
    asked = rows.where(is_query)
    n = rows.count()
    if not n or asked.isEmpty():
        return spark.createDataFrame([], _RESULT)
    blocks, n_blocks = blocked(rows, ["id"], "b", block_rows or rows_of_a_block(spark, n))
    groups, _ = blocked(asked, ["id"], "g", min(QUERY_ROWS, BLOCK_ROWS))
    found = cells(groups, blocks, n_blocks, lambda pairs: pairs, _found(k), _FOUND)
    best = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
