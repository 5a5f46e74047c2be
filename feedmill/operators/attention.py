"""Attention over grouped rows, article and user vectors, click scores.

Each distinct article is encoded once and each user once; candidates then only
join the two vector tables.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from feedmill import schema as S
from feedmill.functions import lists as L
from feedmill.functions import vectors as V
from feedmill.operators.skew import lookup_join
from feedmill.operators.storage import materialised, no_larger

# Key of the vector that stands for unknown articles and users without history.
UNKNOWN_KEY = -1
# exp() of twice this is still a normal double.
_SAFE_EXPONENT = 300.0


@dataclass(frozen=True)
class Attention:
    """Weights of one encoder: three projections, the number of heads, the pooling."""

    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    heads: int
    pool_w: np.ndarray
    pool_b: np.ndarray
    pool_q: np.ndarray

    @property
    def dim_in(self) -> int:
        return self.query.shape[0]

    @property
    def dim_out(self) -> int:
        return self.query.shape[1]

    @property
    def projections(self):
        return self.query, self.key, self.value

    @property
    def pooling(self):
        return self.pool_w, self.pool_b, self.pool_q


def fixed_attention(dim_in: int, heads: int, head_dim: int, hidden: int) -> Attention:
    """An encoder with fixed weight tables."""
    out = heads * head_dim
    return Attention(
        V.fixed_weights(dim_in, out, 0),
        V.fixed_weights(dim_in, out, 5),
        V.fixed_weights(dim_in, out, 9),
        heads,
        V.fixed_weights(out, hidden, 0),
        np.zeros(hidden),
        fixed_pool_query(hidden),
    )


def fixed_pool_query(hidden: int) -> np.ndarray:
    """q[j] = ((31 j) mod 13 - 6) / 50."""
    return V.fixed_weights(hidden, 1)[:, 0]


def attention_pool(
    df: DataFrame, group: str, vector: str, w, b, q, mask: Column | None = None
) -> DataFrame:
    """(group, dim, value): attention-weighted mean of the vectors of each group.

    tanh keeps every score within the sum of |q|, so that constant takes the
    place of the group maximum in the softmax and the pooled vector is a ratio of
    plain sums: one combined shuffle, whatever the size of a group.  Where that sum
    is too large for an exponent, the maximum of each group is found first and joined.  Rows where
    ``mask`` is false get no weight; a group without any other row gives nulls.
    """
    bound = float(np.abs(q).sum())
    score = V.attention_score_udf(np.asarray(w), np.asarray(b), np.asarray(q))(F.col(vector))
    dim = np.asarray(w).shape[0]
    counts = F.lit(True) if mask is None else F.coalesce(mask, F.lit(False))
    if bound <= _SAFE_EXPONENT:
        weight = F.when(counts, F.exp(score - F.lit(bound))).otherwise(F.lit(0.0))
        weighted = df.select(group, vector, weight.alias("_w"))
    else:
        scored = materialised(df.select(group, vector, F.when(counts, score).alias("_s")), "scores")
        highest = scored.groupBy(group).agg(F.max("_s").alias("_top"))
        weight = F.coalesce(F.exp(F.col("_s") - F.col("_top")), F.lit(0.0))
        weighted = lookup_join(scored, highest, group, "left").select(group, vector, weight.alias("_w"))
    sums = weighted.groupBy(group).agg(
        F.sum("_w").alias("_total"),
        *[F.sum(F.get(F.col(vector), F.lit(d)).cast("double") * F.col("_w")).alias(f"_{d}") for d in range(dim)],
    )
    total = F.when(F.col("_total") > 0, F.col("_total"))
    values = F.array(*[F.col(f"_{d}") / total for d in range(dim)])
    return L.explode_rows(sums, [group], values, "dim", "value")


def sequences(
    df: DataFrame, key: str, ids: str, table: DataFrame, table_key: str, vector: str, dim: int
) -> DataFrame:
    """(key, flat): the vectors of a short id list, one after the other.

    ``key`` identifies the row and the list must already have a fixed length.
    Ids missing from ``table`` get the vector under UNKNOWN_KEY.  An id in very
    many lists is joined by broadcast (see ``lookup_join``).
    """
    S.check_columns(df, [key, ids])
    rows = L.explode_rows(df, [key], ids, "_i", "_id")
    vectors = no_larger(table.select(F.col(table_key).alias("_id"), F.col(vector).cast("array<double>").alias("_v")), table)
    found = lookup_join(rows, vectors, "_id", "left")
    unknown = vectors.where(F.col("_id") == UNKNOWN_KEY).select("_v")
    filled = found.withColumn("_v", F.coalesce(F.col("_v"), unknown.scalar()))
    collected = filled.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_i", "_v"))).alias("_l"))
    return collected.select(key, F.flatten(F.transform("_l", lambda t: t["_v"])).alias("flat"))


def self_attention(
    seqs: DataFrame,
    key: str,
    encoder: Attention,
    n: int,
    causal: bool = False,
    q_len: str | None = None,
    v_len: str | None = None,
) -> DataFrame:
    """(key, pos, dim, value) of self-attention over sequences of ``n`` vectors, row by row."""
    shape = (encoder.projections, encoder.heads, n, encoder.dim_in, causal)
    if q_len or v_len:
        whole = F.lit(n)
        apply = V.masked_self_attention_udf(*shape)
        out = apply(F.col("flat"), F.col(q_len) if q_len else whole, F.col(v_len) if v_len else whole)
    else:
        out = V.self_attention_udf(*shape)(F.col("flat"))
    width = F.lit(encoder.dim_out)
    rows = L.explode_rows(seqs.select(key, out.alias("_o")), [key], "_o", "_i", "value")
    return rows.select(
        key,
        F.floor(F.col("_i") / width).cast("bigint").alias("pos"),
        F.pmod(F.col("_i"), width).cast("bigint").alias("dim"),
        "value",
    )


def encode_sequences(seqs: DataFrame, key: str, encoder: Attention, n: int, name: str = "vec") -> DataFrame:
    """(key, vec): self-attention and pooling of each sequence, row by row."""
    encode = V.encode_sequence_udf(encoder.projections, encoder.heads, encoder.pooling, n, encoder.dim_in)
    return seqs.select(key, encode(F.col("flat")).alias(name))


def article_vectors(
    encoded: DataFrame, key: str, ids: str, embeddings: DataFrame, encoder: Attention, n: int
) -> DataFrame:
    """(key, vec) per article, plus UNKNOWN_KEY: the vector of a text that is all padding.

    ``encoded`` has token id lists padded to ``n``; ``embeddings`` is (vec_id, embedding).  A token
    without an embedding has the zeros of row 0 of the lookup matrix.
    """
    blank = encoded.sparkSession.range(1).select(
        F.lit(UNKNOWN_KEY).cast("bigint").alias(key), F.array_repeat(F.lit(0).cast("bigint"), n).alias(ids)
    )
    lists = encoded.select(F.col(key).cast("bigint").alias(key), ids).unionByName(blank)
    known = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    zeros = encoded.sparkSession.range(1).select(
        F.lit(UNKNOWN_KEY).cast(known.schema["vec_id"].dataType).alias("vec_id"),
        F.array_repeat(F.lit(0.0), encoder.dim_in).alias("embedding"),
    )
    table = known.where(F.col("vec_id") != UNKNOWN_KEY).unionByName(zeros)
    seqs = sequences(lists, key, ids, table, "vec_id", "embedding", encoder.dim_in)
    return encode_sequences(seqs, key, encoder, n)


def user_vectors(
    history: DataFrame, articles: DataFrame, encoder: Attention, n: int, user=S.USER_ID, ids=S.HISTORY
) -> DataFrame:
    """(user, vec) per user from histories padded to ``n`` with UNKNOWN_KEY.

    The row UNKNOWN_KEY stands for users without a history.
    """
    blank = history.sparkSession.range(1).select(
        F.lit(UNKNOWN_KEY).cast("bigint").alias(user),
        F.array_repeat(F.lit(UNKNOWN_KEY).cast("bigint"), n).alias(ids),
    )
    lists = history.select(user, ids).unionByName(blank)
    seqs = sequences(lists, user, ids, articles, S.ARTICLE_ID, "vec", encoder.dim_in)
    return encode_sequences(seqs, user, encoder, n)


def with_pair_vectors(
    candidates: DataFrame, users: DataFrame, articles: DataFrame, dim: int, hot_from: DataFrame | None = None
) -> DataFrame:
    """Candidates with ``user_vec`` and ``article_vec``; unknown ids get the unknown vectors.

    Rows are still narrow when they meet the user table; the article table is
    broadcast when its checked size allows, so the wide rows are not shuffled.
    ``hot_from`` is a cheaper table with the same two id columns, for finding hot
    ids; by default the candidates themselves are read for that.
    """
    u = no_larger(users.select(F.col(S.USER_ID), F.col("vec").alias("user_vec")), users)
    a = no_larger(articles.select(F.col(S.ARTICLE_ID), F.col("vec").alias("article_vec")), articles)
    no_user = u.where(F.col(S.USER_ID) == UNKNOWN_KEY).select("user_vec")
    no_article = a.where(F.col(S.ARTICLE_ID) == UNKNOWN_KEY).select("article_vec")
    ids = candidates if hot_from is None else hot_from
    joined = lookup_join(candidates, u, S.USER_ID, "left", hot_from=ids)
    joined = lookup_join(joined, a, S.ARTICLE_ID, "left", hot_from=ids)
    return joined.withColumns(
        {
            "user_vec": F.coalesce(F.col("user_vec"), no_user.scalar()),
            "article_vec": F.coalesce(F.col("article_vec"), no_article.scalar()),
        }
    )


def click_scores(
    candidates: DataFrame,
    users: DataFrame,
    articles: DataFrame,
    dim: int,
    name: str = "score",
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Dot product of user and article vector for every candidate."""
    pairs = with_pair_vectors(candidates, users, articles, dim, hot_from)
    score = V.dot(F.col("user_vec"), F.col("article_vec"), dim)
    return pairs.withColumn(name, score).drop("user_vec", "article_vec")


def click_probability(scored: DataFrame, score: str = "score", name: str = "probability") -> DataFrame:
    return scored.withColumn(name, V.sigmoid(F.col(score)))
