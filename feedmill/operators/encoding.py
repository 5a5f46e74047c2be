"""Vocabulary and text encoding."""

from pyspark.sql import DataFrame, Window, functions as F

from feedmill import schema as S
from feedmill.functions import lists as L
from feedmill.functions.text import joined_with_space, tokens
from feedmill.operators.limits import LIMITS
from feedmill.operators.skew import lookup_join, small_enough
from feedmill.operators.storage import no_larger

# Ids of the padding and the unknown token; known tokens follow.
PAD_ID = 0
UNKNOWN_ID = 1
FIRST_ID = 2


def concat_columns(df: DataFrame, columns: list[str]) -> tuple[DataFrame, str]:
    """Add the columns joined by a space, under the name ``a-b-c``; returns (df, name)."""
    S.check_columns(df, columns)
    name = "-".join(columns)
    return df.withColumn(name, joined_with_space(*[F.col(c) for c in columns])), name


def build_vocabulary(df: DataFrame, column: str, size: int) -> DataFrame:
    """(token, n, token_id) of the ``size`` most frequent tokens, ties in token order.

    Counts are combined before the shuffle, so a very common token is no burden;
    only the ``size`` winners are numbered together.
    """
    S.check_columns(df, [column])
    words = L.explode_rows(df, [], tokens(F.col(column)), "_i", "token")
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "token").limit(size)
    ids = F.row_number().over(Window.orderBy(F.desc("n"), "token")) + (FIRST_ID - 1)
    return top.withColumn("token_id", ids.cast("bigint"))


def encode_text(
    df: DataFrame, key: str, column: str, vocabulary: DataFrame, size: int, max_length: int | None = None
) -> tuple[DataFrame, str]:
    """(key, token ids) per row, and the name of the new column.

    With ``max_length`` lists are cut and padded on the right to that length.
    ``key`` must identify the row; ``size`` bounds the vocabulary.  Rows are
    placed by key before their tokens are exploded, and a vocabulary that may be
    broadcast keeps them there, so one shuffle of the token lists is all.
    """
    S.check_columns(df, [key, column])
    name = f"{column}_encode_tok"
    words = tokens(F.col(column), max_length).alias("_t")
    ids = no_larger(vocabulary.select(F.col("token"), F.col("token_id")), vocabulary)
    if size > LIMITS.broadcast_max_rows or not small_enough(ids):
        exploded = df.select(key, words).select(key, F.posexplode_outer("_t").alias("_i", "token"))
        found = lookup_join(exploded, ids, "token", "left")
    else:
        if max_length is None:  # the text is no larger than its tokens
            placed = df.select(key, column).repartition(key).select(key, words)
        else:
            placed = df.select(key, words).repartition(key)
        exploded = placed.select(key, F.posexplode_outer("_t").alias("_i", "token"))
        found = exploded.join(F.broadcast(ids), "token", "left")
    known = F.coalesce("token_id", F.lit(UNKNOWN_ID).cast("bigint"))
    element = F.when(F.col("_i").isNotNull(), F.struct(F.col("_i").alias("i"), known.alias("v")))
    encoded = found.groupBy(key).agg(F.sort_array(F.collect_list(element)).alias("_l"))
    values = F.transform("_l", lambda t: t["v"])
    if max_length is not None:
        values = L.pad_right(values, max_length, F.lit(PAD_ID).cast("bigint"))
    return encoded.select(key, values.alias(name)), name
