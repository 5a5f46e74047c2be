"""Operators on impression records, whose ids sit in list columns.

Labels, sampling, truncation and the like touch one row only, so they are
projections without a shuffle.  A row's key (``impression_id`` by default) seeds
its random choices, so results do not depend on partitioning or row order.
"""

from pyspark.sql import DataFrame, functions as F

from feedmill import schema as S
from feedmill.functions import lists as L
from feedmill.operators.rows import DEFAULT_SEED
from feedmill.operators.skew import lookup_join
from feedmill.operators.storage import no_larger


def _whole(df: DataFrame) -> None:
    """Random choices are made over whole impressions; a page is only a part of one."""
    if "page" in df.columns:
        raise ValueError("paged impressions hold parts of lists: use the row operators in feedmill.operators.candidates")


def add_labels(df: DataFrame, inview=S.INVIEW, clicked=S.CLICKED, label=S.LABELS) -> DataFrame:
    """0/1 list beside the in-view list: was this candidate clicked."""
    S.check_columns(df, [inview, clicked])
    return df.withColumn(label, L.binary_labels(F.col(inview), F.col(clicked)))


def remove_positives(df: DataFrame, inview=S.INVIEW, clicked=S.CLICKED) -> DataFrame:
    S.check_columns(df, [inview, clicked])
    return df.withColumn(inview, L.without_clicked(F.col(inview), F.col(clicked)))


def truncate_history(df: DataFrame, column: str, history_size: int, padding_value=None) -> DataFrame:
    """Keep the newest ``history_size`` ids; with a padding value, pad on the left to that size.

    Histories are expected oldest first.
    """
    S.check_columns(df, [column])
    if padding_value is None:
        return df.withColumn(column, L.tail(F.col(column), history_size))
    return df.withColumn(column, L.tail_padded(F.col(column), history_size, padding_value))


def keep_min_candidates(df: DataFrame, min_negatives: int, inview=S.INVIEW) -> DataFrame:
    """Impressions whose in-view list is longer than ``min_negatives + 1``."""
    S.check_columns(df, [inview])
    return df.where(F.size(inview) > min_negatives + 1)


def add_candidate_count(df: DataFrame, inview=S.INVIEW, name=S.N_SAMPLES) -> DataFrame:
    S.check_columns(df, [inview])
    return df.withColumn(name, F.size(inview))


def shuffle_list(df: DataFrame, column: str, key: list[str], seed=DEFAULT_SEED) -> DataFrame:
    S.check_columns(df, [column, *key])
    _whole(df)
    return df.withColumn(column, L.shuffled(F.col(column), seed, *[F.col(k) for k in key]))


def sample_ids(
    df: DataFrame,
    n: int,
    key: list[str],
    with_replacement: bool = False,
    seed=DEFAULT_SEED,
    inview=S.INVIEW,
) -> DataFrame:
    """Replace the list by ``n`` of its ids.

    Without replacement a shorter list is an error; with it an empty list gives nulls.
    """
    S.check_columns(df, [inview, *key])
    _whole(df)
    draw = L.sampled_with_replacement if with_replacement else L.sampled_without_replacement
    return df.withColumn(inview, draw(F.col(inview), n, seed, *[F.col(k) for k in key]))


def sample_negatives(
    df: DataFrame,
    npratio: int,
    shuffle: bool = False,
    with_replacement: bool = True,
    seed=DEFAULT_SEED,
    key: str = S.IMPRESSION_ID,
    inview=S.INVIEW,
    clicked=S.CLICKED,
    click_pos: str = "click_pos",
) -> DataFrame:
    """One row per click: ``npratio`` unclicked ids, then the clicked one.

    The clicked column becomes the one-element list of that click, and
    ``click_pos`` numbers the clicks of a record from 1.  Records without clicks
    give no row.  ``shuffle`` mixes each list.  The pool of unclicked ids is
    worked out once per record, never copied per click.
    """
    S.check_columns(df, [key, inview, clicked])
    _whole(df)
    if npratio < 0:
        raise ValueError("npratio must not be negative")
    row_key = F.col(key)
    pool = L.without_clicked(F.col(inview), F.col(clicked))
    if not with_replacement:
        pool = L.shuffled(pool, seed, row_key)

    def one_list(c, i):
        negatives = L.negatives_per_click(F.col("_pool"), npratio, with_replacement, seed, row_key, i + 1)
        return F.struct(
            (i + 1).cast("bigint").alias("pos"),
            F.array(c).alias("clicked"),
            (F.concat(negatives, F.array(c)) if npratio else F.array(c)).alias("ids"),
        )

    drawn = df.withColumn("_pool", pool).withColumn("_lists", F.transform(F.col(clicked), one_list))
    rows = L.explode_rows(drawn, df.columns, "_lists", "_at", "_one")
    ids = F.col("_one.ids")
    if shuffle:
        ids = L.shuffled(ids, seed, row_key, F.col("_one.pos"))
    out = {inview: ids, clicked: F.col("_one.clicked")}
    kept = [out[c].alias(c) if c in out else F.col(c) for c in df.columns]
    return rows.select(*kept, F.col("_one.pos").alias(click_pos))


def candidate_rows(
    df: DataFrame, keep: list[str], inview=S.INVIEW, labels=S.LABELS, first_pos: str | None = None
) -> DataFrame:
    """One row per candidate: ``keep`` columns, ``pos`` (from 1), ``article_id``, ``label``.

    Only the columns in ``keep`` are repeated; join wide per-user data afterwards
    instead of copying it to every candidate.
    """
    S.check_columns(df, [inview, *keep])
    at = F.col("i") + 1 if first_pos is None else F.col("i") + F.col(first_pos)
    extra = [first_pos] if first_pos else []
    has_labels = labels in df.columns
    zipped = F.arrays_zip(F.col(inview).alias("a"), F.col(labels).alias("y")) if has_labels else F.col(inview)
    rows = L.explode_rows(df, [*keep, *extra], zipped, "i", "c")
    if has_labels:
        value = [F.col("c.a").alias(S.ARTICLE_ID), F.col("c.y").cast("int").alias("label")]
    else:
        value = [F.col("c").alias(S.ARTICLE_ID)]
    return rows.select(*keep, at.cast("bigint").alias("pos"), *value)


def attach_scores(
    df: DataFrame, scored: DataFrame, key: list[str], pos="pos", score="score", inview=S.INVIEW, scores=S.SCORES
) -> DataFrame:
    """Add the list of scores of each record, in the order of its candidates.

    ``scored`` has one row per (key, position).  Fails when a record's scores are
    too many or too few.  To score the candidates of the records themselves, see
    :func:`score_lists`, which needs no join.
    """
    S.check_columns(df, [inview, *key])
    S.check_columns(scored, [*key, pos, score])
    collected = scored.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(score).alias("s")))).alias("_s")
    )
    values = F.coalesce(F.transform("_s", lambda t: t["s"]), F.array().cast("array<double>"))
    problem = L.fail(F.lit("scores and candidates differ in number for "), F.to_json(F.struct(*key)))
    checked = F.when(F.size(values) == F.size(inview), values).otherwise(problem)
    return df.join(collected, key, "left").withColumn(scores, checked).drop("_s")


def score_lists(df: DataFrame, key: list[str], score, keep: list[str] = (), inview=S.INVIEW, scores=S.SCORES) -> DataFrame:
    """``key``, ``keep``, the in-view list and its list of scores, from one pass over the records.

    ``score`` maps the exploded candidates (key, keep, ``pos`` from 1, ``article_id``) to the same
    rows with a column ``score``; they are collected once.  Records without candidates give no row.
    """
    S.check_columns(df, [inview, *key, *keep])
    rows = L.explode_rows(df, [*key, *keep], inview, "_i", S.ARTICLE_ID).withColumn("pos", (F.col("_i") + 1).cast("bigint"))
    element = F.struct("pos", F.col(S.ARTICLE_ID).alias("a"), F.col("score").alias("s"))
    lists = score(rows.drop("_i")).groupBy(*key, *keep).agg(F.sort_array(F.collect_list(element)).alias("_l"))
    return lists.select(
        *key, *keep, F.transform("_l", lambda t: t["a"]).alias(inview), F.transform("_l", lambda t: t["s"]).alias(scores)
    )


def join_history(
    behaviors: DataFrame, history: DataFrame, user=S.USER_ID, hot_from: DataFrame | None = None
) -> DataFrame:
    """Left join of impressions with the history record of their user.

    ``hot_from``: see :func:`feedmill.operators.skew.lookup_join`.
    """
    S.check_columns(behaviors, [user])
    S.check_columns(history, [user])
    return lookup_join(behaviors, history, user, "left", hot_from=hot_from)


def map_ids(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    key: list[str],
    drop_nulls: bool = False,
    fill_nulls=None,
    lookup_key: str = "key",
    lookup_value: str = "value",
) -> DataFrame:
    """Replace each id of a list by its value in ``lookup`` (one row per key).

    Unknown ids become null, or ``fill_nulls``, or are dropped.  A null or empty
    list counts as one unknown id; a list with nothing left becomes null.
    ``key`` must identify the row of ``df``.
    """
    S.check_columns(df, [column, *key])
    ids = df.select(*key, F.posexplode_outer(column).alias("_i", "_id"))
    values = no_larger(lookup.select(F.col(lookup_key).alias("_id"), F.col(lookup_value).alias("_v")), lookup)
    found = lookup_join(ids, values, "_id", "left")
    value = F.col("_v")
    if drop_nulls:
        found = found.where(value.isNotNull())
    elif fill_nulls is not None:
        value = F.coalesce(value, F.lit(fill_nulls))
    # The elements of one record leave one task, so the lists are rebuilt before the shuffle.
    lists = found.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_i").alias("i"), value.alias("v")))).alias("_l")
    )
    mapped = lists.select(*key, F.transform("_l", lambda t: t["v"]).alias("_l"))
    return (
        df.join(mapped, key, "left")
        .select(*[F.col("_l").alias(c) if c == column else F.col(c) for c in df.columns])
    )
