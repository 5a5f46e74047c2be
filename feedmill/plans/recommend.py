"""The two chains users run: training lists, and ranked predictions."""

from pyspark.sql import DataFrame, functions as F

from feedmill import schema as S
from feedmill.functions import lists as L
from feedmill.functions.lists import rank_by_score
from feedmill.operators import attention as A
from feedmill.operators import candidates as C
from feedmill.operators import encoding as E
from feedmill.operators import impressions as I
from feedmill.operators import rows as R
from feedmill.operators.ordering import first_within
from feedmill.operators.skew import largest_group, lookup_join
from feedmill.operators.storage import materialised


def impressions_with_history(
    behaviors: DataFrame,
    history: DataFrame,
    history_size: int,
    padding_value=0,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Impressions beside the newest ``history_size`` clicks of their user, padded on the left."""
    if "first_pos" in history.columns:
        history = _newest(history, history_size)
    recent = I.truncate_history(history.select(S.USER_ID, S.HISTORY), S.HISTORY, history_size, padding_value)
    return I.join_history(behaviors, recent, hot_from=hot_from)


def _newest(pages: DataFrame, n: int) -> DataFrame:
    """History records of the newest ``n`` clicks from paged histories; a page gives no more than ``n`` rows."""
    last = F.slice(F.reverse(S.HISTORY), 1, n)
    end = F.col("first_pos") + F.size(S.HISTORY)
    rows = L.explode_rows(pages.withColumn("_end", end), [S.USER_ID, "_end"], last, "_i", S.ARTICLE_ID)
    newest = first_within(rows, [S.USER_ID], [F.desc("_end"), F.col("_i")], n, "_r")
    listed = F.reverse(F.sort_array(F.collect_list(F.struct("_r", S.ARTICLE_ID)))).alias("_l")
    return newest.groupBy(S.USER_ID).agg(listed).select(S.USER_ID, F.transform("_l", lambda t: t[S.ARTICLE_ID]).alias(S.HISTORY))


def training_lists(
    behaviors: DataFrame,
    history: DataFrame,
    history_size: int = 20,
    npratio: int = 4,
    fraction: float = 1.0,
    seed=R.DEFAULT_SEED,
    padding_value=0,
) -> DataFrame:
    """Shuffled lists of one click and ``npratio`` unclicked ids, with labels and history.

    Lists are drawn before the history is joined, so that the sample fraction
    already applies to the rows that are joined.  Paged impressions are drawn from
    as rows, which gives the same lists.
    """
    if "page" in behaviors.columns:
        lists = _lists_from_pages(behaviors, npratio, seed)
    else:
        lists = behaviors.select(S.USER_ID, S.INVIEW, S.CLICKED, S.IMPRESSION_ID).transform(
            I.sample_negatives, npratio=npratio, shuffle=True, with_replacement=True, seed=seed
        )
        lists = lists.transform(I.add_labels)
    if fraction < 1.0:
        lists = R.sample_exact(lists, fraction, [S.IMPRESSION_ID, "click_pos"], seed)
    joined = impressions_with_history(lists, history, history_size, padding_value, hot_from=behaviors)
    return joined.select(*S.TRAIN_COLUMNS, "click_pos", S.LABELS)


def _lists_from_pages(pages: DataFrame, npratio: int, seed) -> DataFrame:
    """The lists of :func:`training_lists` before the history: drawn from one row per candidate."""
    shown = I.candidate_rows(pages.transform(I.add_labels), [S.IMPRESSION_ID], first_pos="first_pos")
    shown = materialised(shown.withColumnRenamed("label", "clicked"), "candidates")
    rows = C.sample_negatives_within(
        shown, npratio, S.IMPRESSION_ID, "pos", S.ARTICLE_ID, "clicked", shuffle=True, seed=seed,
        largest=largest_group(shown, [S.IMPRESSION_ID]),
    )
    element = F.struct("slot", F.col(S.ARTICLE_ID).alias("a"), F.col("label").cast("tinyint").alias("y"))
    lists = rows.groupBy(S.IMPRESSION_ID, "click_pos").agg(F.sort_array(F.collect_list(element)).alias("_l"))
    users = pages.where("page = 0").select(S.IMPRESSION_ID, S.USER_ID)
    return lookup_join(materialised(lists, "drawn-lists"), users, S.IMPRESSION_ID, "inner").select(
        S.USER_ID,
        F.transform("_l", lambda t: t["a"]).alias(S.INVIEW),
        F.transform(F.filter("_l", lambda t: t["y"] == 1), lambda t: t["a"]).alias(S.CLICKED),
        S.IMPRESSION_ID,
        "click_pos",
        F.transform("_l", lambda t: t["y"]).alias(S.LABELS),
    )


def labelled_impressions(
    behaviors: DataFrame,
    history: DataFrame,
    history_size: int = 20,
    fraction: float = 1.0,
    seed=R.DEFAULT_SEED,
    padding_value=0,
) -> DataFrame:
    """Whole impressions with labels and history, for evaluation.

    The pages of an impression are kept or left together, and keep ``page`` and ``first_pos``.
    """
    kept = behaviors
    paging = [c for c in ("page", "first_pos") if c in behaviors.columns]
    if fraction < 1.0 and paging:
        ids = R.sample_exact(behaviors.where("page = 0").select(S.IMPRESSION_ID), fraction, [S.IMPRESSION_ID], seed)
        kept = lookup_join(behaviors, materialised(ids, "kept-impressions"), S.IMPRESSION_ID, "inner")
    elif fraction < 1.0:
        kept = R.sample_exact(kept, fraction, [S.IMPRESSION_ID], seed)
    joined = impressions_with_history(kept, history, history_size, padding_value, hot_from=behaviors)
    return joined.select(*S.TRAIN_COLUMNS, *paging).transform(I.add_labels)


def encoded_articles(
    articles: DataFrame, text_columns: list[str], vocabulary_size: int, max_length: int
) -> tuple[DataFrame, str]:
    """(article_id, token ids) with a vocabulary built from the same text."""
    text, column = E.concat_columns(articles, text_columns)
    vocabulary = materialised(E.build_vocabulary(text, column, vocabulary_size), "vocabulary", sized=True)
    return E.encode_text(text, S.ARTICLE_ID, column, vocabulary, vocabulary_size, max_length)


def vector_tables(
    encoded: DataFrame,
    ids: str,
    embeddings: DataFrame,
    history: DataFrame,
    article_encoder: A.Attention,
    user_encoder: A.Attention,
    title_size: int,
    history_size: int,
) -> tuple[DataFrame, DataFrame]:
    """(users, articles): both vector tables, each written once and then reused."""
    articles = materialised(
        A.article_vectors(encoded, S.ARTICLE_ID, ids, embeddings, article_encoder, title_size),
        "article-vectors",
        sized=True,
    )
    padded = I.truncate_history(history, S.HISTORY, history_size, F.lit(A.UNKNOWN_KEY).cast("bigint"))
    users = materialised(A.user_vectors(padded, articles, user_encoder, history_size), "user-vectors", sized=True)
    return users, articles


def ranked_predictions(
    behaviors: DataFrame,
    users: DataFrame,
    articles: DataFrame,
    dim: int,
    key: list[str],
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """(key, user, in-view list, ``scores``, ``ranked_scores``) of impressions with candidates.

    The records are read once.  Scores are ranked as they are; round them before if
    candidates that differ only by the order of floating-point sums shall tie.
    """

    def score(rows):
        return A.click_scores(rows, users, articles, dim, hot_from=hot_from)

    listed = I.score_lists(behaviors, key, score, keep=[S.USER_ID])
    return listed.withColumn("ranked_scores", rank_by_score(F.col(S.SCORES)))
