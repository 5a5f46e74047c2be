"""Ranking, click metrics and losses over scored candidates.

All sums are combined before the shuffle.  Log-sum-exp is summed per integer
part of the score, which keeps every term between 1 and e, and the few parts of
a group are merged afterwards: no pass over the group's rows by a single task.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmill import schema as S
from feedmill.functions import lists as L
from feedmill.operators.ordering import number_within, running_sum
from feedmill.operators.skew import fits_a_task, largest_group, lookup_join
from feedmill.operators.storage import materialised


def rank_within(df: DataFrame, group: str, pos: str, score: str, name: str = "rank", largest=None) -> DataFrame:
    """Rank of each candidate in its impression, 1 = highest; on ties the later position first."""
    return number_within(df, [group], [F.desc(score), F.desc(pos)], name, largest=largest)


def top_candidate(df: DataFrame, group: str, pos: str, value: str, score: str) -> DataFrame:
    """The candidate that :func:`rank_within` ranks first."""
    best = F.max_by(F.struct(F.col(value), F.col(score)), F.struct(F.col(score), F.col(pos)))
    return df.groupBy(group).agg(best.alias("_b")).select(group, F.col(f"_b.{value}"), F.col(f"_b.{score}"))


# What a tied pair counts, per rule.
_TIES = {"strict": 0.0, "half": 0.5}


def auc(df: DataFrame, label: str = "label", score: str = "score", ties=("strict",)) -> DataFrame:
    """Rows (ties, auc): share of (clicked, unclicked) pairs ranked right, over all rows.

    A tie counts 0 under "strict" and one half under "half"; one row per rule
    asked for.  Null without both classes.  Rows are first added up per distinct
    score, so the pairs are never formed.
    """
    if not ties or not set(ties) <= set(_TIES):
        raise ValueError(f"ties must be chosen from {list(_TIES)}, not {ties!r}")
    per_score = df.groupBy(score).agg(
        F.sum(F.col(label).cast("bigint")).alias("_pos"), F.sum(1 - F.col(label).cast("bigint")).alias("_neg")
    )
    below = running_sum(per_score, [F.col(score)], "_neg", "_below")
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    totals = below.agg(
        F.sum(pos * F.col("_below")).alias("won"),
        F.sum(pos * neg).alias("tied"),
        (F.sum(pos) * F.sum(neg)).alias("pairs"),
    )
    rules = F.array(*[F.struct(F.lit(t).alias("ties"), F.lit(_TIES[t]).alias("worth")) for t in ties])
    rows = totals.select("won", "tied", "pairs", F.inline(rules))
    share = (F.col("won") + F.col("worth") * F.col("tied")) / F.col("pairs")
    return rows.select("ties", F.when(F.col("pairs") > 0, share).alias("auc"))


def accuracy_top1(df: DataFrame, scores: str = S.SCORES, labels: str = S.LABELS) -> DataFrame:
    """Share of training lists whose highest score is at the click."""
    hit = L.top_position(F.col(scores)) == L.label_position(F.col(labels))
    return df.agg(F.avg(hit.cast("int")).alias("accuracy"))


def accuracy_threshold(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Share of candidates on the right side of probability one half; exactly half counts as 0."""
    hit = (F.col(score) > 0) == (F.col(label) == 1)
    return df.agg(F.avg(hit.cast("int")).alias("accuracy"))


def npratio(df: DataFrame, label: str = "label") -> DataFrame:
    """Unclicked candidates per clicked one."""
    pos = F.sum(F.col(label).cast("bigint"))
    neg = F.sum(1 - F.col(label).cast("bigint"))
    return df.agg((neg / pos).alias("npratio"))


def _log_sum_exp_parts(df: DataFrame, group: list[str], score: Column, extra: list[Column]) -> DataFrame:
    whole = F.floor(score)
    return df.groupBy(*group, whole.alias("_k")).agg(F.sum(F.exp(score - whole)).alias("_z"), *extra)


def _merge_parts(extra: list[Column]) -> list[Column]:
    return [F.max("_k").alias("_m"), F.collect_list(F.struct("_k", "_z")).alias("_parts"), *extra]


def _log_sum_exp() -> Column:
    top = F.col("_m")
    total = F.aggregate("_parts", F.lit(0.0), lambda acc, p: acc + p["_z"] * F.exp(p["_k"] - top))
    return top + F.ln(total)


def log_sum_exp(df: DataFrame, group: list[str], score: str, name: str = "lse") -> DataFrame:
    """ln(sum(exp(score))) per group, safe for large scores and for large groups."""
    parts = _log_sum_exp_parts(df, group, F.col(score), [])
    return parts.groupBy(*group).agg(*_merge_parts([])).select(*group, _log_sum_exp().alias(name))


def softmax_within(df: DataFrame, group: str, score: str, name: str = "prob", largest=None) -> DataFrame:
    """Softmax of the scores of each impression.

    Impressions that fit a task need one pass of a window; otherwise the
    log-sum-exp of each impression is joined back to its candidates.
    """
    if largest is None:
        largest = largest_group(df, [group])
    if fits_a_task(largest):
        w = Window.partitionBy(group)
        shifted = df.withColumn("_e", F.exp(F.col(score) - F.max(score).over(w)))
        return shifted.withColumn(name, F.col("_e") / F.sum("_e").over(w)).drop("_e")
    joined = lookup_join(df, log_sum_exp(df, [group], score, "_lse"), group, "left")
    return joined.withColumn(name, F.exp(F.col(score) - F.col("_lse"))).drop("_lse")


def loss_listwise(
    df: DataFrame, order: list, batch_size: int, scores: str = S.SCORES, labels: str = S.LABELS
) -> DataFrame:
    """Cross-entropy of the click against its training list: batch means, then their mean."""
    # All batches but the last are full, so only the last lists in order need to be told apart.
    loss = L.list_cross_entropy(F.col(scores), L.label_position(F.col(labels)))
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    losses = materialised(df.select(*keys, loss.alias("_loss")), "losses")
    total = losses.agg(F.count("_loss").alias("n"), F.sum("_loss").alias("sum")).first()
    full, rest = divmod(total["n"], batch_size)
    newest = [F.desc(f"_o{i}") for i in range(len(order))]
    last = losses.orderBy(*newest).limit(rest).agg(F.coalesce(F.sum("_loss"), F.lit(0.0)).alias("last"))
    means = (F.lit(total["sum"]) - F.col("last")) / batch_size + F.col("last") / max(rest, 1)
    return last.select(F.when(F.lit(total["n"] > 0), means / max(full + (rest > 0), 1)).alias("loss"))


def loss_batch(df: DataFrame, batch: str, label: str = "label", score: str = "score") -> DataFrame:
    """Cross-entropy with one softmax over all candidates of a batch, summed at the clicks.

    ``df`` has one row per candidate with its batch; the mean over batches is returned.
    """
    y = F.col(label).cast("double")
    parts = _log_sum_exp_parts(
        df, [batch], F.col(score), [F.sum(y).alias("_y"), F.sum(y * F.col(score)).alias("_ys")]
    )
    merged = parts.groupBy(batch).agg(*_merge_parts([F.sum("_y").alias("_y"), F.sum("_ys").alias("_ys")]))
    return merged.select((F.col("_y") * _log_sum_exp() - F.col("_ys")).alias("_l")).agg(F.avg("_l").alias("loss"))
