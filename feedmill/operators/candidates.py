"""The list operators again, over one row per (impression, position).

For impressions too large for one record: positions come from
:func:`number_within`, joins use (impression, position) as the key, so that a
huge impression spreads over many tasks.  Random choices hash the same values as
the list operators, so both give the same answer.
"""

from pyspark.sql import DataFrame, functions as F

from feedmill.functions.hashing import seeded_int, seeded_md5
from feedmill.operators.ordering import first_within, number_within
from feedmill.operators.rows import DEFAULT_SEED
from feedmill.operators.skew import lookup_join


def _by_hash(seed, *parts):
    return seeded_md5(seed, *[F.col(p) for p in parts])


def _counting(n):
    return F.sequence(F.lit(1).cast("bigint"), F.lit(n).cast("bigint"))


def shuffle_within(df: DataFrame, group: str, pos: str, name: str, seed=DEFAULT_SEED, largest=None) -> DataFrame:
    """Seeded random position of each row in its group, from 1."""
    tagged = df.withColumn("_h", _by_hash(seed, group, pos))
    return number_within(tagged, [group], [F.col("_h"), F.col(pos)], name, largest=largest).drop("_h")


def sample_within(df: DataFrame, group: str, pos: str, n: int, name: str = "draw", seed=DEFAULT_SEED) -> DataFrame:
    """``n`` random rows of each group, numbered from 1.  A smaller group is an error."""
    short = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < n)
    if not short.isEmpty():
        raise ValueError(f"cannot draw {n} rows without replacement from a smaller group")
    tagged = df.withColumn("_h", _by_hash(seed, group, pos))
    return first_within(tagged, [group], [F.col("_h"), F.col(pos)], n, name).drop("_h")


def _fetch(wanted: DataFrame, pool: DataFrame, group: str, value: str) -> DataFrame:
    """Rows of ``wanted`` with the pool value at (group, _at); null where there is none.

    Many draws may want the same element of a small pool, so the join key may be
    hot; ``lookup_join`` splits such keys off.
    """
    def keyed(df):
        return df.withColumn("_k", F.concat_ws("|", F.col(group).cast("string"), F.col("_at").cast("string")))

    values = keyed(pool.select(group, "_at", value)).select("_k", value)
    return lookup_join(keyed(wanted), values, "_k", "left").drop("_k", "_at")


def sample_within_replacing(
    df: DataFrame, group: str, pos: str, value: str, n: int, name: str = "draw", seed=DEFAULT_SEED
) -> DataFrame:
    """``n`` independent draws of ``value`` per group.  ``pos`` must count from 1."""
    draws = (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(name, F.explode(_counting(n)))
        .withColumn("_at", F.pmod(seeded_int(seed, F.col(group), F.col(name)), F.col("_n")) + 1)
        .drop("_n")
    )
    return _fetch(draws, df.withColumn("_at", F.col(pos)), group, value)


def sample_negatives_within(
    df: DataFrame,
    npratio: int,
    group: str,
    pos: str,
    value: str,
    clicked: str,
    shuffle: bool = False,
    with_replacement: bool = True,
    seed=DEFAULT_SEED,
    largest: int | None = None,
) -> DataFrame:
    """Training lists as rows (group, click_pos, slot, value, label)."""
    negatives = df.where(F.col(clicked) == 0).select(group, pos, value)
    pool = number_within(negatives, [group], [F.col(pos)], "_at", start=0, largest=largest)
    if not with_replacement:
        pool = pool.withColumn("_h", seeded_md5(seed, F.col(group), F.col("_at") + 1)).drop("_at")
        pool = number_within(pool, [group], [F.col("_h"), F.col(pos)], "_at", start=0, largest=largest)
    sizes = negatives.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    clicks = number_within(
        df.where(F.col(clicked) == 1).select(group, pos, F.col(value).alias("_positive")),
        [group], [F.col(pos)], "click_pos", largest=largest,
    )
    clicks = lookup_join(clicks.drop(pos), sizes, group, "left")
    if not with_replacement:
        if not clicks.where(F.coalesce("_n", F.lit(0)) < npratio).isEmpty():
            raise ValueError(f"cannot draw {npratio} negatives without replacement from a smaller pool")
        offset = seeded_int(seed, F.col(group), F.col("click_pos")) + F.col("slot") - 1
    else:
        offset = seeded_int(seed, F.col(group), F.col("click_pos"), F.col("slot"))
    draws = (
        clicks.withColumn("slot", F.explode(_counting(npratio)))
        .withColumn("_at", F.pmod(offset, F.col("_n")))
        .select(group, "click_pos", "slot", "_at")
    )
    drawn = _fetch(draws, pool, group, value).withColumn("label", F.lit(0))
    positives = clicks.select(
        group, "click_pos", F.lit(npratio + 1).cast("bigint").alias("slot"),
        F.col("_positive").alias(value), F.lit(1).alias("label"),
    )
    rows = drawn.select(group, "click_pos", "slot", value, "label").unionByName(positives)
    if not shuffle:
        return rows
    tagged = rows.withColumn("_h", _by_hash(seed, group, "click_pos", "slot")).withColumnRenamed("slot", "_slot")
    return number_within(
        tagged, [group, "click_pos"], [F.col("_h"), F.col("_slot")], "slot", largest=npratio + 1
    ).drop("_h", "_slot")
