"""Whole-row operators: sampling, shuffling, heads, batches, flags, reports."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Window, functions as F

from feedmill import schema as S
from feedmill.functions.hashing import seeded_int, seeded_md5
from feedmill.operators.ordering import dense_index
from feedmill.operators.skew import fits_a_task, lookup_join
from feedmill.operators.storage import materialised

DEFAULT_SEED = 123
_HASH_SPACE = 1 << 32
_ACCURACY = 100_000  # of the quantile sketch: ranks are right within this part of the rows


def head(df: DataFrame, n: int, order: list) -> DataFrame:
    """The first ``n`` rows in ``order``: a top-n per task, then one merge of those."""
    return df.orderBy(*order).limit(n)


def sample_by_hash(df: DataFrame, fraction: float, key: list[str], seed=DEFAULT_SEED) -> DataFrame:
    """Keep a row when the hash of its key is below ``fraction``; no shuffle, size varies slightly."""
    return df.where(seeded_int(seed, *[F.col(k) for k in key]) < int(fraction * _HASH_SPACE))


def _around(rank: float, size: int) -> list[float]:
    """Shares of the rows a little before and after ``rank``: the sketch's error on either side."""
    return [max(0.0, rank / size - 2 / _ACCURACY), min(1.0, rank / size + 2 / _ACCURACY)]


def sample_exact(df: DataFrame, fraction: float, key: list[str], seed=DEFAULT_SEED) -> DataFrame:
    """Exactly floor(rows * fraction) rows: those with the smallest md5 of their unique key.

    The keys are written once, and counted into a mergeable quantile sketch on the way.  It gives two
    hashes close before and after the end of the sample; one pass counts what lies below and between
    them, and ordering those between finds the last row.  (Should the sketch have erred, or the rows between not fit a task,
    the same is done again within the part that holds the end.)  The sample itself is then a plain filter: no shuffle of the table.
    """
    columns = [F.col(k) for k in key]
    seen = Observation()
    hashed = df.select(seeded_md5(seed, *columns).alias("_h"), *columns)
    hashed = hashed.withColumn("_place", F.conv(F.substring("_h", 1, 15), 16, 10).cast("bigint"))  # order of the first 60 bits

    def ends(shares):
        return F.percentile_approx("_place", shares, _ACCURACY).alias("ends")

    share = min(max(fraction, 0.0), 1.0)
    keys = materialised(hashed.observe(seen, F.count(F.lit(1)).alias("n"), ends(_around(share, 1))), "sample-keys")
    size = seen.get["n"]
    want = int(size * fraction)
    if want == 0:
        return df.where(F.lit(False))
    low, high = seen.get["ends"]
    least, most, rank = 0, (1 << 60) - 1, min(want, size)
    while True:
        inside, before = keys.where(F.col("_place").between(least, most)), size
        counts = inside.agg(F.count_if(F.col("_place") < low).alias("below"), F.count_if(F.col("_place") <= high).alias("upto")).first()
        below, upto = counts["below"], counts["upto"]
        if below < rank <= upto:
            least, most, rank, size = low, high, rank - below, upto - below
        elif rank <= below:
            most, size = low - 1, below
        else:
            least, rank, size = high + 1, rank - upto, size - upto
        if fits_a_task(size) or least >= most:
            break
        if size < before:
            low, high = keys.where(F.col("_place").between(least, most)).agg(ends(_around(rank, size))).first()["ends"]
        else:  # the sketch is too rough to part them; hashes are spread evenly
            low = high = (least + most) // 2
    place = F.struct(F.col("_h").alias("h"), *columns)
    last = keys.where(F.col("_place").between(least, most)).select(place.alias("p")).orderBy("p").limit(rank)
    end_place = last.agg(F.max("p").alias("p"))
    row, kind = end_place.first()["p"], end_place.schema["p"].dataType
    end_place = F.struct(*[F.lit(v) for v in row]).cast(kind)
    return df.where(F.struct(seeded_md5(seed, *columns).alias("h"), *columns) <= end_place)


def shuffle_rows(df: DataFrame, key: list[str], seed=DEFAULT_SEED, position: str = "shuffled_pos") -> DataFrame:
    """Seeded random order of the rows, exposed as a column counted from 0."""
    columns = [F.col(k) for k in key]
    tagged = df.withColumn("_h", seeded_md5(seed, *columns))
    return dense_index(tagged, [F.col("_h"), *columns], position).drop("_h")


def assign_batches(df: DataFrame, order: list, size: int, batch: str = "batch_id", slot: str = "slot") -> DataFrame:
    """Batches of ``size`` rows in ``order``; the last one may be smaller, none is dropped."""
    return (
        dense_index(df, order, "_i")
        .withColumn(batch, F.floor(F.col("_i") / size).cast("bigint"))
        .withColumn(slot, F.pmod(F.col("_i"), F.lit(size)).cast("bigint"))
        .drop("_i")
    )


def flag_known_users(
    df: DataFrame, known: DataFrame | list, user_col: str = S.USER_ID, flag_col: str = S.KNOWN_USER
) -> DataFrame:
    """True where the user occurs in ``known``: a DataFrame with that column, or a short list."""
    S.check_columns(df, [user_col])
    if not isinstance(known, DataFrame):
        return df.withColumn(flag_col, F.coalesce(F.col(user_col).isin(list(known)), F.lit(False)))
    # Written once, because the join looks at its size first.
    seen = materialised(known.select(user_col).distinct().withColumn(flag_col, F.lit(True)), "known-users", sized=True)
    return lookup_join(df, seen, user_col, "left").withColumn(
        flag_col, F.coalesce(F.col(flag_col), F.lit(False))
    )


def row_drop_report(before: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row: rows_before, rows_after, pct_dropped (two decimals; null for an empty table).

    ``step`` maps ``before`` to what is left.  Both are counted in a single run: the rows before are
    observed on their way into the step.
    """
    seen = Observation()
    counted = before.observe(seen, F.count(F.lit(1)).alias("n"))
    n_after = step(counted).agg(F.count(F.lit(1))).first()[0]
    n_before = seen.get["n"]
    counts = before.sparkSession.createDataFrame([(n_before, n_after)], "rows_before bigint, rows_after bigint")
    share = (F.col("rows_before") - F.col("rows_after")) / F.nullif(F.col("rows_before"), F.lit(0))
    return counts.withColumn("pct_dropped", F.round(share * 100, 2))
