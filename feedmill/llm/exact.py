"""Exact duplicates by progressive refinement.

Rows are grouped by length, then by a hash of the text's start, then by a hash of
the whole text.  Each step looks only at rows whose group of the step before has
company; the whole content is hashed for the survivors alone.
"""

from pyspark.sql import Column, DataFrame, functions as F

from feedmill.llm.tables import bytes_of, text_hash, whole
from feedmill.operators.limits import LIMITS
from feedmill.operators.storage import materialised

PREFIX_CHARS = 64


def _with_company(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The groups of at least two rows; counts are combined before the shuffle."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id``, ``group_size``, ``kept`` and the ``extra`` columns.

    Texts are equal when identical; null counts as empty.  The largest id of a
    group stays (a null id is below all others); of rows that also share that id
    one stays, the others have ``kept`` false.  An empty table gives an empty
    table.  Other columns of ``docs``, whatever their names, are not looked at;
    ``extra`` maps output names to expressions over them.

    Every step shuffles narrow rows combined per task, so a group may hold any
    share of the table: group results are joined back, never gathered.
    """
    extra = extra or {}
    text = whole(text_col)
    length, start = F.octet_length(text).cast("bigint").alias("_len"), F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("_start")
    narrow = materialised(docs.select(length, start), "exact-starts")
    # Lengths with company are broadcast within a checked size, so that a very common length
    # is not gathered; beyond it the next step looks at all rows, with the same result.
    lengths = materialised(_with_company(narrow, ["_len"]), "exact-lengths")
    if bytes_of(lengths, F.lit(32)) <= LIMITS.broadcast_max_bytes // 8:
        narrow = narrow.join(F.broadcast(lengths), "_len", "left_semi")
    starts = materialised(_with_company(narrow, ["_len", "_start"]), "exact-survivors")

    columns = [F.col(id_col).alias("_id"), length, start, text.alias("_text"), *[c.alias(f"_x{i}") for i, c in enumerate(extra.values())]]
    rows = docs.select(*columns)
    # The surviving starts are broadcast within a checked size; beyond it every text is
    # hashed in its scan.  Neither way moves a text.
    if bytes_of(starts, F.lit(64)) <= LIMITS.broadcast_max_bytes:
        rows = rows.join(F.broadcast(starts.withColumn("_survives", F.lit(True))), ["_len", "_start"], "left")
    else:
        rows = rows.withColumn("_survives", F.lit(True))
    full = [F.when(F.col("_survives"), text_hash(F.col("_text"), salt)).alias(f"_h{salt}") for salt in (1, 2)]
    rows = rows.select("_id", "_len", *full, *[f"_x{i}" for i in range(len(extra))])
    hashed = materialised(rows.withColumn("_row", F.monotonically_increasing_id()), "exact-hashes")

    keys = ["_len", "_h1", "_h2"]
    best = F.max(F.struct(F.col("_id"), (-F.col("_row")).alias("_minus"))).alias("_best")
    groups = hashed.where("_h1 IS NOT NULL").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), best).where("_n > 1")
    alone = F.col("_n").isNull()
    return hashed.join(groups, keys, "left").select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_best._id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("_row") == -F.col("_best._minus"))).alias("kept"),
        *[F.col(f"_x{i}").alias(name) for i, name in enumerate(extra)],
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_duplicates` does not keep; all columns stay as they are."""
    marked = exact_duplicates(docs, id_col, text_col, {"_all": F.struct(*[F.col(f"`{c}`") for c in docs.columns])})
    return marked.where("kept").select("_all.*")
