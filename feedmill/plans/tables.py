"""The recommendation tables, derived from the star schema.

An order is an impression shown to a customer, its parts are the candidate
articles, and a returned part is a click.  Orders before 1998 give the click
histories; later years are split into train, validation and test.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedmill import schema as S
from feedmill.functions.hashing import seeded_int
from feedmill.functions.text import joined_with_space
from feedmill.operators.limits import LIMITS
from feedmill.operators.ordering import first_within, number_within
from feedmill.operators.skew import dealt_by, fits_a_list, fits_a_task, hot_keys, largest_group, parts_of, small_enough

# [start, end) of the impression time per split.
SPLITS = {
    "history": (None, "1998-01-01"),
    "train": ("1998-01-01", "2000-01-01"),
    "validation": ("2000-01-01", "2001-01-01"),
    "test": ("2001-01-01", None),
}


# Looked up once per session and state of a table: the schema in a file footer, and the
# size of the largest impression, which only decides between two exact ways.
_SCHEMAS = {}
_LARGEST = {}
_ROWS = {}
# A core should have so much of a file at least before a scan is left as it is.
_BYTES_PER_CORE = 16 << 20


def _state(spark: SparkSession, path: str) -> tuple:
    """Session, path, time of the last change and bytes of a table: another state after it was written anew."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(context._jsc.hadoopConfiguration())
    found = files.getContentSummary(root)
    newest = max([f.getModificationTime() for f in files.listStatus(root)], default=0)
    return context.applicationId, path, newest, found.getLength()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    key = _state(spark, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def documents(spark, sf_dir) -> DataFrame:
    """The documents, spread over the cores when their files are small."""
    docs = table(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    size = _state(spark, f"{sf_dir}/documents.parquet")[-1]
    return docs.repartition(cores, "doc_id") if size < cores * _BYTES_PER_CORE else docs


def in_split(time, split: str | None):
    start, end = SPLITS[split] if split else (None, None)
    keep = F.lit(True)
    if start:
        keep = keep & (time >= F.lit(start).cast("timestamp_ntz"))
    if end:
        keep = keep & (time < F.lit(end).cast("timestamp_ntz"))
    return keep


def impression_times(spark, sf_dir, split=None) -> DataFrame:
    """(impression_id, user_id, impression_time); the time range reaches the scan."""
    orders = table(spark, sf_dir, "orders").where(in_split(F.col("o_orderdate"), split))
    return orders.select(
        F.col("o_orderkey").alias(S.IMPRESSION_ID),
        F.col("o_custkey").alias(S.USER_ID),
        F.col("o_orderdate").alias(S.IMPRESSION_TIME),
    )


def _lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(S.IMPRESSION_ID),
        F.col("l_partkey").alias(S.ARTICLE_ID),
        F.col("l_linenumber").alias("ln"),
        (F.col("l_returnflag") == "R").cast("int").alias("clicked"),
    )


def id_pairs(spark, sf_dir, split=None) -> DataFrame:
    """(user_id, article_id) of the lines, unmerged: where hot ids are looked for."""
    parts = parts_of(spark, _rows(spark, sf_dir, "lineitem"))
    lines, times = _lines(spark, sf_dir).select(S.IMPRESSION_ID, S.ARTICLE_ID), impression_times(spark, sf_dir, split)
    by_id = [S.IMPRESSION_ID]
    return dealt_by(lines, by_id, parts).join(dealt_by(times, by_id, parts), by_id).select(S.USER_ID, S.ARTICLE_ID)


def largest_impression(spark, sf_dir) -> int:
    """Checked bound on the candidates of one impression: its lines before duplicates merge."""
    key = _state(spark, f"{sf_dir}/lineitem.parquet")
    if key not in _LARGEST:
        _LARGEST[key] = largest_group(_lines(spark, sf_dir), [S.IMPRESSION_ID])
    return _LARGEST[key]


def _rows(spark, sf_dir, name: str) -> int:
    """Rows of a table, counted once per state of it."""
    key = _state(spark, f"{sf_dir}/{name}.parquet")
    if key not in _ROWS:
        _ROWS[key] = table(spark, sf_dir, name).count()
    return _ROWS[key]


def _few_orders(spark, sf_dir) -> bool:
    """Whether even all orders may be broadcast: three numbers each."""
    n = _rows(spark, sf_dir, "orders")
    return n <= LIMITS.broadcast_max_rows and n * 40 <= LIMITS.broadcast_max_bytes


def items(spark, sf_dir, split=None, largest: int | None = None) -> DataFrame:
    """One row per (impression, article): first line number, clicked 0/1.

    While no impression is hot, the lines are placed by impression once and
    everything per impression happens there.  Otherwise hot impressions are joined
    to their order by broadcast, and duplicates are merged per (impression,
    article) before the shuffle.  The number of partitions follows the number of lines, so
    that a task holds about as many lines whatever the size of the table.
    """
    if largest is None:
        largest = largest_impression(spark, sf_dir)
    lines, times = _lines(spark, sf_dir), impression_times(spark, sf_dir, split)
    hot = hot_keys(lines, S.IMPRESSION_ID) if largest > LIMITS.hot_min_rows else []
    parts = parts_of(spark, _rows(spark, sf_dir, "lineitem"))
    keys = [S.IMPRESSION_ID, S.USER_ID, S.IMPRESSION_TIME, S.ARTICLE_ID]

    def merged(rows):
        return rows.groupBy(*keys).agg(F.min("ln").alias("ln"), F.max("clicked").alias("clicked"))

    def joined(rows):
        by_id = [S.IMPRESSION_ID]
        return dealt_by(rows, by_id, parts).join(dealt_by(times, by_id, parts), S.IMPRESSION_ID)

    if hot:
        is_hot = F.col(S.IMPRESSION_ID).isin(hot)
        split_off = lines.where(is_hot).join(F.broadcast(times.where(is_hot)), S.IMPRESSION_ID)
        return merged(joined(lines.where(~is_hot))).unionByName(merged(split_off))
    if _few_orders(spark, sf_dir) or small_enough(times):
        near = lines.join(F.broadcast(times), S.IMPRESSION_ID)
        return merged(near.repartition(S.IMPRESSION_ID) if parts is None else near.repartition(parts, S.IMPRESSION_ID))
    return merged(joined(lines))


def candidates(spark, sf_dir, split=None, largest: int | None = None) -> DataFrame:
    """:func:`items` with ``pos``, the position in the impression from 1."""
    if largest is None:
        largest = largest_impression(spark, sf_dir)
    rows = items(spark, sf_dir, split, largest)
    return number_within(
        rows, [S.IMPRESSION_ID], [F.col("ln"), F.col(S.ARTICLE_ID)], "pos", largest=largest
    ).drop("ln")


def behaviors(spark, sf_dir, split=None, largest: int | None = None) -> DataFrame:
    """Impression records with in-view and clicked lists; no click gives a null list.

    One record per impression.  If some impression has too many candidates for a
    record this is an error; :func:`pages` and :func:`candidates` have no such limit.
    """
    if largest is None:
        largest = largest_impression(spark, sf_dir)
    if not fits_a_list(largest):
        raise ValueError(f"an impression has up to {largest} candidates, too many for one record: use pages() or candidates()")
    return pages(spark, sf_dir, split, largest).drop("page", "first_pos")


def largest_history(spark, sf_dir) -> int:
    """Checked bound on the clicks of one user: the lines of the history period, which need two narrow columns."""
    return largest_group(id_pairs(spark, sf_dir, "history"), [S.USER_ID])


def histories(spark, sf_dir, largest: int | None = None) -> DataFrame:
    """History records with all clicks of a user, oldest first.

    If some user may have too many clicks for a record this is an error; :func:`history_pages`
    and :func:`history_rows` have no such limit.
    """
    if largest is None:
        largest = largest_history(spark, sf_dir)
    if not fits_a_list(largest):
        raise ValueError(f"a user has up to {largest} clicks, too many for one record: use history_pages() or history_rows()")
    listed = F.sort_array(F.collect_list(F.struct(*_HISTORY_ORDER))).alias("_l")
    records = history_clicks(spark, sf_dir).groupBy(S.USER_ID).agg(listed)
    return records.select(S.USER_ID, F.transform("_l", lambda t: t[S.ARTICLE_ID]).alias(S.HISTORY))


def pages(spark, sf_dir, split=None, largest: int | None = None) -> DataFrame:
    """Impression records for operators that look at each candidate by itself.

    ``page`` and ``first_pos`` are 0 and 1 for an impression that fits one record.
    If some impression has too many candidates for a list, records hold at most
    LIMITS.list_max_items each and a long impression has several pages.
    """
    if largest is None:
        largest = largest_impression(spark, sf_dir)
    keys = [S.IMPRESSION_ID, S.USER_ID, S.IMPRESSION_TIME]
    page_rows = LIMITS.list_max_items
    if fits_a_list(largest):
        rows = items(spark, sf_dir, split, largest)
        order = ["ln", S.ARTICLE_ID]
    else:
        rows = candidates(spark, sf_dir, split, largest)
        rows = rows.withColumn("page", F.floor((F.col("pos") - 1) / page_rows).cast("bigint"))
        keys, order = [*keys, "page"], ["pos", S.ARTICLE_ID]
    shown = F.sort_array(F.collect_list(F.struct(*order, "clicked"))).alias("_s")
    page = [] if "page" in keys else [F.lit(0).cast("bigint").alias("page")]
    records = rows.groupBy(*keys).agg(shown, *page)
    clicked = F.transform(F.filter("_s", lambda t: t["clicked"] == 1), lambda t: t[S.ARTICLE_ID])
    any_click = F.exists("_s", lambda t: t["clicked"] == 1)
    return records.select(
        S.IMPRESSION_ID,
        "page",
        (F.col("page") * page_rows + 1).alias("first_pos"),
        S.USER_ID,
        S.IMPRESSION_TIME,
        F.transform("_s", lambda t: t[S.ARTICLE_ID]).alias(S.INVIEW),
        F.when(any_click, clicked).alias(S.CLICKED),
    )


_HISTORY_ORDER = [S.IMPRESSION_TIME, S.IMPRESSION_ID, "ln", S.ARTICLE_ID]


def history_clicks(spark, sf_dir) -> DataFrame:
    """Clicks of the history period, one row each."""
    return items(spark, sf_dir, "history").where("clicked = 1").select(S.USER_ID, *_HISTORY_ORDER)


def history_rows(spark, sf_dir, largest: int | None = None) -> DataFrame:
    """(user_id, hist_pos, article_id), oldest click first.

    Where a user's clicks fit a task, the clicks are dealt to as many partitions as
    the lines, of which they are a part.
    """
    if largest is None:
        largest = largest_history(spark, sf_dir)
    order = [F.col(c) for c in _HISTORY_ORDER]
    clicks = history_clicks(spark, sf_dir)
    if fits_a_task(largest):
        clicks = dealt_by(clicks, [S.USER_ID], parts_of(spark, _rows(spark, sf_dir, "lineitem")))
    return number_within(clicks, [S.USER_ID], order, "hist_pos", largest=largest).select(
        S.USER_ID, "hist_pos", S.ARTICLE_ID
    )


def history_pages(spark, sf_dir, largest: int | None = None, page_rows: int | None = None) -> DataFrame:
    """History records of at most ``page_rows`` clicks (LIMITS.list_max_items), oldest first, with ``page`` and ``first_pos``."""
    page_rows = page_rows or LIMITS.list_max_items
    rows = history_rows(spark, sf_dir, largest)
    rows = rows.withColumn("page", F.floor((F.col("hist_pos") - 1) / page_rows).cast("bigint"))
    listed = F.sort_array(F.collect_list(F.struct("hist_pos", S.ARTICLE_ID))).alias("_l")
    return rows.groupBy(S.USER_ID, "page").agg(listed).select(
        S.USER_ID,
        "page",
        (F.col("page") * page_rows + 1).alias("first_pos"),
        F.transform("_l", lambda t: t[S.ARTICLE_ID]).alias(S.HISTORY),
    )


def recent_history(spark, sf_dir, n: int) -> DataFrame:
    """History records of the newest ``n`` clicks per user, oldest first.

    Every task drops a user's older clicks before the shuffle, so a very active
    user costs no more than another.
    """
    newest = first_within(history_clicks(spark, sf_dir), [S.USER_ID], [F.desc(c) for c in _HISTORY_ORDER], n, "_r")
    records = newest.groupBy(S.USER_ID).agg(
        F.reverse(F.sort_array(F.collect_list(F.struct("_r", S.ARTICLE_ID)))).alias("_l")
    )
    return records.select(S.USER_ID, F.transform("_l", lambda t: t[S.ARTICLE_ID]).alias(S.HISTORY))


def articles(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(S.ARTICLE_ID),
        F.col("p_name").alias(S.TITLE),
        F.col("p_type").alias(S.SUBTITLE),
        F.col("p_brand").alias(S.CATEGORY),
    )


def article_text(spark, sf_dir) -> DataFrame:
    return articles(spark, sf_dir).select(
        S.ARTICLE_ID, joined_with_space(F.col(S.TITLE), F.col(S.SUBTITLE)).alias("text")
    )


def embeddings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def hash_score(impression=None, article=None):
    """A score in [-0.5, 0.5) with ties, the same in every engine."""
    impression = F.col(S.IMPRESSION_ID) if impression is None else impression
    article = F.col(S.ARTICLE_ID) if article is None else article
    return F.pmod(seeded_int("s", impression, article), F.lit(100)).cast("double") / 100 - 0.5
