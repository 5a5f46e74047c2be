"""One registered query per operator, over the whole given tables."""

from pyspark.sql import DataFrame, functions as F

from feedmill import schema as S
from feedmill.functions import lists as L
from feedmill.functions import text as X
from feedmill.operators import attention as A
from feedmill.operators import candidates as C
from feedmill.operators import encoding as E
from feedmill.operators import impressions as I
from feedmill.operators import lookup as K
from feedmill.operators import metrics as M
from feedmill.operators import rows as R
from feedmill.operators import training as T
from feedmill.operators.skew import fits_a_list, join_tables
from feedmill.operators.storage import materialised, no_larger, scratch_path
from feedmill.plans import recommend as P
from feedmill.plans import tables as D
from feedmill.sources import metric_log as ML
from feedmill.sources import predictions as PF
from feedmill.sources import tables as ST

SEED = 123
NPRATIO = 4
HISTORY_SIZE = 5
HISTORY_PAGE = 100  # clicks in a record of a whole history
BATCH = 64
FRACTION = 0.2
VOCABULARY = 500
ARTICLE_VOCABULARY = 498  # ids 2..499
TEXT_LENGTH = 30
TITLE_LENGTH = 6
HEADS, HEAD_DIM, HIDDEN = 2, 4, 8
DIM = HEADS * HEAD_DIM
EMBEDDING_DIM = 64

ID, USER, ART = S.IMPRESSION_ID, S.USER_ID, S.ARTICLE_ID
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _recent(spark, sf):
    """Recent histories, written once: joins look at the size first."""
    return materialised(D.recent_history(spark, sf, HISTORY_SIZE), "recent-history")


def _joined(column):
    """A list of ids as text."""
    return F.array_join(F.col(column).cast("array<string>"), ",", "null")


# --- scans, sources, sinks -------------------------------------------------


def _layout(spark, sf, splits=(), history=True, impressions=True):
    """The tables in the layout of the click logs, written to the shared folder.

    Each split has its impressions (``None``: those of all times) and the histories.  Where
    one is too large for one record, the impressions or the histories are written as pages.
    """
    root = scratch_path(spark, "click-log")
    if history:
        clicks = D.largest_history(spark, sf)
        records = (D.histories if fits_a_list(clicks) else D.history_pages)(spark, sf, clicks)
        past = _written(records, f"{root}/histories")
    largest = D.largest_impression(spark, sf) if impressions else None
    for split in splits:
        if impressions:
            shown = (D.behaviors if fits_a_list(largest) else D.pages)(spark, sf, split, largest)
            shown.write.parquet(f"{root}/{split or 'train'}/behaviors.parquet")
        if history:
            past.write.parquet(f"{root}/{split or 'train'}/history.parquet")
    return root


def _first_pos(records):
    """The column with the position of a page's first element; None for whole records."""
    return "first_pos" if "first_pos" in records.columns else None


def _written(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query
def scan_history(spark, sf):
    records = ST.scan_history(spark, f"{_layout(spark, sf, [None], impressions=False)}/train")
    first = _first_pos(records)
    rows = L.explode_rows(records, [USER, *([first] if first else [])], S.HISTORY, "i", ART)
    at = F.col("i") + (F.col(first) if first else 1)
    return rows.select(USER, at.cast("bigint").alias("hist_pos"), ART)


@query
def history_positions(spark, sf):
    return D.history_rows(spark, sf)


def _time_text(df):
    return df.withColumn(S.IMPRESSION_TIME, F.col(S.IMPRESSION_TIME).cast("string"))


@query
def scan_behaviors(spark, sf):
    shown = ST.scan_behaviors(spark, f"{_layout(spark, sf, [None], history=False)}/train")
    return _time_text(I.candidate_rows(shown, [ID, USER, S.IMPRESSION_TIME], first_pos=_first_pos(shown)))


@query
def paged_behaviors(spark, sf):
    return _time_text(I.candidate_rows(D.pages(spark, sf), [ID, USER, S.IMPRESSION_TIME], first_pos="first_pos"))


@query
def scan_articles(spark, sf):
    root = scratch_path(spark, "click-log")
    D.articles(spark, sf).write.parquet(f"{root}/articles.parquet")
    return ST.scan_articles(spark, root)


@query
def split_counts(spark, sf):
    """Impressions, candidates and clicks of the three splits and of the period that gives the histories."""
    root = _layout(spark, sf, D.SPLITS, history=False)
    counts = None
    for split in D.SPLITS:
        shown = ST.scan_behaviors(spark, f"{root}/{split}")
        clicks = F.coalesce(F.size(S.CLICKED), F.lit(0))
        is_first = F.col("page") == 0 if "page" in shown.columns else F.lit(True)
        row = shown.agg(
            F.count_if(is_first).alias("impressions"),
            F.sum(F.size(S.INVIEW)).alias("candidates"),
            F.sum(F.when(F.col(S.CLICKED).isNotNull(), clicks).otherwise(0)).alias("clicks"),
        ).select(F.lit(split).alias("split"), "*")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def _monthly_log(spark, sf, split):
    """A metric log: the share of clicked candidates per month, epochs counted from 0."""
    start = D.SPLITS[split][0]
    month = F.year(S.IMPRESSION_TIME) * 12 + F.month(S.IMPRESSION_TIME)
    first = int(start[:4]) * 12 + int(start[5:7])
    return (
        D.items(spark, sf, split)
        .groupBy((month - first).cast("bigint").alias("epoch"))
        .agg(F.max(S.IMPRESSION_TIME).cast("string").alias("ignore"), F.round(F.avg("clicked"), 6).alias("auc"))
    )


def _logged(spark, sf, split):
    path = scratch_path(spark, f"{split}_auc.csv")
    ML.write_metric_log(_monthly_log(spark, sf, split), path, "auc")
    return ML.read_metric_log(spark, path, "auc")


@query
def metric_log_read(spark, sf):
    return _logged(spark, sf, "validation")


@query
def metric_curves(spark, sf):
    return ML.metric_curves(_logged(spark, sf, "train"), _logged(spark, sf, "validation"), "auc")


def _scored(spark, sf, split, largest=None):
    """Candidates of a split with the hash score."""
    rows = D.candidates(spark, sf, split, largest)
    return rows.withColumn("label", F.col("clicked")).withColumn("score", D.hash_score())


def _ranked_lists(spark, sf):
    """One record per test impression with the ranks of its candidates: one line of the file."""
    largest = D.largest_impression(spark, sf)
    ranked = M.rank_within(_scored(spark, sf, "test", largest), ID, "pos", "score", largest=largest)
    return PF.value_lists(ranked, ID, "pos", "rank", "ranked_scores", largest)


@query
def prediction_lines(spark, sf):
    line = PF.prediction_line(F.col(ID), F.col("ranked_scores"))
    return _ranked_lists(spark, sf).select(line.alias("line"))


def _round_trip(spark, sf, compression):
    path = scratch_path(spark, "predictions.txt")
    PF.write_predictions(_ranked_lists(spark, sf), path, ID, "ranked_scores", compression)
    back = PF.read_predictions(spark, path, ID, "ranks")
    rows = L.explode_rows(back, [ID], "ranks", "i", "r")
    return rows.select(ID, (F.col("i") + 1).cast("bigint").alias("pos"), F.col("r").cast("bigint").alias("rank"))


@query
def prediction_roundtrip(spark, sf):
    return _round_trip(spark, sf, "none")


@query
def prediction_gzip_roundtrip(spark, sf):
    return _round_trip(spark, sf, "gzip")


@query
def prediction_rejects(spark, sf):
    """Lines that lost something on the way, each with the reason why the reader turns it down."""
    line = PF.prediction_line(F.col(ID), F.col("ranked_scores"))
    fault = F.pmod(F.col(ID), F.lit(5))
    broken = (
        F.when(fault == 1, F.concat(F.lit("x"), line))
        .when(fault == 2, F.substring_index(line, " ", 1))
        .when(fault == 3, F.regexp_replace(line, "]", ""))
        .otherwise(line)
    )
    path = scratch_path(spark, "broken-predictions.txt")
    _ranked_lists(spark, sf).select(broken.alias("value")).write.text(path)
    return PF.rejected_lines(spark, path).select("line", "reason")


# --- projections, filters, samples ----------------------------------------


@query
def project_train_columns(spark, sf):
    """The training columns; lists are shown as rows (in-view) and text (history)."""
    recent = _recent(spark, sf)
    shown = D.pages(spark, sf, "train")
    times = D.impression_times(spark, sf, "train")
    joined = P.impressions_with_history(shown, recent, HISTORY_SIZE, hot_from=times)
    train = joined.select(*S.TRAIN_COLUMNS, "first_pos").transform(I.add_labels)
    history = train.withColumn("history", _joined(S.HISTORY))
    return I.candidate_rows(history, [ID, USER, "history"], first_pos="first_pos")


@query
def filter_min_candidates(spark, sf):
    largest = D.largest_impression(spark, sf)
    if fits_a_list(largest):
        kept = I.keep_min_candidates(D.behaviors(spark, sf, None, largest), NPRATIO)
        return kept.select(ID, F.size(S.INVIEW).cast("bigint").alias("n_candidates"))
    counts = D.items(spark, sf).groupBy(ID).agg(F.count(F.lit(1)).alias("n_candidates"))
    return counts.where(F.col("n_candidates") > NPRATIO + 1)


@query
def known_user_flag(spark, sf):
    known = D.impression_times(spark, sf, "train")
    return R.flag_known_users(D.impression_times(spark, sf, "validation").select(ID, USER), known)


@query
def head_impressions(spark, sf):
    return R.head(D.impression_times(spark, sf, "train").select(ID, USER), 4 * BATCH, [F.col(ID)])


@query
def sample_fraction_exact(spark, sf):
    return R.sample_exact(D.impression_times(spark, sf, "train").select(ID, USER), FRACTION, [ID], SEED)


@query
def sample_fraction_hash(spark, sf):
    return R.sample_by_hash(D.impression_times(spark, sf, "train").select(ID, USER), FRACTION, [ID], SEED)


@query
def shuffle_rows(spark, sf):
    return R.shuffle_rows(D.impression_times(spark, sf).select(ID, USER), [ID], SEED)


# --- joins -----------------------------------------------------------------


def _history_pages(spark, sf):
    """All clicks of a user in records of at most HISTORY_PAGE, oldest first."""
    return materialised(D.history_pages(spark, sf, page_rows=HISTORY_PAGE).select(USER, "page", S.HISTORY), "history-pages")


@query
def behaviors_with_history(spark, sf):
    """Every impression beside each page of its user's history; page 0 without a text for a user without clicks."""
    joined = join_tables(D.impression_times(spark, sf, "train").select(ID, USER), _history_pages(spark, sf), USER, "left")
    return joined.fillna(0, ["page"]).select(ID, USER, "page", _joined(S.HISTORY).alias("history"))


def _impressions_and_clicks(spark, sf, how):
    """Training impressions beside all earlier clicks of the same user: many rows of a user on both sides."""
    clicks = D.history_clicks(spark, sf).select(USER, F.col(ID).alias("clicked_in"), ART)
    shown = D.impression_times(spark, sf, "train").select(USER, ID)
    joined = join_tables(shown, materialised(clicks, "clicks"), USER, how)
    return joined.select(USER, ID, "clicked_in", ART).fillna(0)  # 0: no partner


@query
def impressions_with_clicks(spark, sf):
    return _impressions_and_clicks(spark, sf, "inner")


@query
def clicks_with_impressions(spark, sf):
    """All clicks, also of users without an impression in the training period."""
    return _impressions_and_clicks(spark, sf, "right")


@query
def impressions_and_clicks(spark, sf):
    """All impressions and all clicks, those without a partner as well."""
    return _impressions_and_clicks(spark, sf, "full")


@query
def users_full_join(spark, sf):
    """Impressions per user in two splits; users of only one split are kept."""

    def per_user(split, name):
        return D.impression_times(spark, sf, split).groupBy(USER).agg(F.count(F.lit(1)).alias(name))

    # One row per user on either side: no user can be hot here.
    return per_user("train", "n_train").join(per_user("validation", "n_validation"), USER, "full").fillna(0)


# --- list operators --------------------------------------------------------


@query
def binary_labels(spark, sf):
    return I.candidate_rows(D.pages(spark, sf).transform(I.add_labels), [ID], first_pos="first_pos")


@query
def remove_positives(spark, sf):
    left = D.pages(spark, sf).transform(I.remove_positives)
    return L.explode_rows(left, [ID], S.INVIEW, "i", ART).drop("i")


@query
def truncate_history(spark, sf):
    recent = I.truncate_history(D.recent_history(spark, sf, HISTORY_SIZE + 3), S.HISTORY, HISTORY_SIZE)
    return L.explode_rows(recent, [USER], S.HISTORY, "i", ART).select(
        USER, (F.col("i") + 1).cast("bigint").alias("hist_pos"), ART
    )


@query
def truncate_pad_history(spark, sf):
    padded = I.truncate_history(D.recent_history(spark, sf, HISTORY_SIZE + 3), S.HISTORY, HISTORY_SIZE, 0)
    return padded.select(USER, _joined(S.HISTORY).alias("history"))


def _at_least(rows, n):
    counts = rows.groupBy(ID).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n)
    return rows.join(counts.select(ID), ID, "left_semi")


def _numbered(df, column, name):
    rows = L.explode_rows(df, [ID], column, "i", ART)
    return rows.select(ID, (F.col("i") + 1).cast("bigint").alias(name), ART)


@query
def sample_without_replacement(spark, sf):
    largest = D.largest_impression(spark, sf)
    if fits_a_list(largest):
        shown = D.behaviors(spark, sf, None, largest).where(F.size(S.INVIEW) >= 2)
        return _numbered(I.sample_ids(shown, 2, [ID], seed=SEED), S.INVIEW, "draw")
    rows = _at_least(D.candidates(spark, sf, None, largest), 2)
    return C.sample_within(rows, ID, "pos", 2, seed=SEED).select(ID, "draw", ART)


@query
def sample_with_replacement(spark, sf):
    largest = D.largest_impression(spark, sf)
    if fits_a_list(largest):
        shown = D.behaviors(spark, sf, None, largest)
        return _numbered(I.sample_ids(shown, 4, [ID], True, SEED), S.INVIEW, "draw")
    rows = D.candidates(spark, sf, None, largest)
    return C.sample_within_replacing(rows, ID, "pos", ART, 4, seed=SEED)


def training_lists(spark, sf, shuffle, with_replacement=True):
    """(impression_id, click_pos, in-view list, label list): npratio + 1 ids per click.

    Without replacement only impressions with enough unclicked ids take part.
    Drawn inside the impression record while every impression fits a list, else
    from rows; both give the same lists.
    """
    largest = D.largest_impression(spark, sf)
    if fits_a_list(largest):
        shown = D.behaviors(spark, sf, "train", largest).select(ID, S.INVIEW, S.CLICKED)
        if not with_replacement:
            shown = shown.where(F.size(L.without_clicked(F.col(S.INVIEW), F.col(S.CLICKED))) >= NPRATIO)
        lists = I.sample_negatives(shown, NPRATIO, shuffle, with_replacement, SEED).transform(I.add_labels)
    else:
        shown = D.candidates(spark, sf, "train", largest)
        if not with_replacement:
            negatives = shown.groupBy(ID).agg(F.sum(1 - F.col("clicked")).alias("n"))
            shown = shown.join(negatives.where(F.col("n") >= NPRATIO), ID, "left_semi")
        rows = C.sample_negatives_within(
            shown, NPRATIO, ID, "pos", ART, "clicked", shuffle, with_replacement, SEED, largest
        )
        element = F.struct("slot", F.col(ART).alias("a"), F.col("label").cast("tinyint").alias("y"))
        grouped = rows.groupBy(ID, "click_pos").agg(F.sort_array(F.collect_list(element)).alias("l"))
        lists = grouped.withColumns(
            {S.INVIEW: F.transform("l", lambda t: t["a"]), S.LABELS: F.transform("l", lambda t: t["y"])}
        )
    return lists.select(ID, "click_pos", S.INVIEW, S.LABELS)


def training_rows(spark, sf, shuffle, with_replacement=True):
    """(impression_id, click_pos, slot, article_id, label) of the sampled training lists."""
    lists = training_lists(spark, sf, shuffle, with_replacement)
    return I.candidate_rows(lists, [ID, "click_pos"]).withColumnRenamed("pos", "slot")


def _shown(rows):
    """-1 in place of the null that an empty pool gives."""
    return rows.withColumn(ART, F.coalesce(F.col(ART), F.lit(-1).cast("bigint")))


@query
def negative_sampling(spark, sf):
    return _shown(training_rows(spark, sf, shuffle=False))


@query
def negative_sampling_shuffled(spark, sf):
    return _shown(training_rows(spark, sf, shuffle=True))


@query
def negative_sampling_distinct(spark, sf):
    """Without replacement: a list never has the same unclicked position twice."""
    return training_rows(spark, sf, shuffle=False, with_replacement=False)


@query
def shuffle_list(spark, sf):
    largest = D.largest_impression(spark, sf)
    if fits_a_list(largest):
        shown = D.behaviors(spark, sf, None, largest)
        return _numbered(I.shuffle_list(shown, S.INVIEW, [ID], SEED), S.INVIEW, "shuffled_pos")
    rows = D.candidates(spark, sf, None, largest)
    return C.shuffle_within(rows, ID, "pos", "shuffled_pos", SEED, largest).select(ID, "shuffled_pos", ART)


def _customers(spark, sf):
    return D.table(spark, sf, "customer").select(F.col("c_custkey").alias(USER))


def _article_labels(spark, sf):
    return D.embeddings(spark, sf).select(F.col("vec_id").alias("key"), F.col("label").alias("value"))


def _mapped(spark, sf, drop_nulls=False, fill_nulls=None):
    """Labels of the whole history of each customer as one text; a customer without clicks counts as one unknown id.

    Ids are mapped and written as text page by page, so that only a finished text is ever a whole history.
    A customer that comes several times has each label as often.
    """
    customers = _customers(spark, sf).groupBy(USER).agg(F.count(F.lit(1)).cast("int").alias("_times"))
    pages = join_tables(customers, _history_pages(spark, sf), USER, "left").fillna(0, ["page"])
    mapped = I.map_ids(
        materialised(pages, "customer-pages"), S.HISTORY, _article_labels(spark, sf), [USER, "page"], drop_nulls=drop_nulls, fill_nulls=fill_nulls
    )
    if not drop_nulls:  # a customer without a key matches nothing
        mapped = mapped.withColumn(S.HISTORY, F.coalesce(S.HISTORY, F.array(F.lit(fill_nulls).cast("int"))))
    repeated = mapped.withColumn(S.HISTORY, F.flatten(F.transform(S.HISTORY, lambda v: F.array_repeat(v, F.col("_times")))))
    texts = repeated.select(USER, "page", _joined(S.HISTORY).alias("_t"))
    whole = texts.groupBy(USER).agg(F.sort_array(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct("page", "_t")))).alias("_l"))
    return whole.select(USER, F.when(F.size("_l") > 0, F.array_join(F.transform("_l", lambda t: t["_t"]), ",")).alias("labels"))


@query
def map_ids_fill(spark, sf):
    return _mapped(spark, sf, fill_nulls=-1)


@query
def map_ids_drop(spark, sf):
    return _mapped(spark, sf, drop_nulls=True)


@query
def map_ids_keep(spark, sf):
    return _mapped(spark, sf)


@query
def candidate_counts(spark, sf):
    """One row per order; 0 for those without lines."""
    pages = I.add_candidate_count(D.pages(spark, sf))
    counts = pages.groupBy(ID).agg(F.sum(S.N_SAMPLES).alias(S.N_SAMPLES))
    return D.impression_times(spark, sf).select(ID).join(counts, ID, "left").fillna(0, [S.N_SAMPLES])


@query
def candidate_rows(spark, sf):
    """Labelled candidates beside the padded history of their user."""
    recent = _recent(spark, sf)
    times = D.impression_times(spark, sf, "validation")
    labelled = P.impressions_with_history(
        D.pages(spark, sf, "validation"), recent, HISTORY_SIZE, hot_from=times
    ).transform(I.add_labels)
    history = labelled.withColumn("history", _joined(S.HISTORY))
    return I.candidate_rows(history, [ID, USER, "history"], first_pos="first_pos")


@query
def attach_scores(spark, sf):
    shown = D.pages(spark, sf, "test")
    listed = I.score_lists(shown, [ID, "page"], lambda rows: rows.withColumn("score", D.hash_score()), keep=["first_pos"])
    rows = L.explode_rows(listed, [ID, "first_pos"], F.arrays_zip(S.INVIEW, S.SCORES), "i", "z")
    return rows.select(
        ID,
        (F.col("i") + F.col("first_pos")).cast("bigint").alias("pos"),
        F.col(f"z.{S.INVIEW}").alias(ART),
        F.col(f"z.{S.SCORES}").alias("score"),
    )


def _scored_lists(spark, sf):
    lists = training_lists(spark, sf, shuffle=True)
    scores = F.transform(S.INVIEW, lambda a: D.hash_score(article=a))
    return lists.select(ID, "click_pos", S.LABELS, scores.alias(S.SCORES))


@query
def label_position(spark, sf):
    lists = training_lists(spark, sf, shuffle=True)
    return lists.select(ID, "click_pos", L.label_position(F.col(S.LABELS)).cast("bigint").alias("label_position"))


@query
def chunk_list(spark, sf):
    """The words of each document in chunks of 100."""
    docs = D.documents(spark, sf)
    words = docs.select("doc_id", X.tokens(F.col("text")).alias("words"))
    chunks = L.explode_rows(words, ["doc_id"], L.chunked(F.col("words"), 100), "i", "words")
    return chunks.select(
        "doc_id",
        (F.col("i") + 1).cast("bigint").alias("chunk"),
        F.size("words").cast("bigint").alias("n_words"),
        F.md5(F.array_join("words", " ")).alias("content"),
    )


# --- text, dates, structs --------------------------------------------------


@query
def concat_columns(spark, sf):
    text, name = E.concat_columns(D.articles(spark, sf), [S.TITLE, S.SUBTITLE])
    return text.select(ART, name)


def _vocabulary(spark, sf):
    return E.build_vocabulary(D.documents(spark, sf), "text", VOCABULARY)


@query
def build_vocabulary(spark, sf):
    return _vocabulary(spark, sf)


def _encoded(spark, sf, max_length):
    docs = D.documents(spark, sf)
    # Written once: its size is looked at before it is joined.
    vocabulary = materialised(_vocabulary(spark, sf), "vocabulary", sized=True)
    return E.encode_text(docs, "doc_id", "text", vocabulary, VOCABULARY, max_length)


@query
def encode_text(spark, sf):
    encoded, name = _encoded(spark, sf, TEXT_LENGTH)
    return encoded.select("doc_id", _joined(name).alias(name))


@query
def encode_text_unpadded(spark, sf):
    encoded, name = _encoded(spark, sf, None)
    ids = F.col(name)
    return encoded.select(
        "doc_id", F.size(ids).cast("bigint").alias("n_tokens"), F.md5(_joined(name)).alias("content")
    )


@query
def format_duration(spark, sf):
    """Time of each event since the day the log starts, negative days included for earlier events."""
    events = D.table(spark, sf, "events")
    since = F.col("ts") - F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    return events.select("event_id", X.duration_text(since).alias("duration"))


@query
def flatten_struct(spark, sf):
    events = D.table(spark, sf, "events")
    nested = events.select(
        "event_id",
        F.struct(
            F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("user")
        ).alias("event"),
        F.from_json("props", "k bigint").alias("props"),
    )
    return nested.select(*X.flattened_columns(nested.schema))


# --- lookup tables ---------------------------------------------------------


@query
def article_lookup(spark, sf):
    """The supplier of each article's last line."""
    lines = D.table(spark, sf, "lineitem")
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")]
    return K.lookup_table(lines, "l_partkey", "l_suppkey", order)


@query
def user_index(spark, sf):
    return K.dense_ids(D.impression_times(spark, sf), USER)


def _matrix_rows(matrix):
    """Matrix elements; the row for unknown ids has key -1."""
    key = F.coalesce("vec_id", F.lit(-1).cast("bigint")).alias("vec_id")
    rows = matrix.select("idx", key, F.posexplode("embedding").alias("dim", "value"))
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 5)).withColumn(
        "dim", F.col("dim").cast("bigint")
    )


@query
def lookup_matrix_zeros(spark, sf):
    return _matrix_rows(K.lookup_matrix(D.embeddings(spark, sf), "vec_id", "embedding", "zeros"))


@query
def lookup_matrix_mean(spark, sf):
    return _matrix_rows(K.lookup_matrix(D.embeddings(spark, sf), "vec_id", "embedding", "mean"))


@query
def embedding_lookup(spark, sf):
    matrix = K.lookup_matrix(D.embeddings(spark, sf), "vec_id", "embedding", "zeros")
    rows = D.candidates(spark, sf).select(ID, "pos", ART)
    found = K.embed(rows, ART, matrix, "vec_id", "embedding", EMBEDDING_DIM)
    return found.select(
        ID, "pos", ART, "idx",
        F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"),
        F.round(F.get("embedding", F.lit(EMBEDDING_DIM - 1)).cast("double"), 6).alias("last_value"),
    )


# --- metrics ---------------------------------------------------------------


@query
def auc_pooled(spark, sf):
    """Ties count 0 (the default) and one half, side by side."""
    scored = D.items(spark, sf, "test").select(F.col("clicked").alias("label"), D.hash_score().alias("score"))
    return M.auc(scored, ties=("strict", "half"))


@query
def accuracy_top1(spark, sf):
    return M.accuracy_top1(_scored_lists(spark, sf))


@query
def accuracy_threshold(spark, sf):
    scored = D.items(spark, sf, "validation").select(F.col("clicked").alias("label"), D.hash_score().alias("score"))
    return M.accuracy_threshold(scored)


@query
def loss_listwise(spark, sf):
    lists = _scored_lists(spark, sf)
    loss = M.loss_listwise(lists, [F.col(ID), F.col("click_pos")], BATCH)
    return loss.select(F.round("loss", 9).alias("loss"))


@query
def loss_batch(spark, sf):
    scored = D.items(spark, sf, "validation").select(
        ID, F.col("clicked").alias("label"), D.hash_score().alias("score")
    )
    scored = materialised(scored, "scored")  # read for the batches and for the loss
    batches = R.assign_batches(scored.select(ID).distinct(), [F.col(ID)], BATCH).select(ID, "batch_id")
    placed = R.lookup_join(scored, batches, ID, "inner")
    return M.loss_batch(placed, "batch_id").select(F.round("loss", 8).alias("loss"))


@query
def softmax_scores(spark, sf):
    largest = D.largest_impression(spark, sf)
    probs = M.softmax_within(_scored(spark, sf, None, largest), ID, "score", largest=largest)
    return probs.select(ID, "pos", ART, F.round("prob", 9).alias("prob"))


@query
def npratio(spark, sf):
    return M.npratio(D.items(spark, sf), "clicked").select(F.round("npratio", 9).alias("npratio"))


@query
def row_drop_report(spark, sf):
    """Impressions before and after those with too few candidates are dropped."""
    counts = D.items(spark, sf).groupBy(ID).agg(F.count(F.lit(1)).alias("n"))
    return R.row_drop_report(counts, lambda rows: rows.where(F.col("n") > NPRATIO + 1))


# --- ranking, ordering, batches --------------------------------------------


@query
def rank_scores(spark, sf):
    largest = D.largest_impression(spark, sf)
    ranked = M.rank_within(_scored(spark, sf, "test", largest), ID, "pos", "score", largest=largest)
    return ranked.select(ID, "pos", "rank")


@query
def top_article(spark, sf):
    return M.top_candidate(_scored(spark, sf, "test"), ID, "pos", ART, "score")


@query
def ordered_impressions(spark, sf):
    return _time_text(D.impression_times(spark, sf)).orderBy(ID)


@query
def batch_assignment(spark, sf):
    return R.assign_batches(D.impression_times(spark, sf).select(ID, USER), [F.col(ID)], BATCH)


# --- attention, vectors, scores --------------------------------------------


def _pool(spark, sf, mask=None):
    rows = D.embeddings(spark, sf)
    w = A.V.fixed_weights(EMBEDDING_DIM, HIDDEN)
    pooled = A.attention_pool(rows, "label", "embedding", w, [0.0] * HIDDEN, A.fixed_pool_query(HIDDEN), mask)
    return pooled.select("label", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


@query
def attention_pool(spark, sf):
    return _pool(spark, sf)


@query
def attention_pool_masked(spark, sf):
    return _pool(spark, sf, F.get("embedding", F.lit(0)) > 0)


def _history_sequences(spark, sf):
    """Padded histories as sequences of article embeddings; unknown articles are zeros."""
    padded = I.truncate_history(
        _recent(spark, sf).withColumn("n", F.size(S.HISTORY)),
        S.HISTORY, HISTORY_SIZE, F.lit(A.UNKNOWN_KEY).cast("bigint"),
    )
    zeros = spark.range(1).select(
        F.lit(A.UNKNOWN_KEY).cast("bigint").alias("vec_id"),
        F.array_repeat(F.lit(0.0), EMBEDDING_DIM).alias("embedding"),
    )
    known = D.embeddings(spark, sf).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    seqs = A.sequences(padded, USER, S.HISTORY, known.unionByName(zeros), "vec_id", "embedding", EMBEDDING_DIM)
    return padded, seqs


def _attended(spark, sf, causal=False, lengths=False):
    encoder = A.fixed_attention(EMBEDDING_DIM, HEADS, HEAD_DIM, HIDDEN)
    padded, seqs = _history_sequences(spark, sf)
    if lengths:
        seqs = seqs.join(padded.select(USER, "n"), USER)
    n = "n" if lengths else None
    out = A.self_attention(seqs, USER, encoder, HISTORY_SIZE, causal, q_len=n, v_len=n)
    return out.withColumn("value", F.round("value", 6))


@query
def self_attention(spark, sf):
    return _attended(spark, sf)


@query
def self_attention_causal(spark, sf):
    return _attended(spark, sf, causal=True)


@query
def self_attention_lengths(spark, sf):
    return _attended(spark, sf, lengths=True)


def _encoders():
    return (
        A.fixed_attention(EMBEDDING_DIM, HEADS, HEAD_DIM, HIDDEN),
        A.fixed_attention(DIM, HEADS, HEAD_DIM, HIDDEN),
    )


def _vectors(spark, sf):
    """(users, articles) vector tables."""
    encoded, ids = P.encoded_articles(
        D.articles(spark, sf), [S.TITLE, S.SUBTITLE], ARTICLE_VOCABULARY, TITLE_LENGTH
    )
    recent = _recent(spark, sf)
    return P.vector_tables(
        encoded, ids, D.embeddings(spark, sf), recent, *_encoders(), TITLE_LENGTH, HISTORY_SIZE
    )


def _vector_rows(table, key, digits=8):
    rows = L.explode_rows(table.where(F.col(key) != A.UNKNOWN_KEY), [key], "vec", "dim", "value")
    return rows.select(key, F.col("dim").cast("bigint").alias("dim"), F.round("value", digits).alias("value"))


@query
def article_vectors(spark, sf):
    encoded, ids = P.encoded_articles(
        D.articles(spark, sf), [S.TITLE, S.SUBTITLE], ARTICLE_VOCABULARY, TITLE_LENGTH
    )
    vectors = A.article_vectors(encoded, ART, ids, D.embeddings(spark, sf), _encoders()[0], TITLE_LENGTH)
    return _vector_rows(vectors, ART)


@query
def user_vectors(spark, sf):
    return _vector_rows(_vectors(spark, sf)[0], USER, 9)


def _clicks_scored(spark, sf, split):
    users, articles = _vectors(spark, sf)
    rows = D.candidates(spark, sf, split).select(ID, "pos", USER, ART, F.col("clicked").alias("label"))
    return A.click_scores(rows, users, articles, DIM, hot_from=D.id_pairs(spark, sf, split))


@query
def click_scores(spark, sf):
    return _clicks_scored(spark, sf, "validation").select(ID, "pos", ART, F.round("score", 10).alias("score"))


@query
def click_probability(spark, sf):
    scored = A.click_probability(_clicks_scored(spark, sf, "validation"))
    return scored.select(ID, "pos", ART, F.round("probability", 9).alias("probability"))


@query
def predict_test(spark, sf):
    """The prediction line of every test impression."""
    users, articles = _vectors(spark, sf)
    pairs = D.id_pairs(spark, sf, "test")
    largest = D.largest_impression(spark, sf)
    rows = D.candidates(spark, sf, "test", largest).select(ID, "pos", USER, ART)
    scored = A.click_scores(rows, users, articles, DIM, hot_from=pairs)
    # Candidates with the same text tie, whatever the order of the floating-point sums.
    scored = scored.withColumn("score", F.round("score", 9))
    ranked = M.rank_within(scored, ID, "pos", "score", largest=largest)
    lists = PF.value_lists(ranked, ID, "pos", "rank", "ranks", largest)
    return lists.select(PF.prediction_line(F.col(ID), F.col("ranks")).alias("line"))


# --- the chains that training and evaluation run -----------------------------


def _indexed(rows, spark, sf, key):
    """Both list columns as places in the article index, 0 for unknown ids; one row per candidate."""
    written = materialised(K.dense_ids(D.articles(spark, sf), ART, "value", start=1), "article-index", sized=True)
    index = no_larger(written.select(F.col(ART).alias("key"), "value"), written)
    for column in (S.INVIEW, S.HISTORY):
        rows = I.map_ids(rows, column, index, key, fill_nulls=0)
    rows = rows.withColumn("history", _joined(S.HISTORY))
    return I.candidate_rows(rows, [*key, "history"], first_pos=_first_pos(rows)).withColumnRenamed(ART, "article_index")


@query
def train_rows(spark, sf):
    """A seeded fifth of the training lists, read from the split layout."""
    shown, past = ST.read_split(spark, _layout(spark, sf, ["train"]), "train")
    lists = materialised(P.training_lists(shown, past, HISTORY_SIZE, NPRATIO, FRACTION, SEED, A.UNKNOWN_KEY), "training-lists")
    return _indexed(lists, spark, sf, [ID, "click_pos"]).withColumnRenamed("pos", "slot")


@query
def validation_rows(spark, sf):
    """A seeded fifth of the validation impressions, read from the split layout."""
    shown, past = ST.read_split(spark, _layout(spark, sf, ["validation"]), "validation")
    kept = materialised(P.labelled_impressions(shown, past, HISTORY_SIZE, FRACTION, SEED, A.UNKNOWN_KEY), "labelled")
    key = [ID, "page"] if "page" in kept.columns else [ID]
    return _indexed(kept, spark, sf, key).drop("page")


def _click_features(spark, sf):
    users, articles = _vectors(spark, sf)
    times = D.impression_times(spark, sf, "train").select(ID, USER)
    lists = R.lookup_join(training_rows(spark, sf, shuffle=False), times, ID, "inner")
    train = T.pair_features(lists.select(USER, ART, "label"), users, articles, DIM)
    # Read once per iteration of the learner.
    return users, articles, materialised(train.select("features", "label"), "click-features")


@query
def click_model_optimality(spark, sf):
    """At the fitted weights the mean gradient is nothing beside that at zero weights."""
    _, _, train = _click_features(spark, sf)
    model = T.fit_click_model(train)
    found = T.mean_gradient(
        train, model.coefficients.toArray().tolist(), model.intercept, others={"at_start": ([0.0] * DIM, 0.0)},
        totals={"n_rows": F.count(F.lit(1)).cast("bigint"), "n_clicks": F.sum("label").cast("bigint")},
    )
    start = F.array_max(F.transform("at_start", F.abs))
    return found.select("dim", F.abs(F.round(F.col("gradient") / start, 3)).alias("gradient"), "n_rows", "n_clicks")


@query
def train_click_model(spark, sf):
    """AUC and accuracy per split of a click model fitted on the training lists."""
    users, articles, train = _click_features(spark, sf)
    largest = D.largest_impression(spark, sf)
    model = T.fit_click_model(train)
    report = None
    for split in ("train", "validation", "test"):
        if split == "train":
            features = train
        else:
            rows = D.items(spark, sf, split, largest).select(USER, ART, F.col("clicked").alias("label"))
            features = T.pair_features(rows, users, articles, DIM)
        scored = materialised(T.score_click_model(model, features).select("label", "score"), "scored")
        quality = M.auc(scored, ties=("half",)).select(
            "auc", M.accuracy_threshold(scored).scalar().alias("accuracy"), F.lit(split).alias("split")
        )
        report = quality if report is None else report.unionByName(quality)
    return report
