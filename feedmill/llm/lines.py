"""Repeated lines: range-partitioned hashes, first occurrences, per-document bitmaps.

The hashes of all long lines are range partitioned and sorted by (hash, document
from the largest, position).  Read as a stream, the rows of one hash follow one
another: the first names the document that keeps the line, each change of the document counts one more.
A hash that goes on in the next part is put together from what the parts say at their two ends.  What leaves is a
bitmap of dropped lines per document; the layout holds no text.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmill.llm.tables import WHITE_SPACE, bytes_of, lower_ascii, text_hash, whole
from feedmill.operators.limits import LIMITS
from feedmill.operators.ordering import ranged
from feedmill.operators.storage import materialised

MIN_CHARS, MIN_DOCUMENTS = 40, 5


def _document(id_col: str, text_col: str) -> list[Column]:
    """Identity of a row: its id and its text's hash, so that rows sharing an id stay apart."""
    return [F.col(id_col).alias("_id"), text_hash(whole(text_col), 3).alias("_th")]


def line_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """(_id, _th, words): the dropped lines of each document that loses any.

    ``words`` holds (word, bits) for the 64-bit words of the bitmap that are not zero; line
    ``p`` is bit ``p % 64`` of word ``p / 64``.

    A line's key is the line without white space at both ends and with A-Z in lower
    case.  A key of at least ``min_chars`` code points in at least ``min_documents``
    documents loses all its lines except in the largest id holding it.  Rows that
    share id and text are one document; rows that share the largest id all keep the
    line; a null id is below all others.  Null and empty texts have one empty line.
    Extra columns are not looked at.

    A line that very many documents hold spans many range partitions, so a hot line costs no
    task more than another; only the two ends of each partition meet.
    """
    trimmed = F.transform(F.split(whole(text_col), "\n", -1), lambda line: F.btrim(line, F.lit(WHITE_SPACE)))
    each = docs.select(*_document(id_col, text_col), F.posexplode(trimmed).alias("_pos", "_line"))
    each = each.where(F.length("_line") >= min_chars).withColumn("_line", lower_ascii(F.col("_line")))
    keyed = each.select(*[text_hash(F.col("_line"), s).alias(f"_h{s}") for s in (1, 2)], "_id", "_th", "_pos")
    order = ["_h1", "_h2", F.desc("_id"), "_th", "_pos"]
    laid_out = ranged(keyed, order)

    stream = Window.partitionBy("_part").orderBy("_row")
    before = F.lag(F.struct("_h1", "_h2", "_id", "_th")).over(stream)
    same_line = (F.col("_before._h1") == F.col("_h1")) & (F.col("_before._h2") == F.col("_h2"))
    same_document = same_line & F.col("_before._id").eqNullSafe(F.col("_id")) & (F.col("_before._th") == F.col("_th"))
    rows = laid_out.withColumn("_before", before).select(
        "_part", "_row", "_h1", "_h2", "_id", "_th", "_pos",
        (~F.coalesce(same_line, F.lit(False))).cast("int").alias("_new_line"),
        (~F.coalesce(same_document, F.lit(False))).cast("bigint").alias("_new_document"),
    )
    rows = rows.withColumn("_run", F.sum("_new_line").over(stream))
    run = Window.partitionBy("_part", "_run").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_docs", F.sum("_new_document").over(run)).withColumn("_stays", F.first(F.struct("_id")).over(run))

    across = materialised(_across_parts(laid_out), "line-ends")
    # No more rows than twice the number of partitions.
    told = rows.join(F.broadcast(across), ["_h1", "_h2"], "left")
    docs_of_line, stays = F.coalesce("_all_docs", "_docs"), F.coalesce("_first", "_stays")
    dropped = told.where((docs_of_line >= min_documents) & ~F.col("_id").eqNullSafe(stays["_id"]))
    bits = F.bit_or(F.expr("shiftleft(1L, _pos % 64)")).alias("bits")
    words = dropped.groupBy("_id", "_th", F.expr("_pos div 64").cast("int").alias("word")).agg(bits)
    return words.groupBy("_id", "_th").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def _across_parts(laid_out: DataFrame) -> DataFrame:
    """(_h1, _h2, _all_docs, _first): documents and first holder of each hash that several parts hold.

    Such a hash stands at an end of each of its parts.
    """
    document = F.struct("_id", "_th")
    ends = laid_out.groupBy("_part").agg(
        F.min_by(F.struct("_h1", "_h2"), "_row").alias("_low"), F.max_by(F.struct("_h1", "_h2"), "_row").alias("_high")
    )
    edges = ends.select("_part", F.explode(F.array_distinct(F.array("_low", "_high"))).alias("_h")).select("_part", "_h._h1", "_h._h2")
    several = edges.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_parts")).where("_parts > 1").select("_h1", "_h2")
    pieces = laid_out.join(F.broadcast(materialised(several, "line-edges")), ["_h1", "_h2"], "left_semi")
    pieces = pieces.groupBy("_h1", "_h2", "_part", "_id", "_th").agg(F.min("_row").alias("_at"))
    pieces = pieces.groupBy("_h1", "_h2", "_part").agg(
        F.count(F.lit(1)).alias("_docs"), F.min_by(document, "_at").alias("_low"), F.max_by(document, "_at").alias("_high")
    )
    last = F.lag("_high").over(Window.partitionBy("_h1", "_h2").orderBy("_part"))
    goes_on = F.coalesce(last.eqNullSafe(F.col("_low")), F.lit(False)).cast("bigint")
    pieces = pieces.withColumn("_shared", goes_on)
    return pieces.groupBy("_h1", "_h2").agg(
        (F.sum("_docs") - F.sum("_shared")).alias("_all_docs"), F.struct(F.min_by("_low", "_part")["_id"].alias("_id")).alias("_first")
    )


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with ``_n_lines``, ``_n_dropped`` and ``_kept_text`` beside its own columns.

    The bitmaps (see :func:`line_bitmaps`) are broadcast within a checked size, so
    that texts stay where they are read; beyond it both sides are shuffled by document.
    """
    bitmaps = materialised(line_bitmaps(docs, id_col, text_col, **limits), "line-bitmaps")
    if bytes_of(bitmaps, 64 + 24 * F.size("words")) <= LIMITS.broadcast_max_bytes // 4:
        bitmaps = F.broadcast(bitmaps)
    identity = _document(id_col, text_col)
    same = identity[0].eqNullSafe(bitmaps["_id"]) & (identity[1] == bitmaps["_th"])
    marked = docs.join(bitmaps, same, "left")
    lines = F.split(whole(text_col), "\n", -1)

    def stays(_, p):
        return ~F.exists(bitmaps["words"], lambda w: (w["word"] == F.shiftright(p, 6)) & (F.getbit(w["bits"], p % 64) == 1))

    n_dropped = F.aggregate(bitmaps["words"], F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w["bits"]))
    untouched = bitmaps["words"].isNull()
    return marked.select(
        *[docs[f"`{c}`"] for c in docs.columns],
        F.size(lines).cast("bigint").alias("_n_lines"),
        F.when(untouched, F.lit(0).cast("bigint")).otherwise(n_dropped).alias("_n_dropped"),
        F.when(untouched, whole(text_col)).otherwise(F.array_join(F.filter(lines, stays), "\n")).alias("_kept_text"),
    )
