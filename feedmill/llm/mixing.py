"""Mixing sources to target weights by entropy balancing.

Document rates r in [0, 2] keep as close as possible, in relative entropy, to one
copy of everything while the words taken from each source meet its target.  The
solution is an exponential tilt cut at 2: r = min(2, exp(lambda * size)) with one
multiplier per source.  The multipliers solve the convex dual by Newton steps,
each one aggregation over a histogram of sizes.  Rates then become whole copies.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmill.llm.tables import WORD, bytes_of, text_hash, whole
from feedmill.operators.limits import LIMITS
from feedmill.operators.ordering import dense_index, ranged
from feedmill.operators.storage import materialised

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
_NEWTON_STEPS = 60
_UNIT = 1 << 20  # rates are whole multiples of 1 / _UNIT, so that sums do not depend on their order
_SOURCE = ["_none", "_source"]  # a null source comes last


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``sources`` (_none, _source, _total) with ``_target``.

    Sources in order take the weights in turn and share ``share`` of all words by
    weight; a target stops at ``most`` times the source's words and the excess goes
    to the others by weight.  The common factor is found by repeated aggregation:
    sources above their bound leave the sharing, until none is above.
    """
    placed = dense_index(sources, [F.col(c) for c in _SOURCE], "_position")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_position") % len(weights) + 1).cast("int"))
    placed = materialised(placed.withColumn("_weight", turn.cast("bigint")).withColumn("_most", F.col("_total") * most), "mix-sources")
    every = placed.agg(F.sum("_total")).first()[0] or 0
    factor, above = 0.0, None
    while True:
        is_above = F.lit(factor) * F.col("_weight") >= F.col("_most")
        found = placed.agg(
            F.count_if(is_above), F.sum(F.when(is_above, F.col("_most"))), F.sum(F.when(~is_above, F.col("_weight")))
        ).first()
        if found[0] == above or not found[2]:
            break
        above = found[0]
        factor = (share * every - (found[1] or 0)) / found[2]
    return placed.withColumn("_target", F.least(F.lit(factor) * F.col("_weight"), F.col("_most").cast("double")))


def _with_rates(cells: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """``cells`` with ``_rate`` in units, at the multiplier of their source; sizes count in mean sizes."""
    tilt = F.exp(F.least(F.col("_lambda") * F.col("_size") / F.col("_mean"), F.lit(40.0)))
    rate = F.round(F.least(F.lit(float(most)), tilt) * _UNIT).cast("bigint")
    return cells.join(state, _SOURCE).withColumn("_rate", rate)


def _solved(cells: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """``sources`` with ``_lambda``: Newton steps on the dual, kept inside a shrinking bracket.

    A step adds up taken words and their slope per source.  All sums are exact whole
    numbers, so the result does not depend on partitions.
    """
    bound = 64 * F.col("_mean")  # a single word is then taken e^64 times more or less
    state = sources.withColumn("_mean", F.greatest("_total", F.lit(1)) / F.col("_docs"))
    takes_all = F.col("_target") >= F.col("_most")
    state = state.withColumns(
        {"_low": -bound, "_high": bound, "_lambda": F.when(takes_all, bound).otherwise(0.0), "_open": ~takes_all}
    )
    words = F.col("_n").cast("decimal(18,0)") * F.col("_size").cast("decimal(10,0)")
    rate = F.col("_rate").cast("decimal(8,0)")
    for _ in range(_NEWTON_STEPS):
        slope = F.when(F.col("_rate") < most * _UNIT, words * F.col("_size").cast("decimal(10,0)") * rate).otherwise(0)
        sums = (
            _with_rates(cells, state, most)
            .groupBy(*_SOURCE)
            .agg((F.sum(words * rate).cast("double") / _UNIT).alias("_got"), (F.sum(slope).cast("double") / _UNIT).alias("_slope"))
        )
        miss = F.col("_got") - F.col("_target")
        low = F.when(miss <= 0, F.col("_lambda")).otherwise(F.col("_low"))
        high = F.when(miss >= 0, F.col("_lambda")).otherwise(F.col("_high"))
        newton = F.col("_lambda") - F.try_divide(miss * F.col("_mean"), F.col("_slope"))
        inside = (newton > F.col("_low")) & (newton < F.col("_high"))
        is_open = F.col("_open") & (F.abs(miss) > F.greatest(F.lit(0.5), F.col("_target") * 1e-7))
        state = state.join(sums, _SOURCE).withColumns({"_low": low, "_high": high, "_open": is_open})
        step = F.when(F.coalesce(inside, F.lit(False)), newton).otherwise((F.col("_low") + F.col("_high")) / 2)
        state = state.withColumn("_lambda", F.when(F.col("_open"), step).otherwise(F.col("_lambda"))).drop("_got", "_slope")
        state = materialised(state, "mix-newton")
        if state.where("_open").isEmpty():
            break
    return state


def _rounded(cells: DataFrame, solved: DataFrame, most: int) -> DataFrame:
    """Cells with ``_copies``: whole copies of all their documents together.

    Rates are added up along the sizes of a source and cut at whole numbers, so a
    source misses its target by no more than its longest document; two repairs, each one copy
    of a fitting size more or less, take away most of that.  The histogram of a
    source is as long as there are different sizes, whatever the number of documents.
    """
    before = Window.partitionBy(*_SOURCE).orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
    half = _UNIT // 2
    rated = _with_rates(cells, solved, most).withColumn("_mass", F.col("_n") * F.col("_rate"))
    rated = rated.withColumn("_before", F.coalesce(F.sum("_mass").over(before), F.lit(0)) + half)
    cut = F.expr(f"(_before + _mass) div {_UNIT} - _before div {_UNIT}")
    cells = materialised(rated.select(*_SOURCE, "_size", "_n", "_target", cut.alias("_copies")), "mix-copies")
    for _ in range(2):
        got = cells.groupBy(*_SOURCE).agg((F.first("_target") - F.sum(F.col("_copies") * F.col("_size"))).alias("_miss"))
        moves = cells.where("_size > 0").withColumn("_move", F.explode(F.array(F.lit(-1), F.lit(1)))).join(got, _SOURCE)
        moves = moves.where((F.col("_copies") + F.col("_move")).between(0, most * F.col("_n")))
        left = F.abs(F.col("_miss") - F.col("_move") * F.col("_size"))
        best = moves.where(left < F.abs("_miss")).groupBy(*_SOURCE).agg(F.min(F.struct(left.alias("left"), "_size", "_move")).alias("_b"))
        best = best.select(*_SOURCE, F.col("_b._size").alias("_size"), F.col("_b._move").alias("_move"))
        moved = F.col("_copies") + F.coalesce("_move", F.lit(0))
        cells = cells.join(best, [*_SOURCE, "_size"], "left").withColumn("_copies", moved).drop("_move")
        cells = materialised(cells, "mix-repaired")
    return cells


def mix(
    docs: DataFrame, id_col="doc_id", source_col="source", text_col="text", weights=WEIGHTS, share=SHARE, most=MOST_COPIES
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``text_hash``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``size`` is the number of words (null or empty text: 0), ``target`` the words to
    take from the source (see :func:`targets`), ``copies`` how often the document is
    taken and ``taken`` the words that gives.  A null source is a source of its own.
    Documents of one size in one source are interchangeable: the copies of their
    cell are spread evenly over them in the order of their ids (null first; rows
    sharing an id may swap).  An empty table gives an empty table; extra columns are not
    looked at.

    Texts are read once.  Everything else works on (id, source, size), or on the
    histogram of sizes; documents of a hot source or size are numbered across many tasks.
    """
    rows = materialised(
        docs.select(
            F.col(id_col).alias("_id"), F.col(source_col).isNull().alias("_none"),
            F.coalesce(F.col(source_col), F.lit("")).alias("_source"), word_count(whole(text_col)).alias("_size"),
            text_hash(whole(text_col), 3).alias("_th"),
        ),
        "mix-sizes",
    )
    cell = [*_SOURCE, "_size"]
    cells = materialised(rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")), "mix-cells")
    total = F.sum(F.col("_n") * F.col("_size")).alias("_total")
    sources = targets(cells.groupBy(*_SOURCE).agg(total, F.sum("_n").alias("_docs")), weights, share, most)
    copies = _rounded(cells, _solved(cells, sources, most), most)

    laid_out = ranged(rows, [*cell, "_id", "_th"])
    pieces = laid_out.groupBy("_part", *cell).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_here"))
    earlier = Window.partitionBy(*cell).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_here").over(earlier), F.lit(0))).drop("_here")
    totals = sources.select(*_SOURCE, F.col("_total").alias("source_size"))
    pieces = pieces.join(copies, cell).join(totals, _SOURCE)
    numbered = laid_out.join(pieces, ["_part", *cell]).withColumn("_i", F.col("_row") - F.col("_first") + F.col("_before"))
    upto = [F.expr(f"(cast(_i + {k} as decimal(18,0)) * cast(_copies as decimal(18,0))) div _n") for k in (0, 1)]
    numbered = numbered.withColumn("copies", upto[1] - upto[0])
    taken = (F.col("copies") * F.col("_size")).alias("taken")
    return numbered.select(
        F.col("_id").alias(id_col), F.col("_th").alias("text_hash"), F.col("_size").alias("size"), "source_size",
        F.col("_target").alias("target"), "copies", taken,
    )


def mixed_documents(docs: DataFrame, id_col="doc_id", source_col="source", text_col="text", **mixture) -> DataFrame:
    """``docs`` with every row as often as :func:`mix` takes it, perhaps not at all; all columns stay as they are.

    Rows that share id and text count as one document here, taken as often as the one taken most.
    """
    copies = mix(docs, id_col, source_col, text_col, **mixture).where("copies > 0")
    copies = copies.groupBy(F.col(id_col).alias("_id"), "text_hash").agg(F.max("copies").cast("int").alias("copies"))
    copies = materialised(copies, "mix-taken")
    if bytes_of(copies, F.lit(48)) <= LIMITS.broadcast_max_bytes // 8:
        copies = F.broadcast(copies)
    hashed = text_hash(F.coalesce(docs[f"`{text_col}`"], F.lit("")), 3)
    taken = docs.join(copies, docs[f"`{id_col}`"].eqNullSafe(copies["_id"]) & (hashed == copies["text_hash"]))
    each = [docs[f"`{c}`"] for c in docs.columns]
    repeated = taken.select(*each, F.explode(F.array_repeat(F.lit(0), copies["copies"])).alias("_again"))
    return repeated.select(*[repeated[i] for i in range(len(each))])
