"""Shards of even size with few cut links, by balanced label propagation.

Documents of one group (equal texts), or of one given link, are linked.  Every document
starts in the shard its id hashes to.  In rounds of joins, linked documents then move
towards the shard where most of their neighbours are, as far as quotas allow, until the
links cut between shards stop falling.  Documents that have the same neighbours in the
same shard are one row of the table that is propagated.  At the end groups that are still
cut, or lie beyond a quota, take the room that is left, and rows without links fill every shard up to
exactly even counts.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmill.llm.tables import text_hash, whole
from feedmill.operators.ordering import number_within, ranged, running_sum
from feedmill.operators.skew import fits_a_task, lookup_join
from feedmill.operators.storage import known_size, materialised

N_SHARDS = 8
# Groups above one such share of the rows are packed one by one: fewer than this many.
PACKED = 8000
# Rounds end when one takes away less than this part of the links that are cut.
LEAST_GAIN = 0.05
_KEY = ["_h1", "_h2"]
_PIECE = "_h1 bigint, _h2 bigint, _size bigint, _from bigint, _upto bigint, _to int"


def _pick(values: list[int], index: Column) -> Column:
    """The entry of a list with one value per shard."""
    return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), (index + 1).cast("int"))


def cut_links(state: DataFrame, links: DataFrame | None = None) -> float:
    """Links between rows of different shards; rows of one key are all linked if there are no ``links``."""
    if links is None:
        rows = F.sum("_n").cast("double")
        between = state.groupBy(*_KEY).agg(((rows * rows - F.sum(F.col("_n").cast("double") ** 2)) / 2).alias("_w"))
        return between.agg(F.sum("_w")).first()[0] or 0.0
    return _neighbours(state, links).where("_shard <> _there").count() / 2


def _neighbours(state: DataFrame, links: DataFrame) -> DataFrame:
    """``links`` (both ways) with the shards of both ends, ``_shard`` and ``_there``, and the rows ``_n`` at the first."""
    other = state.select(F.col("_h1").alias("_o1"), F.col("_h2").alias("_o2"), F.col("_shard").alias("_there"))
    ends = F.struct("_h1", "_h2").alias("_from"), F.struct("_o1", "_o2").alias("_to")
    near = lookup_join(links.select(*ends), other.select(F.struct("_o1", "_o2").alias("_to"), "_there"), "_to")
    own = state.select(F.struct(*_KEY).alias("_from"), "_shard", "_n")
    return lookup_join(near, own, "_from").select("_from.*", "_to.*", "_shard", "_there", "_n")


def _proposals(state: DataFrame, links: DataFrame | None, turn: int) -> DataFrame:
    """(key, _shard, _n, _to, _gain): the moves that lower the cut links by at least ``_gain``, whichever are made.

    Without ``links`` every part of a group moves to its largest part; ties are drawn anew each round.
    With links half of the documents, drawn each round, look at their neighbours in the other half, which
    stay where they are, and go where more of these are than of all their neighbours at home.
    """
    if links is None:
        lead = F.max(F.struct("_n", F.xxhash64(F.lit(turn), *_KEY, "_shard").alias("tie"), "_shard")).alias("_lead")
        leads = state.groupBy(*_KEY).agg(lead, F.count(F.lit(1)).alias("_parts")).where("_parts > 1")
        moves = state.join(leads, _KEY).where("_shard <> _lead._shard")
        return moves.select(*_KEY, "_shard", "_n", F.col("_lead._shard").alias("_to"), (F.col("_n").cast("double") * F.col("_lead._n")).alias("_gain"))

    def moving(*key):
        return F.pmod(F.xxhash64(F.lit(turn), *key), F.lit(2)) == 0

    near = _neighbours(state, links).where(moving(*_KEY))
    near = near.where((F.col("_shard") == F.col("_there")) | ~moving("_o1", "_o2"))
    counted = near.groupBy(*_KEY, "_shard", "_n", "_there").agg(F.count(F.lit(1)).alias("_w"))
    tie = F.xxhash64(F.lit(turn), *_KEY, "_there")
    away = F.col("_there") != F.col("_shard")
    best = F.max(F.when(away, F.struct("_w", tie.alias("tie"), "_there"))).alias("_best")
    home = F.coalesce(F.sum(F.when(~away, F.col("_w"))), F.lit(0)).alias("_home")
    found = counted.groupBy(*_KEY, "_shard", "_n").agg(best, home).where("_best._w > _home")
    return found.select(*_KEY, "_shard", "_n", F.col("_best._there").alias("_to"), (F.col("_best._w") - F.col("_home")).cast("double").alias("_gain"))


def _flows(wanted: dict[tuple[int, int], int], load: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """Rows that may move between each two shards: what comes into a shard fits its room and what leaves it.

    Two shards exchange as many rows as both wish.  Of the other wishes all are granted first; a shard that
    would get too much then cuts down what comes in, which keeps rows in other shards, until all fit.
    """
    exchanged = {(a, b): min(n, wanted.get((b, a), 0)) for (a, b), n in wanted.items()}
    flows, fits = {pair: n - exchanged[pair] for pair, n in wanted.items()}, False
    while not fits:
        fits = True
        for s in range(len(quota)):
            into = sum(n for (_, to), n in flows.items() if to == s)
            allowed = max(0, quota[s] - load[s]) + sum(n for (here, _), n in flows.items() if here == s)
            if into > allowed:
                flows = {k: n * allowed // into if k[1] == s else n for k, n in flows.items()}
                fits = False
    return {pair: n + exchanged[pair] for pair, n in flows.items()}


def propagate(state: DataFrame, quota: list[int], links: DataFrame | None = None) -> tuple[DataFrame, list[float]]:
    """``state`` (_h1, _h2, _shard, _n) after the rounds of propagation, and the cut links before and after each.

    ``_n`` rows of a key lie in a shard.  Without ``links`` the rows of a key are linked; else ``links``
    (_h1, _h2, _o1, _o2, both ways) link keys that have one shard each.  In a round proposals between
    two shards are accepted by the running sum of their rows, greatest gain first, up to a flow that counts departures
    as room; the driver sees one number per pair of shards.
    """
    shards, cuts = range(len(quota)), [cut_links(state, links)]
    while cuts[-1] > 0:
        moves = materialised(_proposals(state, links, len(cuts)), "shard-moves", sized=True)
        wanted = {(r[0], r[1]): r[2] for r in moves.groupBy("_shard", "_to").agg(F.sum("_n")).collect()}
        load = {r[0]: r[1] for r in state.groupBy("_shard").agg(F.sum("_n")).collect()}
        flows = _flows(wanted, [load.get(s, 0) for s in shards], quota)
        upto, total = {}, 0
        for pair in sorted(wanted):
            upto[pair] = total + flows[pair]
            total += wanted[pair]
        if not any(flows.values()):
            break
        order = [F.desc("_gain"), *_KEY]
        if fits_a_task(known_size(moves)[0]):
            summed = moves.withColumn("_at", F.sum("_n").over(Window.orderBy("_shard", "_to", *order)) - F.col("_n"))
        else:
            summed = running_sum(moves, ["_shard", "_to", *order], "_n", "_at")
        n_shards = len(quota)
        limit = _pick([upto.get((k // n_shards, k % n_shards), 0) for k in range(n_shards**2)], F.col("_shard") * n_shards + F.col("_to"))
        accepted = summed.where(F.col("_at") + F.col("_n") <= limit).select(*_KEY, "_shard", "_to")
        moved = state.join(accepted, [*_KEY, "_shard"], "left").withColumn("_shard", F.coalesce("_to", "_shard"))
        state = materialised(moved.groupBy(*_KEY, "_shard").agg(F.sum("_n").alias("_n")), "shard-state", sized=True)
        cuts.append(cut_links(state, links))
        if cuts[-1] > cuts[-2] * (1 - LEAST_GAIN):
            break
    return state, cuts


def _pack(groups: list[tuple], room: list[int], widest: int) -> list[tuple]:
    """(h1, h2, size, from, upto, shard) of the pieces of ``groups``: (h1, h2, size, shard, whole).

    Largest first.  A group that propagation made whole keeps its shard while there is room; others
    go where they fill the room best.  A group larger than ``widest`` fills the emptiest shards; one that
    only lacks room waits until the others are placed, then does the same.  ``room`` is reduced by what is placed.
    """
    shards, pieces, waiting = range(len(room)), [], []

    def place(group, split):
        h1, h2, size, own, stays = group
        at = 0
        while at < size:
            fits = [s for s in shards if room[s] >= size - at]
            if not fits and not split:
                return False
            if stays and own in fits:
                to = own
            elif fits:
                to = min(fits, key=lambda s: (room[s], s != own, s))
            else:
                to = max(shards, key=lambda s: (room[s], s == own, -s))
            n = min(size - at, room[to])
            pieces.append((h1, h2, size, at, at + n, to))
            room[to] -= n
            at += n
        return True

    for group in sorted(groups, key=lambda g: (-g[2], *g[:2])):
        if not place(group, split=group[2] > widest):
            waiting.append(group)
    for group in waiting:
        place(group, split=True)
    return pieces


def _shares(demand: list[int], room: list[int]) -> list[int]:
    """Rows of the small groups that each shard takes: what it is asked for within its room, the rest where room is left."""
    shares = [min(d, r) for d, r in zip(demand, room)]
    rest = sum(demand) - sum(shares)
    for s, r in enumerate(room):
        more = min(rest, r - shares[s])
        shares[s], rest = shares[s] + more, rest - more
    return shares


def _groups(state: DataFrame) -> DataFrame:
    """(key, _size, _prefers, _whole) of the groups: the shard with most of its rows, and whether it has all."""
    # Ties go to a shard chosen by the group's hash.
    most = F.max(F.struct("_n", F.xxhash64(*_KEY, "_shard").alias("tie"), F.col("_shard").alias("to")))
    whole_ = (F.count(F.lit(1)) == 1).alias("_whole")
    return state.groupBy(*_KEY).agg(F.sum("_n").alias("_size"), most["to"].alias("_prefers"), whole_)


def _totals(groups: DataFrame, shard: str, n_shards: int) -> list[int]:
    found = {r[0]: r[1] for r in groups.groupBy(shard).agg(F.sum("_size")).collect()}
    return [found.get(s, 0) for s in range(n_shards)]


def _placed(rows: DataFrame, n: int, quota: list[int], links: DataFrame | None) -> tuple[list[tuple], DataFrame]:
    """The pieces of the groups placed one by one, and (_h1, _h2, _to) of all other groups.

    Rows are counted before any shuffle, so a group of any size is a few rows.  The fewer than eight groups
    larger than a shard are placed first, the others propagated.  Then the large groups are
    packed where propagation has left them cut or without room.  The many small ones that are whole stay
    where they are as far as room allows; those left are cut into stretches by a running sum of their
    sizes over the room; a group on a border, at most one per shard, is packed at the end.
    """
    n_shards, widest, room = len(quota), max(quota), list(quota)
    cells = rows.groupBy(*_KEY, "_shard").agg(F.count(F.lit(1)).alias("_n"))
    if links is None:
        cells = cells.withColumn("_size", F.sum("_n").over(Window.partitionBy(*_KEY))).where("_size > 1")
    else:
        cells = cells.join(links.select(*_KEY).distinct(), _KEY, "left_semi").withColumn("_size", F.col("_n"))
    cells = materialised(cells, "shard-cells")
    state = [*_KEY, "_shard", "_n"]
    over = _groups(cells.where(F.col("_size") > widest).select(*state))
    pieces = _pack([tuple(r) for r in over.collect()], room, widest)
    start = materialised(cells.where(F.col("_size") <= widest).select(*state), "shard-state", sized=True)
    groups = materialised(_groups(propagate(start, room, links)[0]), "shard-groups", sized=True)

    large = F.col("_size") > n // PACKED
    packed = [tuple(r) for r in groups.where(large).collect()]
    pieces += _pack(packed, room, widest)
    small = groups.where(~large)
    if len(packed) == known_size(groups)[0]:
        return pieces, small.select(*_KEY, F.col("_prefers").alias("_to"))
    totals = _totals(small.where("_whole"), "_prefers", n_shards)
    starts = [sum(totals[:s]) for s in range(n_shards)]
    kept = running_sum(small.where("_whole"), ["_prefers", *_KEY], "_size", "_at")
    inside = F.col("_at") + F.col("_size") - _pick(starts, F.col("_prefers")) <= _pick(room, F.col("_prefers"))
    kept = materialised(kept.withColumn("_stays", inside).drop("_at"), "shard-kept")
    stay = kept.where("_stays").select(*_KEY, F.col("_prefers").alias("_to"), "_size")
    room = [r - t for r, t in zip(room, _totals(stay, "_to", n_shards))]

    left = kept.where("NOT _stays").drop("_stays").unionByName(small.where("NOT _whole"))
    shares = _shares(_totals(left, "_prefers", n_shards), room)
    ends = [sum(shares[: s + 1]) for s in range(n_shards)]
    laid = running_sum(left, ["_prefers", *_KEY], "_size", "_at")
    to = sum(((F.col("_at") >= end).cast("int") for end in ends[:-1]), F.lit(0))
    laid = laid.withColumn("_to", to).withColumn("_border", F.col("_at") + F.col("_size") > _pick(ends, F.col("_to")))
    laid = materialised(laid, "shard-small-groups")
    room = [r - t for r, t in zip(room, _totals(laid.where("NOT _border"), "_to", n_shards))]
    border = laid.where("_border").select(*_KEY, "_size", "_prefers", F.lit(False).alias("_whole"))
    pieces += _pack([tuple(r) for r in border.collect()], room, max(room))
    return pieces, stay.drop("_size").unionByName(laid.where("NOT _border").select(*_KEY, "_to"))


def _assigned(rows: DataFrame, pieces: list[tuple], small: DataFrame) -> DataFrame:
    """``rows`` with the shard of their group and ``_free``: whether they have no link.

    Groups packed one by one are joined by broadcast, so no task receives a large one whole; rows
    of a group in several pieces are numbered over many tasks.
    """
    key, columns = ["_h1", "_h2"], rows.columns
    spark = rows.sparkSession
    packed = spark.createDataFrame(pieces, _PIECE)
    whole_groups = F.broadcast(packed.where("_upto - _from = _size").select(*key, "_to"))
    cut = [p for p in pieces if p[4] - p[3] < p[2]]
    linked = rows.join(whole_groups, key)
    if cut:
        split = F.broadcast(packed.where("_upto - _from < _size").withColumnsRenamed({"_h1": "_g1", "_h2": "_g2"}).drop("_size"))
        cut_keys = F.broadcast(spark.createDataFrame(sorted({p[:2] for p in cut}), "_h1 bigint, _h2 bigint"))
        numbered = number_within(rows.join(cut_keys, key, "left_semi"), key, [F.col("_id")], "_k", 0, max(p[2] for p in cut))
        inside = (F.col("_h1") == F.col("_g1")) & (F.col("_h2") == F.col("_g2")) & (F.col("_k") >= F.col("_from")) & (F.col("_k") < F.col("_upto"))
        linked = linked.unionByName(numbered.join(split, inside).drop("_g1", "_g2", "_k", "_from", "_upto"))
    others = rows.join(F.broadcast(packed.select(*key).distinct()), key, "left_anti").join(small, key, "left")
    every = linked.unionByName(others).withColumn("_free", F.col("_to").isNull())
    return every.withColumn("_shard", F.coalesce("_to", "_shard")).select(*columns, "_free")


def _both_ways(links: DataFrame, rows: DataFrame) -> DataFrame:
    """``links`` (a, b) of ids as pairs of keys of ``rows``, each once in both directions."""
    ends = [*_id_key(F.col("a")), *[c.alias(n) for c, n in zip(_id_key(F.col("b")), ("_o1", "_o2"))]]
    one = links.dropna(subset=["a", "b"]).where("a <> b").select(*ends)
    both = one.unionByName(one.select(F.col("_o1").alias("_h1"), F.col("_o2").alias("_h2"), F.col("_h1").alias("_o1"), F.col("_h2").alias("_o2")))
    known = rows.select(*_KEY).distinct()
    both = both.distinct().join(known, _KEY, "left_semi").join(known.toDF("_o1", "_o2"), ["_o1", "_o2"], "left_semi")
    return materialised(both.select(*_KEY, "_o1", "_o2"), "shard-links", sized=True)


def _id_key(value: Column) -> list[Column]:
    """Two hashes of an id; equal numbers of different types hash alike."""
    return [F.xxhash64(F.lit(seed), value.cast("string")).alias(name) for seed, name in ((1, "_h1"), (2, "_h2"))]


def shard_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = N_SHARDS, links: DataFrame | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``.

    The law is ``rows``: shards differ by at most one row.  ``size`` is the text's
    bytes in UTF-8 (null: none) plus 1, ``text_crc32`` that of the text (null: of an
    empty one), ``slot`` numbers a shard's rows from 0 without gaps, linked rows
    first.  Rows of equal texts are linked (null counts as empty) and share a shard
    while a shard has room for the whole group; a group larger than a shard's quota fills
    as few shards as it needs.  With ``links``, a table of ids ``a`` and ``b``, these take the place
    of equal texts: repeated links count once, links of an id with itself, with null or with an id that
    ``docs`` lacks count for nothing, and rows that share an id are linked like one.  Null
    ids and repeated rows are rows like others.  An empty table gives an empty table; extra
    columns are not looked at.

    Only narrow rows are shuffled, and they are numbered across many tasks.  The
    driver sees one number per pair of shards and the fewer than PACKED largest groups.
    """
    text = whole(text_col)
    key = _KEY
    hashes = [text_hash(text, 1).alias("_h1"), text_hash(text, 2).alias("_h2")] if links is None else _id_key(F.col(id_col))
    start = F.pmod(F.xxhash64(F.lit(11), F.col(id_col)), F.lit(n_shards))
    rows = docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("bigint").alias("_size"), F.crc32(text.cast("binary")).alias("_crc"),
        *hashes, start.cast("int").alias("_shard"),
    )
    rows = materialised(rows, "shard-rows")
    n = rows.count()
    quota = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]
    links = None if links is None else _both_ways(links, rows)
    rows = _assigned(rows, *_placed(rows, n, quota, links))

    # Rows in the order (shard, linked first, group, id); what lies beyond a shard's quota
    # fills the free slots of the others.
    laid_out = ranged(rows, ["_shard", "_free", *key, "_id"])
    counts = laid_out.groupBy("_part", "_shard").agg(F.count(F.lit(1)).alias("_here"), F.min("_row").alias("_first"))
    counts = materialised(counts, "shard-counts")
    sizes = {r["_shard"]: r["n"] for r in counts.groupBy("_shard").agg(F.sum("_here").alias("n")).collect()}
    extra, gaps, taken, filled = [0] * n_shards, [], 0, 0
    for s in range(n_shards):
        extra[s] = taken  # rows beyond the quotas of the shards before
        taken += max(0, sizes.get(s, 0) - quota[s])
        missing = max(0, quota[s] - sizes.get(s, 0))
        if missing:
            gaps.append((filled, s, sizes.get(s, 0)))
            filled += missing
    earlier = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_here").over(earlier), F.lit(0))).drop("_here")
    numbered = laid_out.join(counts, ["_part", "_shard"])
    slot = F.col("_row") - F.col("_first") + F.col("_before")
    beyond = _pick(extra, F.col("_shard")) + slot - _pick(quota, F.col("_shard"))
    new_shard, new_slot = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for first, s, used in gaps:  # the last gap that begins at or before the row's number
        new_shard = F.when(beyond >= first, F.lit(s)).otherwise(new_shard)
        new_slot = F.when(beyond >= first, beyond - first + used).otherwise(new_slot)
    stays = slot < _pick(quota, F.col("_shard"))
    return numbered.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.when(stays, F.col("_shard")).otherwise(new_shard).cast("int").alias("shard"),
        F.when(stays, slot).otherwise(new_slot).alias("slot"),
    )
