"""Exact Jaccard join of word shingles by partitioning the universe of shingles.

Two sets with a similarity of at least 3/4 differ in at most a seventh of their summed sizes.  For each
band of sizes the shingles are hashed into segments; a set's part in a segment is a
slot.  As differences are few, two similar sets agree in a slot, or all but agree:
*exact* segments are compared as they are and bear one difference less than their
number, segments with a *one-deletion neighbourhood* (the slot, and the slot without each
one of its shingles) bear two each.  Slots are taken in an order common to all sets
until more differences are borne than the pair can have; a signature shared by two
sets makes them candidates, and their whole texts decide.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedmill.llm.arrow import begin_task, by_size, slices, small_batches
from feedmill.llm.components import components
from feedmill.llm.shingles import common, distinct, mix, set_key, shingle_sets
from feedmill.llm.tables import bytes_of, text_hash, whole
from feedmill.operators.limits import LIMITS
from feedmill.operators.storage import materialised

# Similarity of at least UNION_SHARE / 100.
UNION_SHARE = 75
# Common shingles are looked for in a sample of about so many documents; they only order slots.
SAMPLE_DOCS, COMMON_IN, MOST_COMMON = 5_000, 8, 100_000
# Rounds in which one member of a signature's group is compared with the others.
STAR_ROUNDS = 1
# Work of a candidate that turns out not to be similar, in signatures.
FOR_NOTHING = 20
# Sets in groups of a signature with more members are compared by finer ones.
LARGE_GROUP = 32
_SMALLEST_BAND = 3  # sets of fewer than 2^3 shingles share the first band


def band(size: int) -> int:
    return max(size.bit_length() - 1, _SMALLEST_BAND - 1)


def borne(size: int, scheme: int) -> int:
    """Differences that a set's slots must bear in a scheme: one more than a pair can have.

    A scheme is the band of the smaller set.  A set of that band may be the smaller
    one, with a partner up to 4/3 of its size; a set of the next band is the larger one.
    """
    other = size * 4 // 3 if band(size) == scheme else (1 << scheme + 1) - 1
    return (size + other) // 7 + 1


def schemes(size: int) -> list[int]:
    own = band(size)
    return [own, own - 1] if own >= _SMALLEST_BAND and 3 * size <= 4 * ((1 << own) - 1) else [own]


@dataclass(frozen=True)
class Allocation:
    """Segments of a scheme, the first ``deleting`` of them with one-deletion neighbourhoods; 0: a segment per shingle."""

    segments: int
    deleting: int


@lru_cache(maxsize=None)
def allocation(scheme: int) -> Allocation:
    """The cheapest way, by a model of its cost, that bears enough differences.

    The cost of a set is its signatures, and for each the chance that its slot
    holds nothing but shingles of a passage that makes up a fifth of the text: such a signature
    brings candidates for nothing, which cost as much as FOR_NOTHING signatures.  Slot sizes are Poisson distributed; a way counts
    only if it bears enough with five deviations to spare at every size of the band.
    """
    low, high = 1 << scheme, (1 << scheme + 1) - 1
    if scheme < _SMALLEST_BAND:
        return Allocation(0, 0)
    best, lowest = Allocation(0, 0), np.inf
    for segments in sorted({max(4, int(low * x)) for x in (0.35, 0.5, 0.65, 0.8, 1.0, 1.25, 1.5, 2.0)}):
        for share in (0.0, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0):
            deleting, cost, enough = int(share * segments), 0.0, True
            for size in (low, (low + high) // 2, high):
                mean = size / segments
                some, single = 1 - np.exp(-mean), mean * np.exp(-mean)
                bears = (segments - deleting) * some + deleting * (2 * some - single)
                spread = np.sqrt(segments * some * (1 - some) + deleting * single)
                enough &= bears - 5 * spread >= borne(size, scheme)
                rows = (segments - deleting) * some + deleting * (some + mean - single)
                noise = (np.exp(-0.8 * mean) - np.exp(-mean)) / some
                cost += rows / bears * (1 + FOR_NOTHING * noise)
            if enough and cost < lowest:
                best, lowest = Allocation(segments, deleting), cost
    return best


def _segments(values: np.ndarray, segments: int) -> np.ndarray:
    """The segment of scrambled shingles: a range of their upper halves."""
    return ((values >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _slots(shingles: np.ndarray, scheme: int, segments: int):
    """(segment, sum of scrambled shingles, number of shingles, first) of a set's slots in a scheme, and the scrambled shingles in their order."""
    values = np.sort(mix(shingles, 100 + scheme))
    segment = _segments(values, segments)
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    sums = np.add.reduceat(values, first)
    sizes = np.concatenate([first[1:], [len(values)]]) - first
    return segment[first], sums, sizes, first, values


def is_short(shingles: np.ndarray, scheme: int) -> bool:
    """Whether a set's slots cannot bear enough in a scheme (then its segments must be finer)."""
    way = allocation(scheme)
    if not way.segments:
        return False
    sizes = np.bincount(_segments(mix(shingles, 100 + scheme), way.segments), minlength=way.segments)
    return int(np.count_nonzero(sizes) + np.count_nonzero(sizes[: way.deleting] > 1)) < borne(len(shingles), scheme)


def _taken(keys: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places in the order of ``keys``, those marked ``last`` behind the others."""
    order = np.argsort(keys)
    if not last.any():
        return order
    behind = last[order]
    return np.concatenate([order[~behind], order[behind]])


def signatures(shingles: np.ndarray, fine: frozenset[int], common_shingles: np.ndarray) -> np.ndarray:
    """All signatures of a set.

    Slots are ordered by hash, those of common shingles only last.  The hash is that of the slot's
    content, or of the segment where neighbours of the content count as well: sets
    that agree in a slot place it alike, which makes stopping early exact.
    """
    if not len(shingles):
        return np.zeros(0, np.uint64)
    is_common = np.zeros(len(shingles), bool)
    if len(common_shingles):
        at = np.minimum(np.searchsorted(common_shingles, shingles), len(common_shingles) - 1)
        is_common = common_shingles[at] == shingles
    everyday = shingles[is_common]
    found = []
    for scheme in schemes(len(shingles)):
        need, way = borne(len(shingles), scheme), allocation(scheme)
        if scheme in fine or not way.segments:
            sigs = mix(shingles, 500 + scheme)
            found.append(sigs[_taken(sigs, is_common)[:need]])
            continue
        segment, sums, sizes, first, values = _slots(shingles, scheme, way.segments)
        name = mix(segment.astype(np.uint64), 900 + scheme)
        sigs = mix(sums ^ name, 1)
        last = np.zeros(len(sigs), bool)
        if len(everyday):
            last = np.bincount(_segments(mix(everyday, 100 + scheme), way.segments), minlength=way.segments)[segment] == sizes
        if not way.deleting:
            found.append(sigs[_taken(sigs, last)[:need]])
            continue
        deletes = segment < way.deleting
        wide = deletes & (sizes > 1)  # these bear two differences
        taken = _taken(np.where(deletes, name, sigs), last & ~deletes)
        taken = taken[: int(np.searchsorted(np.cumsum(1 + wide[taken]), need)) + 1]
        found.append(sigs[taken])
        wide = taken[wide[taken]]
        slot, many = np.repeat(wide, sizes[wide]), np.cumsum(sizes[wide])
        rows = np.arange(len(slot)) + np.repeat(first[wide] - many + sizes[wide], sizes[wide])
        found.append(mix(sums[slot] - values[rows] ^ name[slot], 1))
    return distinct(np.concatenate(found))


def is_link(a: int, b: int, both: int) -> bool:
    return 100 * both >= UNION_SHARE * (a + b - both)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def sketch(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each of about a fourth as many buckets, at most 255 each."""
    buckets = max(16, (1 << band(len(shingles))) // 2)
    place = (mix(shingles, 77) >> np.uint64(40)).astype(np.int64) * buckets >> 24
    return np.minimum(np.bincount(place, minlength=buckets), 255).astype(np.uint8).tobytes()


def may_be_similar(n: int, m: int, a: bytes, b: bytes) -> bool:
    """False only for sets that differ too much: counts of buckets differ by no more than the sets do."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int32), np.frombuffer(b, np.uint8).astype(np.int32)
    if len(x) != len(y):
        if max(x.max(), y.max()) == 255:
            return True  # capped counts cannot be added up
        width = min(len(x), len(y))
        x, y = x.reshape(width, -1).sum(axis=1), y.reshape(width, -1).sum(axis=1)
    return 7 * int(np.abs(x - y).sum()) <= n + m


_SETS = pa.schema(
    [
        ("_id", pa.int64()), ("_th", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
        ("short", pa.list_(pa.int32())), ("sketch", pa.binary()),
    ]
)


def _sets(texts: list[str | None]) -> list[np.ndarray]:
    """The shingles of each text, found for about 32,000 characters at a time: their arrays stay in a core's cache."""
    return [s for group in by_size(texts, 1 << 15) for s in shingle_sets(group)]


def _described(rows: DataFrame) -> DataFrame:
    """(_id, _th, n, k1, k2, short, sketch): size and identity of each row's set, and the schemes too coarse for it."""

    def run(batches):
        begin_task()
        for batch in batches:
            for part in slices(batch):
                ids, hashes, texts = [c.to_pylist() for c in part.columns]
                sets = _sets(texts)
                keys = [set_key(s) for s in sets]
                short = [[k for k in schemes(len(s)) if is_short(s, k)] if len(s) else [] for s in sets]
                sizes, sketches = [len(s) for s in sets], [sketch(s) for s in sets]
                yield _batch(_SETS, ids, hashes, sizes, [k[0] for k in keys], [k[1] for k in keys], short, sketches)

    return rows.mapInArrow(run, "_id bigint, _th bigint, n bigint, k1 bigint, k2 bigint, short array<int>, sketch binary")


def _common_shingles(rows: DataFrame, n_rows: int) -> np.ndarray:
    """Shingles of many documents, found in a sample of bounded size."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = _sets(part.column(0).to_pylist())
                values, n = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(n)], ["shingle", "n"])

    share = max(1, n_rows // SAMPLE_DOCS)
    sample = rows.where(F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(share)) == 0).select("_text")
    counted = sample.mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= COMMON_IN).orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).select("shingle").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).astype(np.uint64))


_SIGNED = pa.schema([("sig", pa.int64()), ("node", pa.int64()), ("n", pa.int32())])


def _signed(rows: DataFrame, fine: frozenset[int], common_shingles: np.ndarray) -> DataFrame:
    """(sig, node, n): the signatures of each row's set."""
    shared = rows.sparkSession.sparkContext.broadcast(common_shingles)

    def run(batches):
        begin_task()
        for batch in batches:
            for part in slices(batch, 500):
                ids, texts = [c.to_pylist() for c in part.columns]
                sets = _sets(texts)
                found = [signatures(s, fine, shared.value) for s in sets]
                many = [len(f) for f in found]
                yield _batch(
                    _SIGNED,
                    np.concatenate(found).astype(np.int64),
                    np.repeat(np.array(ids, np.int64), many),
                    np.repeat(np.array([len(s) for s in sets], np.int32), many),
                )

    return rows.select("_id", "_text").mapInArrow(run, "sig bigint, node bigint, n int")


_POSTINGS = pa.schema([("sig", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("c_node", pa.int64()), ("c_n", pa.int32()), ("members", pa.int32())])


def _shared_signatures(signed: DataFrame) -> DataFrame:
    """(sig, node, n, c_node, c_n, members) of the signatures that several sets have.

    Rows arrive sorted by signature and are passed on as a stream.  The first member of a group is its
    center; ``members`` counts the group, or is one more than LARGE_GROUP for every larger group.  Of a
    group so many rows are held at most.
    """

    def run(batches):
        held, large = None, None  # rows of the last group while it is small; else its signature and center
        for batch in batches:
            sig, node, n = [c.to_numpy() for c in batch.columns]
            if held is not None:
                sig, node, n = (np.concatenate([h, c]) for h, c in zip(held, (sig, node, n)))
            if not len(sig):
                continue
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.concatenate([first, [len(sig)]]))
            members = np.minimum(size, LARGE_GROUP + 1).astype(np.int32)
            goes_on = large is not None and large[0] == sig[0]
            if goes_on:
                members[0] = LARGE_GROUP + 1
            is_large = members[-1] > LARGE_GROUP
            shared = np.flatnonzero(members[:-1] > 1 if not is_large else members > 1)  # a small last group waits for the rest of it
            many = size[shared]
            c_node, c_n = node[first[shared]], n[first[shared]]
            if goes_on:
                c_node[0], c_n[0] = large[1], large[2]
            if is_large:
                large, held = (sig[-1], c_node[-1], c_n[-1]), None
            else:
                large, held = None, tuple(c[first[-1] :] for c in (sig, node, n))
            # Most signatures are of one set: only the rows of the others are taken further.
            rows = np.arange(many.sum()) + np.repeat(first[shared] - (np.cumsum(many) - many), many)
            if len(rows):
                centers = [np.repeat(c, many) for c in (c_node, c_n, members[shared])]
                yield _batch(_POSTINGS, sig[rows], node[rows], n[rows], *centers)
        if held is not None and len(held[0]) > 1:
            sig, node, n = held
            m = len(sig)
            yield _batch(_POSTINGS, sig, node, n, np.repeat(node[0], m), np.repeat(n[0], m), np.full(m, m, np.int32))

    return signed.repartition("sig").sortWithinPartitions("sig").mapInArrow(
        run, "sig bigint, node bigint, n int, c_node bigint, c_n int, members int"
    )


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches do not differ too much; narrow rows decide before texts move."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 10_000):
                a, b, n, m, x, y = [c.to_pylist() for c in part.columns]
                keep = [i for i in range(len(a)) if may_be_similar(n[i], m[i], x[i], y[i])]
                yield _batch(_PAIRS, [a[i] for i in keep], [b[i] for i in keep])

    def side(name, n, value):
        return sketches.select(F.col("node").alias(name), F.col("n").alias(n), F.col("sketch").alias(value))

    both = pairs.join(side("a", "n", "x"), "a").join(side("b", "m", "y"), "b").select("a", "b", "n", "m", "x", "y")
    return both.mapInArrow(run, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    pairs = materialised(_plausible(pairs, sketches), "jaccard-plausible")
    nodes = materialised(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "jaccard-nodes")
    if bytes_of(nodes, F.lit(32)) <= LIMITS.broadcast_max_bytes // 8:
        nodes = F.broadcast(nodes)
    texts = materialised(rows.select("_id", "_text").join(nodes, "_id", "left_semi"), "jaccard-texts")

    def side(name):
        return texts.select(F.col("_id").alias(name), F.col("_text").alias(f"_{name}"))

    def run(batches):
        left, left_set = None, None
        for batch in batches:
            for part in slices(batch, 500):
                found = []
                a, b, text_a, text_b = [c.to_pylist() for c in part.columns]
                right = _sets(text_b)
                for i, text in enumerate(text_a):
                    if text != left:
                        left, left_set = text, shingle_sets([text])[0]
                    if is_link(len(left_set), len(right[i]), common(left_set, right[i])):
                        found.append(i)
                yield _batch(_PAIRS, [a[i] for i in found], [b[i] for i in found])

    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "_a", "_b")
    return materialised(joined.mapInArrow(run, "a bigint, b bigint").distinct(), "jaccard-links")


def _refined(postings: DataFrame, rows: DataFrame) -> DataFrame:
    """(sig, node, n, rare): finer postings in place of the large groups of a signature.

    The sets in large groups are compared by single shingles, ordered by the number of these sets
    that hold them: the rarest of a set, one more than a similar set can lack, include one that any
    similar set among them takes as well.  ``rare`` counts a set's shingles that at most LARGE_GROUP of them hold;
    it stands where a group is larger and is null in small groups.  Two sets that share a rare shingle and are
    similar meet in a group of one; two that share none differ in all of theirs.
    """
    nodes = postings.where(F.col("members") > LARGE_GROUP).select(F.col("node").alias("_id")).distinct()
    nodes = materialised(nodes, "jaccard-nodes")
    if bytes_of(nodes, F.lit(32)) <= LIMITS.broadcast_max_bytes // 8:
        nodes = F.broadcast(nodes)
    texts = rows.select("_id", "_th", "_text").join(nodes, "_id", "left_semi")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 500):
                ids, hashes, strings = [c.to_pylist() for c in part.columns]
                sets = _sets(strings)
                many = [len(s) for s in sets]
                columns = (np.concatenate(sets).astype(np.int64), np.repeat(ids, many), np.repeat(hashes, many), np.repeat(many, many))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "node", "_th", "n"])

    shingles = materialised(texts.mapInArrow(run, "sig bigint, node bigint, _th bigint, n bigint"), "jaccard-shingles")
    holders = shingles.groupBy("sig").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
    counted = shingles.join(holders, "sig", "left").withColumn("_m", F.coalesce("_m", F.lit(1)))
    order = F.sort_array(F.collect_list(F.struct("_m", F.xxhash64("sig").alias("_h"), "sig"))).alias("_all")
    sets = counted.groupBy("node", "_th", "n").agg(order, F.count_if(F.col("_m") <= LARGE_GROUP).cast("int").alias("rare"))
    need = F.expr("cast((n + n * 4 div 3) div 7 + 1 as int)")
    rarest = F.explode(F.filter(F.slice("_all", F.lit(1), need), lambda t: t["_m"] > 1)).alias("_t")
    rare = F.when(F.col("_t._m") > LARGE_GROUP, F.col("rare")).alias("rare")
    return sets.select(F.col("n").cast("int").alias("n"), "node", "rare", rarest).select(F.col("_t.sig").alias("sig"), "node", "n", rare)


def _possible(a: str, b: str):
    """Whether two sets of sizes n can be similar, as far as sizes and rare shingles tell.

    In a large group they have no rare shingle in common, or meet elsewhere as well.
    """
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    most = F.least(n - F.col(f"{a}rare"), m - F.col(f"{b}rare"))  # null where a group is small
    enough = most * (100 + UNION_SHARE) >= UNION_SHARE * (n + m)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * UNION_SHARE) & F.coalesce(enough, F.lit(True))


def _pairs(rows: DataFrame) -> DataFrame:
    rows = rows.where(_possible("", "c_") & (F.col("node") != F.col("c_node")))
    return rows.select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()


def _linked(postings: DataFrame, rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have a link.

    In each group of a signature one member, the center, is compared with all others.  What is
    then connected needs no further look, nor do members that cannot be similar to any
    other left.  Where a group still has several components, the next center takes its
    turn, and after some rounds all pairs left of different components.
    """
    columns = ["node", "n", "rare", "component"]
    small = postings.where(F.col("members") <= LARGE_GROUP)
    small = small.withColumns({"rare": F.lit(None).cast("int"), "c_rare": F.lit(None).cast("int")})
    fine = materialised(_refined(postings, rows).withColumn("component", F.col("node")), "jaccard-fine")
    members, checked, found = fine, None, None
    for turn in range(STAR_ROUNDS + 1):
        if turn < STAR_ROUNDS:
            # The nearest to all others has the smallest share of rare shingles.
            nearest = F.struct((F.coalesce("rare", F.lit(0)) / F.col("n")).alias("share"), *columns)
            centers = members.groupBy("sig").agg(F.min(nearest).alias("_c"))
            centers = centers.select("sig", *[F.col(f"_c.{c}").alias(f"c_{c}") for c in columns])
            joined = members.join(centers, "sig")
        else:
            joined = members.join(members.select("sig", *[F.col(c).alias(f"c_{c}") for c in columns]), "sig").where("node < c_node")
        pairs = _pairs(joined.where("component <> c_component"))
        if turn == 0:  # the centers of small groups are known from the stream
            pairs = pairs.unionByName(_pairs(small)).distinct()
        pairs = materialised(pairs if checked is None else pairs.join(checked, ["a", "b"], "left_anti"), "jaccard-pairs")
        if not pairs.isEmpty():
            more = _verified(pairs, rows, sketches)
            checked = pairs if checked is None else checked.unionByName(pairs)
            if found is None or not more.isEmpty():
                # Components so far are links as well, and fewer than those they came from.
                links = more if found is None else more.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
                found = materialised(components(links), "jaccard-components")
        if turn == STAR_ROUNDS:
            break
        left = joined.where("node <> c_node").select("sig", "node", "n", "rare")
        if turn == 0:  # pairs are done
            left = left.unionByName(small.where("members > 2 AND node <> c_node").select("sig", "node", "n", "rare"))
        if found is None:  # no center had a candidate; the others still may
            left = left.withColumn("component", F.col("node"))
        else:
            left = left.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        groups = left.groupBy("sig").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"))
        hopeful = F.coalesce(F.col("rare") * 100 <= F.col("n") * (100 - UNION_SHARE), F.lit(True))
        left = left.join(groups.where("_lo < _hi"), "sig").where(hopeful).select("sig", *columns)
        members = materialised(left, "jaccard-open")
        if members.isEmpty():
            break
    return found if found is not None else postings.select("node", F.col("node").alias("component")).limit(0)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``text_hash``, ``n_shingles``, ``component_id``.

    Documents are linked when their sets of five-word shingles have a Jaccard
    similarity of at least 3/4; the component is the smallest id that links reach.
    A text of one to four words is one shingle; a text without words, or null, has
    the empty set and is linked with nothing.  Rows that share an id are one
    document whose links unite.  A row without an id takes the component of an
    equal set that has one, else null.  An empty table gives an empty table; extra columns are not looked at.

    Rows with equal sets are reduced to one before anything is compared, so copies
    cost one aggregation.  Signatures are narrow rows; groups are streamed and give
    stars; members that are open after that round are paired (see the README on tables of shared passages).  Texts move only for candidates.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"), text_hash(whole(text_col), 3).alias("_th"), whole(text_col).alias("_text")
    )
    sets = materialised(_described(rows), "jaccard-sets")
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_th"))).alias("_first")
    classes = sets.where("n > 0").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("_m"), first).where("_m > 1")
    classes = materialised(classes.select("k1", "k2", "_first"), "jaccard-classes")
    copies = sets.join(classes, ["k1", "k2"]).where(~F.struct("_id", "_th").eqNullSafe(F.col("_first"))).select("_id", "_th").dropna()
    copies = materialised(copies.distinct(), "jaccard-copies")
    if bytes_of(copies, F.lit(32)) <= LIMITS.broadcast_max_bytes // 8:
        copies = F.broadcast(copies)
    leaders = rows.where("_id IS NOT NULL").join(copies, ["_id", "_th"], "left_anti")

    fine = frozenset(r[0] for r in sets.select(F.explode("short")).distinct().collect())
    signed = _signed(leaders, fine, _common_shingles(rows, sets.count()))
    sketches = sets.where("n > 0").select(F.col("_id").alias("node"), "n", "sketch")
    postings = materialised(_shared_signatures(signed), "jaccard-postings")
    found = _linked(postings, leaders, sketches)

    placed = sets.join(classes, ["k1", "k2"], "left").withColumn("node", F.coalesce("_first._id", "_id")).join(found, "node", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("_id"))
    return placed.select(
        F.col("_id").alias(id_col), F.col("_th").alias("text_hash"), F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component of :func:`near_groups`, the one with the smallest id; all columns stay.

    Rows without an id or without words stay.  Rows sharing the smallest id and their text all stay.
    """
    groups = materialised(near_groups(docs, id_col, text_col), "jaccard-groups")
    stays = groups.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct(id_col, "text_hash")).alias("_stays"))
    gone = groups.where("n_shingles > 0").join(stays, "component_id").where(F.struct(id_col, "text_hash") != F.col("_stays"))
    gone = materialised(gone.select(F.col(id_col).alias("_gone_id"), F.col("text_hash").alias("_gone_th")).distinct(), "jaccard-gone")
    if bytes_of(gone, F.lit(32)) <= LIMITS.broadcast_max_bytes // 8:
        gone = F.broadcast(gone)
    same = (docs[f"`{id_col}`"] == gone["_gone_id"]) & (text_hash(F.coalesce(docs[f"`{text_col}`"], F.lit("")), 3) == gone["_gone_th"])
    return docs.join(gone, same, "left_anti")
