"""Phrase collocations: frequent phrases of 2 to 5 words, scored by their weakest cut.

A phrase can be frequent only if its first and its last words but one are, so the candidates of a length
are pairs of frequent phrases of the length before that overlap at neighbouring places of a text.
Level by level the frequent phrases go into double-array tries, which are broadcast in
shards of bounded size.  In every task numpy walks all places of a few chunks of its texts through
a trie at once; the places of neighbouring accepting states are numbered and counted
together, and the counts of all tasks are summed.  A worker holds one batch of
chunks and one shard at a time, and gives back what it freed.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from feedmill.llm import double_array
from feedmill.llm.arrow import begin_task, release_memory, slices, small_batches
from feedmill.llm.pieces import byte_slices
from feedmill.llm.tables import whole
from feedmill.operators.ordering import dense_index
from feedmill.operators.storage import discard, materialised

MOST_WORDS = 5
SHARD = 250_000  # words or phrases that are broadcast together
CHUNK_WORDS = 1 << 18  # a chunk of words is closed when it reaches this
SLICE_BYTES = 4 << 20
PART_BYTES = 2 << 20  # of codes that go through the shards together, or one chunk

# What ends a piece, what ends a word, the letters that are lower-cased.
_ENDS_PIECE, _ENDS_WORD = b".,;:!?\n\x0b\x0c\r", b" \t"
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
_TABLE[list(_ENDS_PIECE)] = 10
_TABLE[list(_ENDS_WORD)] = 32


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts behind one another, for each the number of the piece that holds it)."""
    data = _TABLE[np.frombuffer(("\n".join(texts.to_pylist()) + "\n").encode(), np.uint8)]
    ends = (data == 10) | (data == 32)
    first = ~ends
    first[1:] &= ends[:-1]
    starts = np.flatnonzero(first)
    piece = np.cumsum(data == 10)[starts]
    stops = np.flatnonzero(ends & np.concatenate([[False], ~ends[:-1]]))
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[~ends].tobytes())]
    return pa.Array.from_buffers(pa.string(), len(starts), buffers), piece


_CHUNK = pa.schema([("lang", pa.string()), ("codes", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_CHUNK_SQL = "lang string, codes binary, words array<string>, counts array<bigint>"


def _chunk(lang: str, parts: list[tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
    """Words as numbers of this chunk's own list of words; -1 stands between pieces."""
    coded = pa.chunked_array([words for words, _ in parts]).combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int32)
    before = np.concatenate([[0], np.cumsum([p[-1] + 1 for _, p in parts[:-1]])]) if parts else []
    piece = np.concatenate([p + b for (_, p), b in zip(parts, before)])
    gap = np.flatnonzero(piece[1:] != piece[:-1]) + 1
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    row = [[lang], [np.insert(codes, gap, -1).tobytes()], [coded.dictionary], [counts]]
    lists = [pa.ListArray.from_arrays([0, len(counts)], c) for c in (coded.dictionary, pa.array(counts))]
    return pa.RecordBatch.from_arrays([pa.array(row[0], pa.string()), pa.array(row[1], pa.binary()), *lists], schema=_CHUNK)


def chunks(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, codes, words, counts): the texts of one language in chunks of bounded size."""

    def run(batches):
        begin_task()
        held, n_held = {}, 0

        def closed(langs):
            for lang in langs:
                yield _chunk(lang, held.pop(lang))

        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                langs = part.column(0).dictionary_encode()
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    words, piece = split_words(part.column(1).filter(pc.equal(langs.indices, i)))
                    if not len(words):
                        continue
                    held.setdefault(lang, []).append((words, piece))
                    n_held += len(words)
                    if (own := sum(len(w) for w, _ in held[lang])) >= CHUNK_WORDS:
                        yield from closed([lang])
                        n_held -= own
                if n_held >= 4 * CHUNK_WORDS:  # many languages with few words each
                    yield from closed(list(held))
                    n_held = 0
            release_memory()
        yield from closed(list(held))

    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), whole(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, _CHUNK_SQL)


def _shards(table: DataFrame, n: int, columns: list[str], made) -> list:
    """``made(rows, first id)`` of every SHARD rows by id, each collected, broadcast and let go before the next."""
    context, out = table.sparkSession.sparkContext, []
    for first in range(0, n, SHARD):
        rows = table.where(F.col("id").between(first, first + SHARD - 1)).select("id", *columns).toArrow().sort_by("id").combine_chunks()
        out.append(context.broadcast(made(rows, first)))
        del rows
        release_memory()
    return out


def _through(shards: list, use) -> None:
    """``use`` the broadcast values one after another; a worker holds one at a time, and keeps it if it is the only one."""
    for shard in shards:
        use(shard.value)
        if len(shards) > 1:
            vars(shard).pop("_value", None)


def _let_go(shards: list) -> None:
    """Take the shards from the memory of the executors when what needed them is written."""
    for shard in shards:
        shard.destroy()


def _numbered_words(found: DataFrame, vocabulary: DataFrame, n: int) -> tuple[DataFrame, list]:
    """(ids): the codes of each chunk as numbers of frequent words, one -1 for all else between them; and the shards it reads."""

    def made(rows, first):
        langs = rows["lang"].combine_chunks()
        parts = {lang: rows.filter(pc.equal(langs, lang)) for lang in langs.unique().to_pylist()}
        return {lang: (part["phrase"].combine_chunks(), part["id"].to_numpy()) for lang, part in parts.items()}

    shards = _shards(vocabulary, n, ["lang", "phrase"], made)

    def run(batches):
        begin_task()
        for batch in batches:
            for part in slices(batch, limit=PART_BYTES):
                langs, codes, words, _ = part.columns
                ids = [np.full(len(w) + 1, -1, np.int32) for w in words]  # the last stands for -1

                def use(known):
                    for row, lang in enumerate(langs.to_pylist()):
                        if lang in known:
                            at = pc.index_in(words[row].values, value_set=known[lang][0])
                            there = at.is_valid().to_numpy(zero_copy_only=False)
                            ids[row][:-1][there] = known[lang][1][at.drop_null().to_numpy()]

                _through(shards, use)
                for row, own in enumerate(ids):
                    numbers = own[np.frombuffer(codes[row].as_buffer(), np.int32)]
                    kept = (numbers >= 0) | np.concatenate([[True], numbers[:-1] >= 0])
                    yield pa.RecordBatch.from_arrays([pa.array([numbers[kept].tobytes()], pa.binary())], ["ids"])

    return found.mapInArrow(run, "ids binary"), shards


_PAIRS = "u bigint, v bigint, n bigint"


def _pairs(texts: DataFrame, level: DataFrame, n: int, length: int) -> tuple[DataFrame, list]:
    """(u, v, a): how often phrases u and v of a level begin at neighbouring places; and the shards it reads."""

    def made(rows, first):
        words = rows["words"].combine_chunks().flatten().to_numpy()
        return first, double_array.build(words.reshape(len(rows), length))

    tries = _shards(level, n, ["words"], made) if length > 1 else []

    def counted(state):
        both = (state[:-1] >= 0) & (state[1:] >= 0)
        candidates, number = np.unique(state[:-1][both] * n + state[1:][both], return_inverse=True)
        counts = np.bincount(number, minlength=len(candidates))
        return pa.RecordBatch.from_arrays([pa.array(candidates // n), pa.array(candidates % n), pa.array(counts)], ["u", "v", "n"])

    def run(batches):
        begin_task()
        for batch in batches:
            for part in slices(batch, limit=PART_BYTES):
                words = [np.frombuffer(x.as_buffer(), np.int32) for x in part.column(0)]
                if length == 1:
                    yield from (counted(w.astype(np.int64)) for w in words)
                    continue
                states = [np.full(len(w), -1, np.int64) for w in words]

                def use(known):
                    first, trie = known
                    for w, state in zip(words, states):
                        places, accepted = trie.walk(w)
                        state[places] = accepted + first

                _through(tries, use)
                yield from map(counted, states)

    return texts.mapInArrow(run, _PAIRS).groupBy("u", "v").agg(F.sum("n").alias("a")), tries


def _longer(pairs: DataFrame, level: DataFrame, least: int) -> DataFrame:
    """The next level: frequent pairs with their words, and the counts of all their beginnings and ends."""
    frequent = pairs.where(F.col("a") >= least)

    def side(name, *columns):
        return level.select(F.col("id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    joined = frequent.join(side("u", "lang", "phrase", "words", "heads"), "u").join(side("v", "last", "words", "tails"), "v")
    return joined.select(
        "u", "v", F.col("u_lang").alias("lang"), F.concat("u_phrase", F.lit(" "), "v_last").alias("phrase"), F.col("v_last").alias("last"),
        F.concat("u_words", F.slice("v_words", -1, 1)).alias("words"), "a",
        F.concat("u_heads", F.array("a")).alias("heads"), F.concat("v_tails", F.array("a")).alias("tails"),
    )


def _weakest_cut(a, n, length: int):
    """(score, k, l, r) of the cut with the lowest score, ties by smallest k; exact for products of up to 38 digits."""

    def cut(k):
        left, right = F.col("heads")[k - 1], F.col("tails")[length - k - 1]
        top = F.lit(1000).cast("decimal(4,0)") * a.cast("decimal(19,0)") * n.cast("decimal(19,0)")
        exact = top.cast("decimal(38,0)")
        product = (left.cast("decimal(19,0)") * right.cast("decimal(19,0)")).cast("decimal(38,0)")
        return F.struct(F.call_function("div", exact, product).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.array(*[cut(k) for k in range(1, length)]))


def collocations(
    docs: DataFrame, least: int = 100, most: int = 2000, text_col: str = "text", lang_col: str = "lang", most_words: int = MOST_WORDS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``most`` phrases of each language by score.

    A-Z is lower-cased, texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and
    tabs into words; null counts as an empty text, a null language as ``und``.  Candidates are
    phrases of 2 to ``most_words`` words inside a piece that occur ``a >= least`` times in their language, overlaps
    included.  The score of a cut into parts that occur l and r times is floor(1000 * a * n / (l * r)), n being all
    words of the language; the lowest cut counts, then the smallest first part.  A candidate that a
    longer one holds each time it occurs is left out.  Order: score and a descending, phrase ascending by bytes.
    Rows repeat in the counts as often as in the table.  An empty table, or one without frequent
    phrases, gives an empty table; other columns are not looked at.
    """
    found = materialised(chunks(docs, text_col, lang_col), "phrase-chunks", "zstd")
    counted = found.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("_w"))
    counts = materialised(
        counted.groupBy("lang", F.col("_w.words").alias("phrase")).agg(F.sum("_w.counts").alias("a")), "phrase-words"
    )
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    vocabulary = materialised(dense_index(counts.where(F.col("a") >= least), [F.col("lang"), F.col("phrase")], "id"), "phrase-vocabulary")
    level = vocabulary.select(
        "id", "lang", "phrase", F.col("phrase").alias("last"), F.array("id").alias("words"), F.array("a").alias("heads"), F.array("a").alias("tails")
    )
    n = vocabulary.count()
    numbered, shards = _numbered_words(found, vocabulary, n)
    texts = materialised(numbered, "phrase-texts", "zstd")
    discard(found)  # all that is needed of it is written
    _let_go(shards)

    levels = []
    for length in range(2, most_words + 1):
        if not n:
            break
        pairs, shards = _pairs(texts, level, n, length - 1)
        level = materialised(dense_index(_longer(pairs, level, least), [F.col("u"), F.col("v")], "id"), f"phrases-{length}")
        _let_go(shards)
        n = level.count()
        levels.append((length, level))
    if not levels:
        levels = [(2, _longer(docs.sparkSession.createDataFrame([], "u bigint, v bigint, a bigint"), level, least).withColumn("id", F.col("u")))]

    scored = None
    for i, (length, level) in enumerate(levels):
        rows = level.select("id", "lang", "phrase", "a", "heads", "tails")
        if i + 1 < len(levels):
            # What a longer candidate of any length holds every time, one of one more word holds as well.
            holders = levels[i + 1][1].select(F.explode(F.array("u", "v")).alias("id"), F.col("a").alias("_held"))
            held = holders.groupBy("id").agg(F.max("_held").alias("_held"))
            rows = rows.join(held, "id", "left").where("_held IS NULL OR _held < a")
        rows = rows.join(totals, "lang").withColumn("_cut", _weakest_cut(F.col("a"), F.col("n"), length))
        rows = rows.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")
        scored = rows if scored is None else scored.unionByName(rows)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
