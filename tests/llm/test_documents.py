"""The document operators against SQL or a plain computation, and on odd tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from feedmill.llm.bpe import decode, encode
from feedmill.llm.exact import drop_duplicates, exact_duplicates
from feedmill.llm.fingerprints import BINS, fingerprints
from feedmill.llm.jaccard import drop_near_duplicates, near_groups
from feedmill.llm.language import UNDETERMINED, held_out, identify, train
from feedmill.llm.lines import drop_repeated_lines, line_bitmaps
from feedmill.llm.mixing import mix, mixed_documents, targets
from feedmill.llm.sharding import shard_rows
from feedmill.llm.token_files import through_files
from tests.compare import assert_same, connect
from tests.conftest import SMALL
from tests.llm.fixtures import PASSAGE, SCHEMA, TEXTS, jaccard_components, no_documents, odd_documents, rows_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture
def no_broadcast(monkeypatch):
    from feedmill.operators.limits import LIMITS

    monkeypatch.setattr(LIMITS, "broadcast_max_bytes", 0)
    monkeypatch.setattr(LIMITS, "broadcast_max_rows", 0)


def test_all_operators_are_registered():
    names = sorted(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op2_line_dedup", "op10_exact_dedup"])
def test_query_against_sql(spark, name):
    assert_same(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name])


@pytest.mark.parametrize("name", ["op2_line_dedup", "op10_exact_dedup"])
def test_query_against_sql_without_broadcast(spark, no_broadcast, name):
    assert_same(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name])


# Exact duplicates


def test_exact_duplicates_of_odd_rows(spark):
    found = exact_duplicates(odd_documents(spark), extra={"t": F.col("text")}).collect()
    assert len(found) == len(TEXTS)
    empty = [r for r in found if not r.t]
    assert {(r.keep_id, r.group_size) for r in empty} == {(2, 3)}
    assert [r.doc_id for r in empty if r.kept] == [2]
    same = [r for r in found if r.t and r.t.startswith("Same text")]
    assert {(r.keep_id, r.group_size) for r in same} == {(11, 3)} and sum(r.kept for r in same) == 1
    assert all(r.kept and r.keep_id == r.doc_id for r in found if r.group_size == 1)


def test_rows_sharing_the_kept_id_leave_one(spark):
    docs = odd_documents(spark, [(3, "t", "en", "a")] * 4 + [(1, "t", "en", "a")])
    assert sorted((r.keep_id, r.kept) for r in exact_duplicates(docs).collect()) == [(3, False)] * 4 + [(3, True)]


def test_drop_duplicates_keeps_columns(spark):
    left = drop_duplicates(odd_documents(spark))
    assert left.columns == odd_documents(spark).columns
    assert left.count() == len({t or "" for _, t, _, _ in TEXTS})


# Lines


def test_lines_of_odd_rows(spark):
    found = drop_repeated_lines(odd_documents(spark))
    assert found.columns[: len(odd_documents(spark).columns)] == odd_documents(spark).columns
    by = {r.doc_id: r for r in found.where("doc_id BETWEEN 13 AND 17 OR doc_id = 2").collect()}
    # Document 17 is the largest holder; its line has white space at the end.
    assert by[13]._kept_text == "first\n\nlast" and (by[13]._n_lines, by[13]._n_dropped) == (5, 2)
    assert by[17]._kept_text == f"{PASSAGE}\t\n" and by[17]._n_dropped == 0
    assert by[15]._kept_text == "" and by[15]._n_dropped == 1
    assert (by[2]._n_lines, by[2]._kept_text) == (1, "")


def test_bitmaps_beyond_one_word(spark):
    line = "a line of enough characters to be looked at"
    rows = [(i, "\n".join(["short"] * 70 + [line] * 3 + ["end"]), "en", "a") for i in range(5)]
    words = {r._id: [tuple(w) for w in r.words] for r in line_bitmaps(odd_documents(spark, rows)).collect()}
    assert words == {i: [(1, 0b111 << 6)] for i in range(4)}
    texts = {r.doc_id: r._kept_text for r in drop_repeated_lines(odd_documents(spark, rows)).collect()}
    assert texts[0] == "\n".join(["short"] * 70 + ["end"]) and texts[4] == rows[4][1]


# Mixing


def brute_targets(sizes, weights, share, most):
    """Shares by weight; what is above a bound goes to the others until none is above."""
    budget, open_, out = share * sum(sizes), set(range(len(sizes))), {}
    while open_:
        unit = budget / sum(weights[i] for i in open_)
        above = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        if not above:
            return [out.get(i, unit * weights[i]) for i in range(len(sizes))]
        for i in above:
            out[i] = most * sizes[i]
            budget -= out[i]
        open_ -= above
    return [out[i] for i in range(len(sizes))]


def test_targets(spark):
    rows = [(False, f"s{i}", n, 1) for i, n in enumerate([100, 5, 1000, 40, 0, 7])] + [(True, "", 300, 1)]
    sources = spark.createDataFrame(rows, "_none boolean, _source string, _total bigint, _docs bigint")
    found = {(r._none, r._source): r._target for r in targets(sources).collect()}
    want = brute_targets([r[2] for r in rows], [5, 2, 1, 5, 2, 1, 5], 1.5, 2)
    assert [found[r[0], r[1]] for r in rows] == pytest.approx(want)


def test_mixture(spark, documents):
    found = mix(documents).toPandas()
    again = mix(documents.repartition(7)).toPandas()
    assert found.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()
    found["source"] = documents.select("doc_id", "source").toPandas().set_index("doc_id").loc[found.doc_id, "source"].values
    assert (found.taken == found.copies * found["size"]).all() and found.copies.between(0, 2).all()
    for _, own in found.groupby("source"):
        target, size = own.target.iloc[0], own["size"].to_numpy()
        assert own.source_size.iloc[0] == size.sum()
        assert abs(own.taken.sum() - target) <= size.max() / 2
        # The rates min(2, exp(lambda size)) that meet the target, by bisection.
        low, high = -64.0, 64.0
        for _ in range(200):
            middle = (low + high) / 2
            got = (size * np.minimum(2, np.exp(np.minimum(middle * size / size.mean(), 40)))).sum()
            low, high = (middle, high) if got < target else (low, middle)
        rates = np.minimum(2, np.exp(np.minimum(low * size / size.mean(), 40)))
        assert (np.abs(own.copies - rates) > 1.001).sum() <= 2  # all but two repairs are a rounding


def test_mixture_of_odd_rows(spark):
    found = mix(odd_documents(spark)).collect()
    assert len(found) == len(TEXTS) and all(r.taken <= 2 * r.size for r in found)
    assert {r.size for r in found if r.doc_id in (1, 2, 3)} == {0}
    taken = mixed_documents(odd_documents(spark))
    assert taken.columns == odd_documents(spark).columns
    assert max(Counter(r.doc_id for r in taken.where("doc_id IN (5, 6, 7, 8, 9)").collect()).values()) <= 2
    hot = odd_documents(spark, [(i, "a few words of one size", "en", "a") for i in range(40)] + [(99, "b", "en", "b")])
    sums = Counter()
    for r in mix(hot).collect():
        sums[r.target] += r.taken
    assert all(abs(taken - target) <= 3 for target, taken in sums.items())


# Fingerprints


def spark_hash(value, seed=42):
    data = value.encode() if isinstance(value, str) else (value & (1 << 64) - 1).to_bytes(8, "little")
    return xxhash.xxh64_intdigest(data, seed=seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values):
    seed = 42
    for v in values:
        seed = spark_hash(v, seed)
    return signed(seed)


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    if not words:
        return ""
    hashes = [signed(spark_hash(w)) for w in words]
    bins = {}
    for i in range(max(1, len(hashes) - 4)):
        h = chain(hashes[i : i + 5])
        b = (h >> 57) + BINS // 2
        bins[b] = min(bins.get(b, h), h)
    filled = []
    for b in range(BINS):
        nearest = b if b in bins else min(bins, key=lambda o: hashlib.md5(f"{b}-{o}".encode()).digest())
        filled.append(bins[nearest] & 255)
    return "".join(f"{v:02X}" for v in filled)


def test_fingerprints(spark, documents):
    rows = rows_of(spark, SMALL)
    found = {r.doc_id: r for r in fingerprints(documents).collect()}
    assert len(found) == len(rows)
    for k, (i, text) in enumerate(rows[:40]):
        after = rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (brute_fingerprint(text), brute_fingerprint(edited))
        agree = sum(r.fingerprint[j : j + 2] == r.edited_fingerprint[j : j + 2] for j in range(0, 2 * BINS, 2)) / BINS
        assert r.near_edited == pytest.approx(max(0, (agree - 1 / 256) / (1 - 1 / 256)))
    last = rows[-1][0]
    assert found[last].near_next == (1.0 if found[last].fingerprint == found[rows[0][0]].fingerprint else found[last].near_next)


def test_fingerprints_of_odd_rows(spark, no_broadcast):
    found = fingerprints(odd_documents(spark)).collect()
    assert len(found) == len(TEXTS)
    prints = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[1] == prints[2] == prints[3] == {""} and prints[10] == prints[11]
    largest = next(r for r in found if r.doc_id == 1 << 62)  # followed by the first row, which has no id
    assert largest.n_chars == len(TEXTS[-1][1])
    alone = fingerprints(odd_documents(spark, [(7, "only one text is here", "en", "a")])).collect()
    assert alone[0].near_next == 1.0 and alone[0].n_chars == 21


# Languages


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs.where(~held_out()))
    found = identify(docs.select("doc_id", "text", "lang"), model).where(held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert sum(r.accepted for r in found) >= 0.97 * len(found)
    noise = "xqzk vwpj qqxz zkkv jwqx zzxq kvjq xwzp " * 5
    odd = identify(odd_documents(spark, [(1, noise, None, None)]), model, prefix="p_").collect()[0]
    assert not odd.p_accepted


def test_language_of_odd_rows(spark):
    model = train(odd_documents(spark))
    found = identify(odd_documents(spark), model).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == UNDETERMINED) == (not letters) and 0 <= r.score <= 1
    assert train(no_documents(spark)) is None
    assert identify(odd_documents(spark), None).where("accepted OR lang_pred <> 'und'").isEmpty()


def test_held_out_is_the_crc_of_the_id(spark):
    found = spark.range(500).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)


# Shards


def check_shards(found, n_rows, n_shards=8):
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(found) == n_rows and set(slots) <= set(range(n_shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, [])) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1


def test_shards(spark, documents):
    found = shard_rows(documents).collect()
    texts = dict(rows_of(spark, SMALL))
    check_shards(found, len(texts))
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in found)
    groups = {}
    for r in found:
        groups.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in groups.values())


def test_shards_of_odd_rows_and_a_hot_group(spark):
    check_shards(shard_rows(odd_documents(spark)).collect(), len(TEXTS))
    rows = [(i, "hot" if i % 3 == 0 else f"pair {i // 4}", "en", "a") for i in range(200)]
    found = shard_rows(odd_documents(spark, rows)).collect()
    check_shards(found, 200)
    assert shard_rows(odd_documents(spark, rows[:3])).count() == 3


# Tokens


def test_encoding_and_token_files(spark, documents, library):
    for docs in (documents.select("doc_id", "text"), odd_documents(spark).select("doc_id", "text")):
        rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        encoded = decode(encode(docs, VOCABULARY), VOCABULARY).collect()
        for r in encoded:
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            assert np.frombuffer(r.ids, "<u4").tolist() == ids
            assert r.decoded == library.decode(ids, skip_special_tokens=False)
        lists = {}
        for i, text in rows:
            lists.setdefault(i, []).append(library.encode(text, add_special_tokens=False).ids + [2])
        found = sorted(through_files(docs, VOCABULARY).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in found] == [i for i, _ in rows]
        start = 0
        for r in found:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert r.start == start and r.n_tokens == len(ids) and ids in lists[r.doc_id]
            lists[r.doc_id].remove(ids)
            start += len(ids)


def test_decoding_any_ids(spark, library):
    ids = [[3, 50256, 100, 7], [], [220], [162, 243], [94, 162]]
    rows = [(i, np.array(x, "<u4").tobytes()) for i, x in enumerate(ids)] + [(9, None)]
    found = {r.k: r.decoded for r in decode(spark.createDataFrame(rows, "k int, ids binary"), VOCABULARY).collect()}
    assert found[9] == "" and all(found[i] == library.decode(x, skip_special_tokens=False) for i, x in enumerate(ids))


# Near duplicates


def test_near_groups(spark, documents):
    want = jaccard_components(rows_of(spark, SMALL))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(documents).collect()} == want


@pytest.mark.parametrize("broadcast", [True, False])
def test_near_groups_of_chains_and_hot_passages(spark, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    base = [f"w{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(12):  # each is near the one before, the ends are far apart
        rows.append((100 - i, " ".join(f"v{i}x{j}" if j < 7 * i else base[j] for j in range(120)), "en", "a"))
    for i in range(60):  # a common passage with a few words of their own, more or less like one another
        rows.append((200 + i, " ".join(passage + [f"q{i}y{j}" for j in range(5 + i // 3)]), "en", "a"))
    rows += [(300 + i, "the very same text in many copies of it", "en", "a") for i in range(30)]
    want = jaccard_components([r[:2] for r in rows])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(odd_documents(spark, rows)).collect()} == want
    left = drop_near_duplicates(odd_documents(spark, rows))
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c in want.values()})


def test_near_groups_of_odd_rows(spark):
    found = near_groups(odd_documents(spark)).collect()
    assert len(found) == len(TEXTS)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[9][0][1] == 8 and by[12][0][1] == 10
    assert by[6] != by[5] and sorted(by[None], key=str) == [(0, None), (4, None)]
    left = drop_near_duplicates(odd_documents(spark))
    assert left.columns == odd_documents(spark).columns
    kept = [r.doc_id for r in left.collect()]
    assert {1, 2, 3, None} <= set(kept) and not {9, 11, 12} & set(kept)


# All of them


@pytest.mark.parametrize(
    "operator",
    [exact_duplicates, drop_repeated_lines, mix, fingerprints, shard_rows, near_groups, drop_near_duplicates, drop_duplicates,
     mixed_documents, lambda d: through_files(d, VOCABULARY), lambda d: encode(d.select("text"), VOCABULARY)],
)
def test_empty_table(spark, operator):
    assert operator(no_documents(spark)).count() == 0


def test_schema_of_fixture_matches_documents(spark, documents):
    assert SCHEMA.startswith(", ".join(f"{n} {t}" for n, t in documents.dtypes))
