"""Phrase mining against SQL and a plain computation; the trie against a dictionary."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from feedmill.llm import phrases
from feedmill.llm.double_array import build
from feedmill.llm.phrases import collocations
from tests.compare import assert_same, connect
from tests.conftest import SMALL
from tests.llm.fixtures import TEXTS, no_documents, odd_documents

_LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, most=2000):
    """{(lang, rank): (phrase, a, l, r, n, score)} by counting everything."""
    pieces = {}
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            pieces.setdefault("und" if lang is None else lang, []).append(re.findall(r"[^\x20\x09]+", piece))
    out = {}
    for lang, lists in pieces.items():
        f = Counter(tuple(p[i : i + k]) for p in lists for k in range(1, 6) for i in range(len(p) - k + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = [p for p, c in f.items() if len(p) > 1 and c >= least]
        held = Counter()
        for q in candidates:
            for inside in {q[i:j] for i in range(len(q)) for j in range(i + 2, len(q) + 1)} - {q}:
                held[inside] = max(held[inside], f[q])
        rows = []
        for p in candidates:
            if 100 * held[p] >= 100 * f[p]:
                continue
            cuts = [(1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:most], 1):
            out[lang, rank] = (phrase.decode(), -a, left, right, n, -score)
    return out


def found(df):
    rows = df.collect()
    out = {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_sql(spark):
    assert_same(entry.queries()["op11_phrases"](spark, SMALL), connect(SMALL), entry.oracle_sql()["op11_phrases"])


@pytest.mark.parametrize("shard, chunk", [(250_000, 1 << 18), (3, 20)])
def test_phrases_of_the_documents(spark, monkeypatch, shard, chunk):
    """Also with tries cut in shards of three phrases."""
    monkeypatch.setattr(phrases, "SHARD", shard)
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)
    least = 40 if shard > 3 else 150
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert found(collocations(docs, least)) == brute(rows, least)


def test_phrases_of_odd_rows(spark):
    rows = [(i, text, lang, source) for i, text, lang, source in TEXTS]
    rows += [(100 + i, "A b\ta  B a b. a b,a b\x0bc d\x0cc\x1cd é É c\xa0d C D", lang, None) for i, lang in enumerate([None, "und", "x", "x", ""])]
    rows += [(200, "z z z z z z z z", "x", None), (201, "é a é a é a Z b Z b Z b", "x", None)]
    want = brute([(r[2], r[1]) for r in rows], 2)
    assert {lang for lang, _ in want} >= {"und", "x"}
    docs = odd_documents(spark, rows)
    assert found(collocations(docs, 2)) == want
    assert found(collocations(docs, 2, most=3)) == {k: v for k, v in want.items() if k[1] <= 3}
    assert found(collocations(docs.select(F.col("text").alias("a"), F.col("lang").alias("n")), 2, text_col="a", lang_col="n")) == want


def test_nothing_frequent(spark):
    assert collocations(no_documents(spark)).count() == 0
    empty = collocations(odd_documents(spark, [(1, "few words", "en", None), (2, None, None, None)]))
    assert empty.count() == 0
    assert empty.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *[(c, "bigint") for c in ("a", "l", "r", "n", "score")]]
    assert collocations(odd_documents(spark, [(i, "word", "en", None) for i in range(200)])).count() == 0


def test_scores_beyond_64_bits(spark):
    a, n, left, middle, right = 7_000_000_019, 9_000_000_000_000_001, 7_000_000_123, 7_000_000_021, 8_000_000_001
    table = spark.createDataFrame([([left, middle, a], [right, middle + 5, a], a, n)], "heads array<bigint>, tails array<bigint>, a bigint, n bigint")
    cut = table.select(phrases._weakest_cut(F.col("a"), F.col("n"), 3).alias("c")).first()["c"]
    want = min((1000 * a * n // (x * y), k, x, y) for k, x, y in [(1, left, middle + 5), (2, middle, right)])
    assert 1000 * a * n > 1 << 64 and (cut["score"], cut["k"], cut["l"], cut["r"]) == want


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_trie_finds_what_a_dictionary_finds(data):
    depth, most = data.draw(st.integers(1, 4)), data.draw(st.sampled_from([2, 5, 40]))
    word = st.integers(0, most)
    phrases_in = sorted(set(data.draw(st.lists(st.tuples(*[word] * depth), min_size=1, max_size=200))))
    trie = build(np.array(phrases_in, np.int64).reshape(-1, depth))
    text = np.array(data.draw(st.lists(st.integers(-1, most + 1), max_size=200)), np.int32)
    places, numbers = trie.walk(text)
    known = {p: i for i, p in enumerate(phrases_in)}
    grams = [tuple(text[i : i + depth].tolist()) for i in range(len(text) - depth + 1)]
    assert list(zip(places.tolist(), numbers.tolist())) == [(i, known[g]) for i, g in enumerate(grams) if g in known]


def test_a_large_trie_stays_small():
    """Nodes with very many children: the array must not grow with their number times the words."""
    random = np.random.default_rng(5)
    rows = np.unique((random.random((30_000, 2)) ** 3 * 5_000).astype(np.int64), axis=0)
    trie = build(rows)
    assert len(trie.check) < 12 * len(rows)
    places, numbers = trie.walk(rows.ravel())
    assert set(numbers.tolist()) == set(range(len(rows)))
