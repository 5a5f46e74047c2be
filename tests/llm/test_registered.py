"""Registered queries as they are registered, against the tokenizers library or a plain computation."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from feedmill.llm.bpe import digests
from feedmill.llm.language import held_out, identify, train
from feedmill.llm.mixing import mix
from feedmill.llm.token_files import through_files
from tests.conftest import SMALL
from tests.llm.fixtures import jaccard_components, no_documents, odd_documents, rows_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encoded(library, text):
    """(number of ids, hash of the ids, hash of the text decoded from them) by the library."""
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_thirteen_operators_are_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


def test_op6(spark, library):
    found = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op6_bpe"](spark, SMALL).collect()}
    assert found == {i: encoded(library, text) for i, text in rows_of(spark, SMALL)}


def test_digests_of_odd_rows(spark, library):
    docs = odd_documents(spark)
    want = sorted((str(r.doc_id), *encoded(library, r.text)) for r in docs.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in digests(docs, VOCABULARY).collect()) == want
    assert digests(no_documents(spark), VOCABULARY).count() == 0


def test_op9(spark, library):
    found = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op9_token_files"](spark, SMALL).collect()}
    want, start = {}, 0
    for i, text in rows_of(spark, SMALL):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert found == want


def test_words_with_odd_white_space_in_token_files(spark, library):
    """Words encoded many at a time must come out as each alone does."""
    spaces = ["\x0b", "\x1c", "\x85", "\xa0", "　", " ", "\n", "\t", "\r\n", "  "]
    texts = [f"a{s}b c{s} d {s}e Ġf g{s}" for s in spaces] + [" ".join(f"x{k}{s}y{k}" for k in range(50)) for s in spaces]
    docs = odd_documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in through_files(docs, VOCABULARY).collect()}
    assert found == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}


def test_op7(spark):
    found = entry.queries()["op7_ngram_jaccard"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == jaccard_components(rows_of(spark, SMALL))


def test_stages_of_the_pipeline(spark, library):
    """Each stage on its own input, against what it should keep."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = stages["language_id"](spark, docs, SMALL)
    judged = identify(docs, train(docs.where(~held_out())), prefix="p_").where(F.col("p_accepted"))
    assert {r.doc_id for r in known.collect()} == {r.doc_id for r in judged.collect()}

    known = spark.createDataFrame(known.collect(), docs.schema)
    largest = {}
    for r in known.collect():
        largest[r.text or ""] = max(r.doc_id, largest.get(r.text or "", r.doc_id))
    single = stages["exact_dedup"](spark, known, SMALL)
    single = spark.createDataFrame(single.collect(), docs.schema)
    assert {r.doc_id for r in single.collect()} == set(largest.values())

    near = stages["near_dedup"](spark, single, SMALL)
    components = jaccard_components([(r.doc_id, r.text) for r in single.collect()])
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for _, c in components.values()})

    near = spark.createDataFrame(near.collect(), docs.schema)
    mixed = stages["mix_sources"](spark, near, SMALL).collect()
    copies = {r.doc_id: r.copies for r in mix(near).collect()}
    assert {i: n for i, n in copies.items() if n} == {i: sum(r.doc_id == i for r in mixed) for i in {r.doc_id for r in mixed}}

    last = stages["bpe"](spark, spark.createDataFrame(mixed, docs.schema), SMALL).collect()
    assert sorted(tuple(r) for r in last) == sorted((r.doc_id, *encoded(library, r.text)) for r in mixed)
