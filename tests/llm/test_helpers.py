"""Parts of the operators that need no or little Spark: codes, models, trees, signatures, components."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from feedmill.llm import simple8b
from feedmill.llm.bpe import vocabulary
from feedmill.llm.components import components
from feedmill.llm.html_text import TreeModel, extract, labelled_pages
from feedmill.llm.html_tree import PageTree
from feedmill.llm.jaccard import allocation, band, borne, is_link, is_short, may_be_similar, schemes, signatures, sketch
from feedmill.llm.language import ORDER, Model, _codes, _row_hashes
from feedmill.llm.pieces import byte_slices
from feedmill.llm.shingles import common, set_key, shingle_sets
from tests.conftest import SMALL
from tests.llm.fixtures import LONG, Union, shingle_set

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# Codes of token files


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_256), st.integers(0, 2**64 - 1)), max_size=2500))
def test_simple8b_round_trip(ids):
    values = np.array(ids, np.uint64)
    words, offsets, table = simple8b.encode(values)
    assert simple8b.decode(words, offsets, table, len(values)).tolist() == ids
    assert len(offsets) == -(-len(ids) // simple8b.BLOCK)


def test_simple8b_blocks_decode_apart():
    values = np.random.default_rng(3).integers(0, 1 << 40, 5000).astype(np.uint64)
    words, offsets, table = simple8b.encode(values)
    part = slice(2 * simple8b.BLOCK, 4 * simple8b.BLOCK)
    some = simple8b.decode(words[offsets[2] : offsets[4]], offsets[2:4] - offsets[2], table, 2 * simple8b.BLOCK)
    assert (some == values[part]).all()


def test_simple8b_packs():
    values = np.zeros(6000, np.uint64)
    assert len(simple8b.encode(values)[0]) < 6000 / 50


# Encoding by trie


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet=st.sampled_from(" \n\t'sdtéß日😀1.<|a\xa0\x1d\x0b\x85 _-"), max_size=30) | st.text(max_size=30))
def test_trie_encoding(text):
    library = _library()
    want = library.encode(text, add_special_tokens=False).ids
    ids, lengths = vocabulary(VOCABULARY).encoder.encode(pa.array([text, None]))
    assert ids.tolist() == want and lengths.tolist() == [len(want), 0]


def _library(cache=[]):  # noqa: B006
    if not cache:
        cache.append(Tokenizer.from_file(VOCABULARY))
    return cache[0]


def test_slices_cover_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 50, None, "", "b" * 9, "c" * 200])], ["t"])
    parts = list(byte_slices(batch, 0, 100))
    assert [v for p in parts for v in p.column(0).to_pylist()] == batch.column(0).to_pylist() and len(parts) > 1


# Language models


def test_probabilities_sum_to_one():
    texts = {"x": ["abca bcab caab", "bca"], "y": ["ddab dab"]}
    grams, counts = {}, {}
    for lang, own in texts.items():
        codes, ends = _codes(own)
        rows = [codes[i - ORDER + 1 : i + 1] for b, e in zip([0, *ends[:-1]], ends) for i in range(b + ORDER - 1, e)]
        rows = np.array(rows)
        _, at, n = np.unique(_row_hashes(rows), return_index=True, return_counts=True)
        grams[lang], counts[lang] = rows[at], n
    model = Model(grams, counts)
    alphabet = [0, *map(ord, "abcdz")]  # z stands for all letters never seen
    for context in ([0, 0, 0], [97, 98, 99], [100, 97, 98], [99, 99, 99], [0, 100, 100]):
        codes = np.concatenate([[*context, letter] for letter in alphabet]).astype(np.uint64)
        p = np.exp(model._log_probabilities(codes)[ORDER - 1 :: ORDER])
        assert p.sum(axis=0) == pytest.approx(1, abs=1e-4)


# Signatures: no similar pair is missed


def similar_pair(rng, size):
    """Two sets with a similarity of 3/4 or a little more."""
    both = rng.integers(0, 2**63, size, dtype=np.uint64)
    differ = size // 3
    cut = rng.integers(0, differ + 1)
    a = np.concatenate([both, rng.integers(0, 2**63, cut, dtype=np.uint64)])
    b = np.concatenate([both, rng.integers(0, 2**63, differ - cut, dtype=np.uint64)])
    return np.unique(a), np.unique(b)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 15, 16, 23, 31, 40, 63, 64, 90, 127, 128, 180, 256, 500, 1100])
def test_similar_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for turn in range(150 if size < 200 else 25):
        a, b = similar_pair(rng, size)
        assert is_link(len(a), len(b), common(a, b)) and may_be_similar(len(a), len(b), sketch(a), sketch(b))
        fine = frozenset(k for s in (a, b) for k in schemes(len(s)) if is_short(s, k))
        everyday = np.sort(a[: len(a) // 2]) if turn % 2 else np.zeros(0, np.uint64)
        for way in (fine, frozenset(range(64))):
            assert len(np.intersect1d(signatures(a, way, everyday), signatures(b, way, everyday)))


def test_neighbourhoods_find_similar_sets(monkeypatch):
    """With every segment a one-deletion neighbourhood, too."""
    from feedmill.llm import jaccard

    monkeypatch.setattr(jaccard, "allocation", lambda scheme: jaccard.Allocation(max(4, (1 << scheme) // 2), 1 << scheme))
    rng = np.random.default_rng(5)
    for size in (20, 70, 200, 400):
        for _ in range(40):
            a, b = similar_pair(rng, size)
            fine = frozenset(k for s in (a, b) for k in schemes(len(s)) if is_short(s, k))
            none = np.zeros(0, np.uint64)
            assert len(np.intersect1d(signatures(a, fine, none), signatures(b, fine, none)))


def test_sketches_tell_different_sets_apart():
    rng = np.random.default_rng(6)
    for n in (60, 500, 3000):
        a, b = (np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(2))
        assert not may_be_similar(len(a), len(b), sketch(a), sketch(b))


def test_schemes_meet():
    for small in range(1, 400):
        for large in range(small, small * 4 // 3 + 1):
            shared = set(schemes(small)) & set(schemes(large))
            assert band(small) in shared
            assert min(borne(small, band(small)), borne(large, band(small))) > (small + large) // 7
    assert any(allocation(k).segments for k in range(3, 18)) and any(allocation(k).deleting for k in range(3, 18))


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbÉ \t\n\x0b\x85"), max_size=60), max_size=5))
def test_shingle_sets(texts):
    sets = shingle_sets(texts)
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    for a, x in zip(texts, sets):
        for b, y in zip(texts, sets):
            assert common(x, y) == len(shingle_set(a) & shingle_set(b))
            assert (set_key(x) == set_key(y)) == (shingle_set(a) == shingle_set(b))


def test_shingles_of_long_words():
    a, b = "x" * 9000 + " b c d e", "x" * 9001 + " b c d e"
    sets = shingle_sets([a, b, a, LONG])
    assert common(sets[0], sets[1]) == 0 and common(sets[0], sets[2]) == 1 and len(sets[3]) == len(shingle_set(LONG))


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(5000, 5001 + i) for i in range(50)]
    union = Union({n for e in edges for n in e})
    for a, b in edges:
        union.join(a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {n: union.find(n) for n in union.above if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Pages


@pytest.fixture(scope="module")
def model():
    return TreeModel(labelled_pages())


PAGES = {
    "<header><h1>Site</h1></header><div class='post-content'><h2>T</h2>some words of an introduction<p>a &amp; b</p>tail</div>"
    "<div id=comments><div class=comment><p>A long comment that goes on and on for a while, and then some more</p></div></div>": (
        "T\nsome words of an introduction\na & b\ntail"
    ),
    "only text &lt; no markup": "only text < no markup",
    "<p>one<p>two <b>bold</b>\n x<br>y": "one\ntwo bold x y",
    "<nav><a href=x>Home</a></nav><article><h1>A</h1><p>text<script>var a='<p>no</p>'</script></article><footer>&copy; us": "A\ntext",
    "<div><div><div>": "",
    "<style>p{}</style><!-- x --><form>Name<input value=v></form>": "",
    "<article><p>See <a href=x>a link with very many words that are most of this paragraph</a>.</p><p>b</p></article>": (
        "See a link with very many words that are most of this paragraph.\nb"
    ),
    "<article><h1>T</h1><p>Some words of an article that are long enough to be seen as such.</p></article><div class=userComments>"
    "<p>A long comment that goes on and on for a while, and then some more</p></div><div id=siteFooter><p>words of the owner</p></div>": (
        "T\nSome words of an article that are long enough to be seen as such."
    ),
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(model, page):
    assert model.main_text(page) == PAGES[page]


def test_held_out_pages(model):
    right = total = 0
    for page in labelled_pages(150, seed=1234):
        tree = PageTree(page)
        lengths = [sum(len(t) for _, t in tree.blocks(n)) for n in tree.nodes]
        tree.nodes[0].label = 2
        for node, length, belief in zip(tree.nodes, lengths, model.marginals(tree, lengths)):
            if node.label is None:
                node.label = tree.nodes[node.parent].label
            assert sum(belief) == pytest.approx(1)
            if length:
                total += 1
                right += (belief[0] < 0.5) == (node.label == 1)
    assert right / total > 0.97


def test_marginals_are_exact(model):
    """Message passing against the sum over all assignments, on a small page."""
    from itertools import product

    tree = PageTree("<div class=content><p>some text<div class=ad>x</div></div><p>more")
    lengths = [sum(len(t) for _, t in tree.blocks(n)) for n in tree.nodes]
    leaf = PageTree("")  # node potentials come from beliefs of trees without pairs
    flat = TreeModel.__new__(TreeModel)
    flat.seen, flat.pair = model.seen, {"any": [[1 / 3] * 3] * 3}
    own = flat.marginals(tree, lengths)
    totals = np.zeros((len(tree.nodes), 3))
    for states in product(range(3), repeat=len(tree.nodes) - 1):
        states = (2, *states)
        weight = 1.0
        for i, node in enumerate(tree.nodes[1:], 1):
            pair = model.pair.get(node.tag, model.pair["any"])
            weight *= own[i][states[i]] * pair[states[node.parent]][states[i]]
        for i, s in enumerate(states):
            totals[i, s] += weight
    want = totals / totals.sum(axis=1, keepdims=True)
    assert np.array(model.marginals(tree, lengths)) == pytest.approx(want, abs=1e-9)
    assert leaf.nodes[0].tag == "root"


def test_extraction_keeps_every_page(spark, model):
    rows = [(1, "u", None, "z"), (2, "u", "", "z"), (3, "u", "<p>" + LONG, "z"), (3, "u", "<p>twice", "z"), (None, None, "<b>", "z")]
    found = extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"), model).collect()
    assert [r.main_text for r in found] == ["", "", LONG, "twice", ""]
    assert extract(spark.createDataFrame([], "page_id bigint, html string"), model).count() == 0


def test_extraction_of_the_pages_table(spark, model):
    """The articles of the table, read by a plain pattern."""
    import html
    import re

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    for row in extract(pages, model).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        blocks = [re.sub(r"\s+", " ", b).strip() for b in blocks]
        assert row.main_text == "\n".join(b for b in blocks if b)


# The pipeline


def test_pipeline(spark):
    """Each stage on its own input, against a plain computation where there is one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        kept = docs.collect()
        sizes.append(len(kept))
        assert all(r.text == texts[r.doc_id] for r in kept)
        if name == "exact_dedup":
            assert len({r.text for r in kept}) == len(kept)
    assert sizes[0] >= 0.97 * len(texts) and sizes[1] < sizes[0] and sizes[2] < sizes[1]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == sizes[-1]
    ran = {tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert ran == {tuple(r) for r in last.collect()}


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
