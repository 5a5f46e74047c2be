"""Small tables with every odd case, and helpers that compute results the plain way."""

import collections
import re

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    # Names that operators might use themselves.
    " _id string, _text string, _h1 string, _size string, words string, ids string, size int, copies int, node string, component_id string"
)
LONG = " ".join(f"word{i % 977} lies{i}" for i in range(30_000))
PASSAGE = "this passage of more than forty characters is found in very many documents of all kinds"

TEXTS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\r\x0b\x0c ", None, None), (4, "word", "en", "b"),
    (5, "one two three four", "en", "b"), (6, "one two three four five", "en", None), (7, "one two three four five six", "en", "\U0001f600"),
    (8, LONG, "en", "a"), (9, LONG + " and an end", "en", "a"), (10, "Same text here for all of them\nand a second line", "en", "a"),
    (11, "Same text here for all of them\nand a second line", "en", "b"), (12, "same text here for all of them\nand a second line", "en", "b"),
    (13, f"first\n{PASSAGE}\n\n  {PASSAGE.upper()}  \nlast", "en", "c"), (14, f"{PASSAGE}\nx", "de", "c"), (15, PASSAGE, "de", "c"),
    (16, f"y\n{PASSAGE}", "de", "c"), (17, f"{PASSAGE}\t\n", "de", "c"), (18, "日本語のテキスト です。 İstanbul ÉCOLE", "fr", "c"),
    (19, "<|endoftext|> it's  \n  <|endoftext|>x", "fr", "d"), (20, "123 456 !!! ---", "fr", "d"),
    (-5, "negative ids are ids as well and come first of all", "fr", "d"), (None, "a row that has no id at all", "fr", "e"),
    (None, None, None, None), (10, "Same text here for all of them\nand a second line", "en", "a"), (4, "another text with the id of another row", "en", "b"),
    (1 << 62, "the largest id \x1c\x85\xa0 of them", None, "f"),
]


def odd_documents(spark, rows=None):
    rows = TEXTS if rows is None else rows
    clash = ("x", "y", "z", "1", "w", "i", 7, 9, "n", "c")
    return spark.createDataFrame([(i, t, lang, s, 1, *clash) for i, t, lang, s in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]


_LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


class Union:
    def __init__(self, nodes):
        self.above = {n: n for n in nodes}

    def find(self, x):
        while self.above[x] != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.above[max(a, b)] = min(a, b)


def jaccard_components(rows):
    """{doc_id: (set size, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = collections.defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    both = collections.Counter((a, b) for ids in holders.values() for k, b in enumerate(ids) for a in ids[:k])
    union = Union(sets)
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            union.join(a, b)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}
