"""Main text of web pages by a graphical model on the tree of their elements.

Every block element is boilerplate, content, or a container of both.  Node
potentials come from its tag, its names and its own text, pair potentials from
parent and child.  Sum-product messages up and down the tree give each element's exact
marginals, and the text of elements that are most likely content is kept.  The
potentials are counted from labelled pages.
"""

from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, types as T

from feedmill.llm.arrow import with_columns
from feedmill.llm.html_tree import Node, PageTree

BOILERPLATE, CONTENT, CONTAINER = STATES = (0, 1, 2)
# Labelled pages the model is trained on.
TRAINING_PAGES = 600
_SMOOTHING, _PRIOR, _SIBLINGS = 0.5, 2.0, 4


def features(node: Node, length: int) -> list[str]:
    """What is seen of an element with ``length`` characters of text: the names it bears, its length, its share of links."""
    size = sum(length > bound for bound in (0, 15, 60, 200))
    links = 0 if not node.linked else 1 + (2 * node.linked >= length)
    return [f"size {size}", f"links {links}", *{f"name {n}" for n in node.names}]


class TreeModel:
    """Potentials counted from pages whose elements bear their state in ``data-label``."""

    def __init__(self, pages: Iterable[str]):
        seen, totals, pairs, rows = Counter(), Counter(), Counter(), Counter()
        for page in pages:
            tree = PageTree(page)
            tree.nodes[0].label = CONTAINER
            for node in tree.nodes[1:]:
                above = tree.nodes[node.parent].label
                if node.label is None:  # an element without a label is what its parent is
                    node.label = above
                totals[node.label] += 1
                for tag in (node.tag, "any"):
                    pairs[above, tag, node.label] += 1
                    rows[above, tag] += 1
                length = sum(len(text) for _, text in tree.blocks(node))
                seen.update((f, node.label) for f in features(node, length))
        # An unknown name says nothing.
        self.seen = {f: [(seen[f, s] + _SMOOTHING) / (totals[s] + 2 * _SMOOTHING) for s in STATES] for f, _ in seen}
        usual = {p: [(pairs[p, "any", s] + _SMOOTHING) / (rows[p, "any"] + 3 * _SMOOTHING) for s in STATES] for p in STATES}

        def row(above, tag):
            """The child's state given its parent's and its tag; few cases lean on all tags together."""
            return [(pairs[above, tag, s] + _PRIOR * usual[above][s]) / (rows[above, tag] + _PRIOR) for s in STATES]

        self.pair = {tag: [row(p, tag) for p in STATES] for _, tag in rows}

    def marginals(self, tree: PageTree, lengths: list[int]) -> list[list[float]]:
        """The probability of each state for each element, by messages upward and then downward."""
        nodes, usual = tree.nodes, self.pair["any"]
        belief, children = [[0.0, 0.0, 1.0]], Counter(node.parent for node in nodes)
        for node, length in zip(nodes[1:], lengths[1:]):
            x, y, z = 1.0, 1.0, 1.0
            for feature in features(node, length):
                if feature in self.seen:
                    a, b, c = self.seen[feature]
                    x, y, z = x * a, y * b, z * c
                    top = max(x, y, z)
                    x, y, z = x / top, y / top, z / top
            # What many siblings show is no more than what a few would: they are alike for one reason.
            weight = min(1.0, _SIBLINGS / children[node.parent])
            belief.append([x**weight, y**weight, z**weight])
        upward = [None] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            x, y, z = belief[i]
            upward[i] = message = [row[0] * x + row[1] * y + row[2] * z for row in self.pair.get(nodes[i].tag, usual)]
            product = [b * m for b, m in zip(belief[nodes[i].parent], message)]
            top = max(product)
            belief[nodes[i].parent] = [p / top for p in product]
        for i in range(1, len(nodes)):
            # What the parent knows without this child's own message.
            x, y, z = (b / m for b, m in zip(belief[nodes[i].parent], upward[i]))
            pair = self.pair.get(nodes[i].tag, usual)
            product = [b * (x * pair[0][s] + y * pair[1][s] + z * pair[2][s]) for s, b in enumerate(belief[i])]
            total = sum(product)
            belief[i] = [p / total for p in product]
        return belief

    def main_text(self, page: str | None) -> str:
        """The content blocks in page order, one per line; bare text between the parts of a page counts as content."""
        if not page:
            return ""
        tree = PageTree(page)
        blocks = [tree.blocks(node) for node in tree.nodes]
        lengths = [sum(len(text) for _, text in own) for own in blocks]
        found = []
        for node, own, length, belief in zip(tree.nodes, blocks, lengths, self.marginals(tree, lengths)):
            if own and belief[BOILERPLATE] < 0.5 and (belief[CONTENT] >= 0.5 or 2 * node.linked < length):
                found += own
        return "\n".join(text for _, text in sorted(found))


# Names that authors of pages give to their parts.
_NAMES = {
    "nav": "nav menu navbar navigation topnav breadcrumb breadcrumbs toc",
    "header": "header masthead site-header top logo branding",
    "footer": "footer site-footer colophon copyright bottom legal",
    "aside": "sidebar aside widget related recommended trending popular more-links",
    "notice": "cookie cookie-banner consent notice gdpr alert popup modal newsletter subscribe paywall overlay banner",
    "ad": "ad ads advert advertisement ad-slot sponsored sponsor promo promotion",
    "comments": "comments comment comment-list disqus respond replies discussion reader-comments responses",
    "form": "form search login signup contact-form",
    "social": "share social share-buttons follow tags meta byline-links",
    "content": "content article post entry main story article-body post-content entry-content text body-text",
}
_NAMES = {k: v.split() for k, v in _NAMES.items()}


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 7) -> Iterable[str]:
    """Pages of usual layouts, drawn by rule, each element labelled with its state."""
    random = np.random.Generator(np.random.PCG64(seed))

    def words(low, high):
        lengths = random.integers(2, 9, random.integers(low, high + 1))
        return " ".join("".join(chr(97 + c) for c in random.integers(0, 26, k)) for k in lengths)

    def chance(p):
        return random.random() < p

    def element(tag, label, inner, names=None):
        given = f' {"id" if chance(0.2) else "class"}="{random.choice(_NAMES[names])}"' if names else ""
        return f"<{tag}{given} data-label={label}>{inner}</{tag}>"

    def links(count):
        items = "".join(f"<li><a href='/x'>{words(1, 3)}</a></li>" for _ in range(count))
        return f"<ul>{items}</ul>"

    def linked(low, high):
        """Words of an article, some with a link that may be most of them."""
        if chance(0.95):
            return words(low, high)
        return f"{words(0, max(1, high // 4))} <a href='/x'>{words(1, max(1, high // 2))}</a>{words(0, max(1, high // 4))}"

    def text(label, count, low=4, high=70):
        return "".join(element("p", label, linked(low, high) if label else words(low, high)) for _ in range(count))

    def boilerplate(kind):
        short = f"<p>{words(2, 12)}</p>" if chance(0.5) else words(2, 12)
        if kind == "comments":
            one = lambda: element(random.choice(["div", "li", "div", "article"]), 0, f"<h4>{words(1, 2)}</h4>{text(0, 1 + chance(0.4), 3, 60)}", "comments")
            inner = f"<h3>{words(1, 3)}</h3>" + "".join(one() for _ in range(random.integers(1, 6)))
            return element(random.choice(["section", "div", "ol"]), 0, inner, "comments")
        if kind in ("nav", "aside", "social"):
            tag = {"nav": "nav", "aside": "aside", "social": "div"}[kind] if chance(0.7) else "div"
            inner = links(random.integers(2, 9)) if chance(0.8) else f"<h3>{words(1, 3)}</h3>{short}"
            return element(tag, 0, inner, kind if tag == "div" or chance(0.4) else None)
        if kind == "form":
            inner = f"<label>{words(1, 3)}</label><input><textarea>{words(0, 3)}</textarea><button>{words(1, 2)}</button>"
            return element("form", 0, inner, "form" if chance(0.4) else None)
        tag = kind if kind in ("header", "footer") and chance(0.75) else random.choice(["div", "div", "section"])
        inner = short + (links(random.integers(1, 6)) if chance(0.3) else "") + (f"<p><a href='/x'>{words(1, 3)}</a></p>" if chance(0.3) else "")
        if kind == "header":
            inner = (f"<h1>{words(1, 4)}</h1>" if chance(0.4) else "") + inner
        return element(tag, 0, inner, kind if tag in ("div", "section") or chance(0.3) else None)

    def content():
        brief = chance(0.15)
        parts = [element("h1", 1, words(1, 12))] if chance(0.8) else []
        for _ in range(random.integers(1, 4 if brief else 14)):
            draw = random.random()
            if draw < 0.72:
                parts.append(text(1, 1, 1, 8) if brief or chance(0.15) else text(1, 1, 8, 120))
            elif draw < 0.80:
                parts.append(element(random.choice(["h2", "h3"]), 1, words(1, 8)))
            elif draw < 0.85:
                parts.append(element("blockquote", 1, text(1, 1)))
            elif draw < 0.90:
                items = "".join(element("li", 1, linked(3, 25)) for _ in range(random.integers(2, 6)))
                parts.append(element(random.choice(["ul", "ol"]), 1, items))
            elif draw < 0.93:
                parts.append(element("figure", 1, element("figcaption", 1, words(3, 15))))
            elif draw < 0.95:
                cells = "".join(element("td", 1, words(1, 6)) for _ in range(3))
                parts.append(element("table", 1, element("tr", 1, cells)))
            else:
                parts.append(boilerplate(random.choice(["ad", "social", "notice", "aside", "form"])))
        if chance(0.25):
            parts += [boilerplate(k) for k in ("social", "aside", "form", "comments") if chance(0.5)]
        if chance(0.15):
            parts.insert(1, boilerplate(random.choice(["nav", "notice", "ad"])))
        inner = "".join(parts)
        draw = random.random()
        if draw < 0.45:
            return element("article", 1, inner, "content" if chance(0.4) else None)
        if draw < 0.6:
            return element("main", 1, inner, "content" if chance(0.4) else None)
        if draw < 0.85:
            return element(random.choice(["div", "section"]), 1, inner, "content")
        return inner

    for _ in range(n):
        before = [boilerplate(k) for k in ("notice", "header", "nav", "ad") if chance(0.55)]
        after = [boilerplate(k) for k in ("social", "aside", "comments", "form", "ad", "notice") if chance(0.35)]
        after += [boilerplate("footer")] if chance(0.8) else []
        inner = "".join([*before, content(), *after])
        if chance(0.35):
            inner = f"<div{' class=wrapper' if chance(0.5) else ''} data-label=2>{inner}</div>"
        head = f"<head data-label=0><title>{words(1, 8)}</title><style>p{{}}</style><script>var a</script></head>"
        yield f"<html data-label=2>{head}<body data-label=2>{inner}<script data-label=0>x()</script></body></html>"


@lru_cache(maxsize=1)
def usual_model() -> TreeModel:
    """The model of :func:`labelled_pages`, trained once per process."""
    return TreeModel(labelled_pages())


def extract(pages: DataFrame, model: TreeModel | None = None, html_col: str = "html", name: str = "main_text") -> DataFrame:
    """``pages`` with ``name``: the main text of each page, empty if there is none or the page is null or empty.

    White space inside a block is one space, blocks are joined by a line feed in
    page order, character references are decoded, broken markup is read as far as it makes
    sense.  Whole pages are read; scripts, styles, forms' values and comments of the
    markup are never text.  ``model`` is by default trained on :func:`labelled_pages`.  Pages are read
    where they lie, in batches of a bounded number; nothing is shuffled.  ``name`` must be a new column.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or usual_model())
    values = lambda texts: [[shared.value.main_text(t) for t in texts]]
    return with_columns(pages, html_col, {name: T.StringType()}, values, rows=500)
