"""The block elements of a web page as a tree, with the text that each holds directly."""

import re
from html.parser import HTMLParser

# Elements of HTML that are blocks, that have no end, that end one another, and whose content is not text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript object ol optgroup option p pre"
    " script search section select style summary svg table tbody td template textarea tfoot th thead title tr ul video audio".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style template noscript iframe svg object select textarea head title button video audio".split())
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SIBLINGS = {k: frozenset(v.split()) for k, v in SIBLINGS.items()}
LISTS = frozenset("ul ol menu dl table tbody thead tfoot select".split())
_SPACES = re.compile(r"\s+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def names_in(value: str) -> list[str]:
    """The words of an attribute's names in lower case: userComments, cmt-thread and nav_2 have two, two and one."""
    return [word.lower() for word in _WORDS.findall(value)]


class Node:
    """A block element: ``text`` are its own pieces as (place in the page, text), without those of blocks inside it."""

    __slots__ = ("parent", "tag", "names", "text", "linked", "label")

    def __init__(self, parent: int, tag: str, names: list[str], label: int | None):
        self.parent, self.tag, self.names, self.label = parent, tag, names, label
        self.text, self.linked = [], 0


class PageTree(HTMLParser):
    """Parses a page; ``nodes`` are in page order, parents before children, the root first.

    Inline elements belong to the block around them.  Missing end tags are supplied as
    a browser would: a paragraph ends where a block begins, a list item where the
    next begins.  End tags without a beginning are left out.
    """

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.nodes, self.stack, self.open, self.links, self.place = [Node(-1, "root", [], None)], [0], {}, 0, 0
        self.feed(page)
        self.close()

    def _end(self, depth: int) -> None:
        for i in self.stack[depth:]:
            self.open[self.nodes[i].tag] -= 1
        del self.stack[depth:]
        self.links, self.place = 0, self.place + 1

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links = 1
        if tag == "br" and self.nodes[self.stack[-1]].text:
            self._add(" ")
        if tag not in BLOCKS:
            return
        if self.open.get("p") and self.nodes[self.stack[-1]].tag == "p":
            self._end(len(self.stack) - 1)
        for depth in range(len(self.stack) - 1, 0, -1):
            above = self.nodes[self.stack[depth]].tag
            if above in SIBLINGS.get(tag, ()):
                self._end(depth)
                break
            if above in LISTS or tag not in SIBLINGS:
                break
        names = [n for key, value in attrs if key in ("class", "id", "role") and value for n in names_in(value)]
        label = next((int(value) for key, value in attrs if key == "data-label"), None)
        self.nodes.append(Node(self.stack[-1], tag, names, label))
        if tag not in VOID:
            self.stack.append(len(self.nodes) - 1)
            self.open[tag] = self.open.get(tag, 0) + 1
        self.links, self.place = 0, self.place + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "a":
            self.links = 0
        if self.open.get(tag):
            depth = len(self.stack) - 1
            while self.nodes[self.stack[depth]].tag != tag:
                depth -= 1
            self._end(depth)

    def handle_data(self, data):
        self._add(data)

    def _add(self, data: str) -> None:
        node = self.nodes[self.stack[-1]]
        # Text after an inner block is a block of its own: it is kept with its place, the number of block edges before it.
        if node.text and node.text[-1][0] == self.place:
            node.text[-1][1].append(data)
        else:
            node.text.append((self.place, [data]))
        if self.links:
            node.linked += len(data)

    def blocks(self, node: Node) -> list[tuple[int, str]]:
        """(place, text) of the node's own blocks, white space reduced; empty ones are left out."""
        if node.tag in NO_TEXT:
            return []
        found = ((place, _SPACES.sub(" ", "".join(parts)).strip()) for place, parts in node.text)
        return [(place, text) for place, text in found if text]
