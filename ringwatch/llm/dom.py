"""A small DOM of block elements, and features of its nodes."""

import re
from html.parser import HTMLParser

import numpy as np

# Fixed values of HTML: elements that stand inside a line, that never have content,
# whose content is no text, and the open elements that a start tag closes.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter "
    "output picture progress q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr "
    "math mi mo mn mrow msup msub msubsup mfrac msqrt mroot mtext ms mspace mstyle munder mover munderover mpadded "
    "mphantom menclose mtable mtr mtd semantics merror".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("template head title iframe".split())
# Elements inside a line whose content is no text of the page.
HUSHED = frozenset("script style svg annotation annotation-xml".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)

_TOKEN = re.compile(r"[a-z]+")
#: Attribute that carries the label of a node on training pages; no feature reads it.
LABEL = "data-label"


class Node:
    """A block element. ``runs`` holds its own text as (text, inside a link, number of the block)."""

    __slots__ = ("tag", "tokens", "parent", "children", "depth", "runs", "order", "silent", "label")

    def __init__(self, tag, tokens, parent, order, label=None):
        self.tag, self.tokens, self.parent, self.order, self.label = tag, tokens, parent, order, label
        self.children, self.runs = [], []
        self.depth = parent.depth + 1 if parent else 0
        self.silent = tag in SILENT or (parent is not None and parent.silent)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", (), None, 0)
        self.nodes, self.open, self.links, self.block = [self.root], [self.root], 0, 0
        # Per tag the places in ``open`` of its elements, so that a look for one takes no walk.
        self.places: dict[str, list[int]] = {}
        self.hush: list[str] = []

    def _innermost(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _close(self, tags, stop=()):
        """Leave the innermost open element among ``tags``, unless one of ``stop`` lies inside it."""
        place = self._innermost(tags)
        if place and (not stop or place > self._innermost(stop)):
            for node in self.open[place:]:
                self.places[node.tag].pop()
            del self.open[place:]

    def handle_starttag(self, tag, attrs):
        if self.hush:
            # A block element inside a drawing ends it, as in browsers.
            if self.hush[-1] != "svg" or tag not in ENDS_PARAGRAPH:
                if tag in self.hush:
                    self.hush.append(tag)
                return
            self.hush.clear()
        if tag in HUSHED:
            self.hush.append(tag)
            return
        if tag == "a":
            self.links += 1
        if tag in INLINE:
            if tag == "br":
                self.open[-1].runs.append((" ", False, self.block))
            return
        self.block += 1
        if tag in ENDS_PARAGRAPH:
            self._close({"head"})
            self._close({"p"}, {"table", "td", "th", "button"})
        if tag in CLOSED_BY:
            self._close(CLOSED_BY[tag], {"ul", "ol", "dl", "table"} - CLOSED_BY[tag])
        tokens, label, parent = (), None, self.open[-1]
        if attrs:
            known = {k: v or "" for k, v in attrs}
            words = " ".join(known.get(k, "") for k in ("class", "id", "role", "itemprop", "aria-label"))
            tokens, label = tuple(_TOKEN.findall(words.lower())), known.get(LABEL)
        node = Node(tag, tokens, parent, len(self.nodes), label)
        parent.children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)
            self.links = 0

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.hush:
            if tag in self.hush:
                while self.hush.pop() != tag:
                    pass
            return
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag not in INLINE and tag not in HUSHED:
            self.block += 1
            self._close({tag})
            self.links = 0

    def handle_data(self, data):
        if not self.hush:
            self.open[-1].runs.append((data, self.links > 0, self.block))


def parse(html: str | None) -> list[Node]:
    """The block nodes in page order, the root first; broken markup never raises."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.nodes


def own_blocks(node: Node) -> list[tuple[int, str]]:
    """The node's own text as (number, text), cut where another block stands in between."""
    parts: dict[int, list[str]] = {}
    for text, _, block in node.runs:
        parts.setdefault(block, []).append(text)
    blocks = [(block, " ".join("".join(texts).split())) for block, texts in parts.items()]
    return [(block, text) for block, text in blocks if text]


# Attribute tokens and elements that say what a part of a page is for.
GROUPS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toolbar skip",
    "frame": "header masthead banner footer foot bottom copyright colophon topbar branding logo",
    "side": "sidebar aside widget rail related recommended popular trending more tags share social follow",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion outbrain taboola commercial",
    "notice": "notice cookie cookies consent gdpr alert modal popup overlay newsletter subscribe signup paywall",
    "comment": "comment comments reply replies respond discussion disqus thread reader readers",
    "form": "form search login signin register input field captcha",
    "main": "article content main body post entry story text page blog news",
}
TAGS = (
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure "
    "figcaption nav header footer aside form button select option textarea fieldset body html"
).split()
NAMES = [
    "text", "log_text", "link_share", "words", "punctuation", "depth", "children", "position", "siblings",
    "like_siblings", "subtree_nodes", "density", "subtree_log_text", "subtree_link_share", "text_of_page",
    "tokens", *[f"own_{g}" for g in GROUPS], *[f"above_{g}" for g in GROUPS], *[f"tag_{t}" for t in TAGS],
    *[f"in_{t}" for t in ("nav", "header", "footer", "aside", "form", "article", "main", "li", "table")],
    "parent_same_tag", "before_text", "after_text",
]
_GROUP = {word: i for i, words in enumerate(GROUPS.values()) for word in words.split()}
_TAG = {t: i for i, t in enumerate(TAGS)}
_ABOVE = {t: i for i, t in enumerate(("nav", "header", "footer", "aside", "form", "article", "main", "li", "table"))}


def _run_sizes(node: Node) -> tuple[int, int, int, int]:
    """Characters, those in links, words and punctuation marks of the node's own text."""
    size = linked = words = marks = 0
    if not node.silent:
        for run, link, _ in node.runs:
            gaps = run.count(" ")
            n = len(run) - gaps
            if n:
                size += n
                words += gaps + 1
                marks += run.count(".") + run.count(",") + run.count("?") + run.count("!")
                if link:
                    linked += n
    return size, linked, words, marks


def features(pages: list[list[Node]]) -> np.ndarray:
    """One row per node of all pages: text and links of it and its subtree, tokens, depth, siblings.

    Sets of groups and of elements are bit masks, handed down from parent to child.
    """
    rows, first = [], 0
    up, root, own, above, inside, tag = [], [], [], [], [], []
    for nodes in pages:
        for node in nodes:
            mask = 0
            for token in node.tokens:
                if token in _GROUP:
                    mask |= 1 << _GROUP[token]
            within = 1 << _ABOVE[node.tag] if node.tag in _ABOVE else 0
            parent = node.parent
            own.append(mask)
            root.append(first)
            tag.append(_TAG.get(node.tag, -1))
            if parent:
                at = first + parent.order
                up.append(at)
                above.append(mask | above[at])
                inside.append(within | inside[at])
            else:
                up.append(-1)
                above.append(mask)
                inside.append(within)
            rows.append((*_run_sizes(node), node.depth, len(node.children), len(node.tokens),
                         parent is not None and parent.tag == node.tag))
        first += len(nodes)
    table = np.array(rows, dtype=float).reshape(-1, 8)
    text, link, words, marks, depth, kids, tokens, same_parent = table.T
    all_text, all_link, all_nodes = text.tolist(), link.tolist(), [1] * len(rows)
    for i in range(len(rows) - 1, -1, -1):
        at = up[i]
        if at >= 0:
            all_text[at] += all_text[i]
            all_link[at] += all_link[i]
            all_nodes[at] += all_nodes[i]
    place, brothers, alike = [0.0] * len(rows), [0] * len(rows), [0] * len(rows)
    before, after, first = [0.0] * len(rows), [0.0] * len(rows), 0
    for nodes in pages:
        for node in nodes:
            children = node.children
            if not children:
                continue
            same: dict[str, int] = {}
            for child in children:
                same[child.tag] = same.get(child.tag, 0) + 1
            last = -1
            for j, child in enumerate(children):
                i = first + child.order
                place[i], brothers[i], alike[i] = j / len(children), len(children), same[child.tag]
                if last >= 0:
                    before[i], after[last] = all_text[last], all_text[i]
                last = i
        first += len(nodes)
    all_text, all_link, all_nodes = map(np.array, (all_text, all_link, all_nodes))
    page = np.maximum(all_text[root], 1)

    def bits(masks, n):
        return (np.array(masks, dtype=np.int64)[:, None] >> np.arange(n)) & 1

    tags = np.array(tag)[:, None] == np.arange(len(TAGS))
    return np.column_stack([
        np.minimum(text, 2000), np.log1p(text), link / np.maximum(text, 1), np.minimum(words, 500),
        np.minimum(marks / np.maximum(words, 1), 1), depth, np.minimum(kids, 50), place,
        np.minimum(brothers, 50), np.minimum(alike, 50), np.log1p(all_nodes), np.log1p(all_text / all_nodes),
        np.log1p(all_text), all_link / np.maximum(all_text, 1), all_text / page, tokens,
        bits(own, len(GROUPS)), bits(above, len(GROUPS)), tags, bits(inside, len(_ABOVE)),
        same_parent, np.log1p(before), np.log1p(after),
    ])
