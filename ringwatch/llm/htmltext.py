"""Main text of web pages: boosted trees over DOM nodes, decoded along the hierarchy.

The model scores every block node by itself. Decoding then chooses the most likely
set of kept nodes among those without contradiction: below a dropped node nothing
is kept, and a kept node's ancestors are kept.
"""

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm import dom, trees

#: Labelled pages that the model is fitted on. They are made by ``training_page``.
TRAIN_PAGES = 1200
SEED = 7
#: Characters of the pages that are scored together.
GROUP_CHARS = 1 << 20
#: Log-odds beyond this say nothing more.
SURE = 8.0


class _Writer:
    """Random labelled pages: a content part among parts that are not content."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)
        letters = self.random.choice(["etaoinshrdlu", "enisratdhulcgmäöü", "esaitnrulodéèêç", "eaosrnidlctñóíá"])
        self.vocabulary = [
            "".join(self.random.choices(letters, k=self.random.randint(2, 11))) for _ in range(120)
        ]

    def words(self, least: int, most: int, stops: bool = True) -> str:
        chosen = self.random.choices(self.vocabulary, k=self.random.randint(least, most))
        odd = self.random.random()
        if odd < 0.04:
            chosen = [w + self.random.choice(["***", "&amp;&amp;", "$$", "!!", "..."]) for w in chosen]
        elif odd < 0.07:
            chosen = [self.random.choice("xyz")] * len(chosen)
        if stops:
            chosen = [w + self.random.choices(["", ",", "."], [9, 1, 1])[0] for w in chosen]
            chosen[0] = chosen[0].capitalize()
        return " ".join(chosen) + ("." if stops else "")

    def link(self) -> str:
        text = self.words(1, 3, False)
        return f'<a href="/{text.split()[0]}">{text}</a>'

    def element(self, tag: str, inner: str, label: int, names: list[str] | None = None) -> str:
        """``names``: one of them becomes the class or id, sometimes none does."""
        attribute = ""
        if names and self.random.random() < 0.85:
            attribute = f' {self.random.choice(["class", "id"])}="{self.random.choice(names)}"'
        return f'<{tag}{attribute} {dom.LABEL}="{label}">{inner}</{tag}>'

    def items(self, least: int, most: int, label: int) -> str:
        rows = [self.element("li", self.link(), label) for _ in range(self.random.randint(least, most))]
        return self.element("ul", "".join(rows), label)

    def menu(self) -> str:
        names = ["nav", "menu", "navbar", "breadcrumb", "main-nav", "site-navigation"]
        if self.random.random() < 0.6:
            return self.element("nav", self.items(2, 9, 0), 0, ["nav", "menu"])
        return self.element("div", self.items(2, 9, 0), 0, names)

    def header(self) -> str:
        inner = self.words(1, 6) if self.random.random() < 0.5 else self.element("h1", self.words(1, 5, False), 0)
        if self.random.random() < 0.4:
            inner += self.menu()
        tag = self.random.choice(["header", "header", "div"])
        return self.element(tag, inner, 0, ["header", "site-header", "banner", "masthead", "top"])

    def footer(self) -> str:
        inner = f"&copy; www.{self.random.choice(self.vocabulary)}.example &middot; {self.words(2, 14)}"
        if self.random.random() < 0.3:
            inner = self.element("p", inner, 0) + self.items(1, 5, 0)
        tag = self.random.choice(["footer", "footer", "div"])
        return self.element(tag, inner, 0, ["footer", "site-footer", "copyright", "bottom"])

    def advert(self) -> str:
        inner = self.words(3, 25)
        if self.random.random() < 0.3:
            inner = self.element("p", inner, 0)
        return "<!-- ad -->" + self.element("div", inner, 0, ["ad", "ads", "advert", "sponsored", "promo", "ad-box"])

    def side(self) -> str:
        inner = self.element("h3", self.words(1, 4, False), 0)
        inner += self.items(2, 6, 0) if self.random.random() < 0.6 else self.element("p", self.words(4, 40), 0)
        tag = self.random.choice(["aside", "div", "section"])
        return self.element(tag, inner, 0, ["sidebar", "related", "widget", "recommended", "share", "tags"])

    def notice(self) -> str:
        inner = self.words(4, 30)
        if self.random.random() < 0.6:
            inner = self.element("p", inner, 0) + self.element("button", self.words(1, 2, False), 0)
        return self.element("div", inner, 0, ["notice", "cookie-banner", "consent", "alert", "newsletter", "popup"])

    def form(self) -> str:
        inner = f'<label>{self.words(1, 4, False)}</label><input name="q">'
        inner += self.element("button", self.words(1, 2, False), 0)
        return self.element("form", inner, 0, ["search", "login", "signup", "contact"])

    def comments(self) -> str:
        rows = "".join(
            self.element(
                self.random.choice(["div", "li", "article"]),
                self.element("p", self.words(3, 50), 0), 0, ["comment", "reply", "comment-body"],
            )
            for _ in range(self.random.randint(1, 5))
        )
        inner = self.element("h2", self.words(1, 3, False), 0) + rows
        if self.random.random() < 0.4:
            inner += self.form()
        tag = self.random.choice(["section", "div"])
        return self.element(tag, inner, 0, ["comments", "discussion", "responses", "comment-list"])

    def paragraph(self) -> str:
        text = self.words(1, self.random.choice([4, 15, 60, 120]))
        if self.random.random() < 0.2:
            text = text.replace(" ", f" {self.link()} ", 1)
        if self.random.random() < 0.2:
            return f'<p {dom.LABEL}="1"><b>{text}<br>'
        return self.element("p", text, 1)

    def list_(self) -> str:
        rows = [self.element("li", self.words(2, 15), 1) for _ in range(self.random.randint(1, 5))]
        return self.element(self.random.choice(["ul", "ol"]), "".join(rows), 1)

    def references(self) -> str:
        """A heading and a list of which most words are links: content all the same."""
        def row():
            link = f'<a href="/{self.random.choice(self.vocabulary)}">{self.words(2, 9, False)}</a>'
            return self.element("li", f"{link} {self.words(1, 5)}" if self.random.random() < 0.5 else link, 1)

        rows = "".join(row() for _ in range(self.random.randint(2, 8)))
        head = self.element(self.random.choice(["h2", "h3"]), self.words(1, 3, False), 1)
        return head + self.element(self.random.choice(["ol", "ul"]), rows, 1, ["references", "sources", "notes", "links", "list"])

    def figure(self) -> str:
        return self.element("figure", f'<img src="/i.png">{self.element("figcaption", self.words(2, 15), 1)}', 1)

    def wrapped(self, inner: str) -> str:
        """Inside up to three elements without a name."""
        for _ in range(self.random.choice([0, 0, 1, 1, 2, 3])):
            inner = self.element(self.random.choice(["div", "div", "section"]), inner, 1)
        return inner

    def parts(self, most: int = 12) -> list[str]:
        parts = []
        for _ in range(self.random.choice([n for n in (1, 1, 2, 3, 5, 8, 12) if n <= most])):
            kind = self.random.random()
            if kind < 0.78:
                parts.append(self.paragraph())
            elif kind < 0.84:
                parts.append(self.element("h2", self.words(1, 8, False), 1))
            elif kind < 0.88:
                parts.append(self.list_())
            elif kind < 0.91:
                parts.append(self.element("blockquote", self.element("p", self.words(4, 30), 1), 1))
            elif kind < 0.93:
                cells = "".join(self.element("td", self.words(1, 5), 1) for _ in range(3))
                parts.append(self.element("table", self.element("tr", cells, 1), 1))
            elif kind < 0.94:
                parts.append(self.figure())
            elif kind < 0.96:
                parts.append(self.references())
            else:
                parts.append(self.random.choice([self.advert, self.side, self.notice])())
        return parts

    # Layouts of the article

    def named(self) -> str:
        """One element that often says what it is."""
        parts = [self.element("h1", self.words(1, 12), 1)] if self.random.random() < 0.8 else []
        inner = "".join(parts + self.parts())
        kind = self.random.random()
        if kind < 0.45:
            return self.element("article", inner, 1, ["post", "article", "entry"])
        if kind < 0.6:
            return self.element("main", inner, 1, ["content", "main"])
        if kind < 0.95:
            return self.element("div", inner, 1, ["content", "post-body", "entry-content", "article", "story", "text"])
        return inner

    def bare(self) -> str:
        """Paragraphs in nested elements without any name."""
        head = self.element("h1", self.words(1, 12), 1) if self.random.random() < 0.4 else ""
        return self.wrapped(head + self.wrapped("".join(self.parts())))

    def headed(self) -> str:
        """A header of the article itself, with its title and often a line on who wrote it."""
        head = self.element("h1", self.words(1, 12), 1)
        if self.random.random() < 0.6:
            head += self.element("p", self.words(2, 12), 1, ["byline", "meta", "lead", "subtitle"])
        inner = self.element("header", head, 1, ["entry-header", "article-header"]) + "".join(self.parts())
        return self.element(self.random.choice(["article", "article", "main"]), inner, 1, ["post", "article", "entry"])

    def sections(self) -> str:
        """Sections of headings and paragraphs, with a list of links at the end."""
        rows = [
            self.element("section", self.element("h2", self.words(1, 6, False), 1) + self.wrapped("".join(self.parts(3))), 1, ["section", "chapter"])
            for _ in range(self.random.randint(1, 5))
        ]
        inner = self.element("h1", self.words(1, 9), 1) + "".join(rows) + (self.references() if self.random.random() < 0.7 else "")
        return self.element(self.random.choice(["article", "main", "div"]), inner, 1, ["content", "article", "document"])

    def lines(self) -> str:
        """Text straight in one element, its paragraphs parted by line breaks."""
        texts = [self.words(3, self.random.choice([10, 40, 90])) for _ in range(self.random.randint(1, 6))]
        return self.wrapped(self.element("div", "<br><br>".join(texts), 1, ["content", "text", "post", "message"]))

    def columns(self) -> str:
        """A table that lays out the page: a menu in one cell, the article in another, perhaps a side column."""
        links = " ".join(self.link() for _ in range(self.random.randint(2, 8)))
        cells = [self.element("td", links if self.random.random() < 0.5 else self.items(2, 8, 0), 0)]
        cells.append(self.element("td", self.element("h1", self.words(1, 9), 1) + "".join(self.parts()), 1))
        if self.random.random() < 0.4:
            cells.append(self.element("td", self.side() + self.advert(), 0))
        return self.element("table", self.element("tr", "".join(cells), 1), 1)

    LAYOUTS = ("named", "bare", "headed", "sections", "lines", "columns")

    def long_chrome(self) -> str:
        """Parts that are not content but as long as an article."""
        texts = "".join(self.element("p", self.words(20, 90), 0) for _ in range(self.random.randint(1, 4)))
        return self.random.choice([
            lambda: self.element("footer", texts, 0, ["footer", "legal", "site-footer"]),
            lambda: self.element("div", texts, 0, ["cookie-banner", "consent", "disclaimer notice"]),
            lambda: self.element("aside", texts, 0, ["sidebar", "related"]),
            lambda: self.element("div", texts, 0, ["sponsored", "advert", "promo"]),
        ])()

    def page(self, layout: str | None = None) -> str:
        before = [self.menu, self.header, self.advert, self.notice, self.form, self.side]
        after = [self.footer, self.comments, self.side, self.advert, self.form, self.notice, self.menu, self.long_chrome]
        layout = layout or self.random.choice(self.LAYOUTS)
        parts = [f() for f in self.random.sample(before, self.random.randint(0, 4))]
        parts.append(getattr(self, layout)())
        parts += [f() for f in self.random.sample(after, self.random.randint(0, 4))]
        body = "".join(parts)
        if self.random.random() < 0.4:
            body = self.element("div", body, 1, ["page", "wrapper", "container", "site"])
        head = "<head><title>t</title><style>p{}</style><script>var t='</p>';</script></head>"
        end = "" if self.random.random() < 0.1 else "</body></html>"
        return f'<!DOCTYPE html><html {dom.LABEL}="1">{head}<body {dom.LABEL}="1">{body}{end}'


def training_page(seed: int, layouts: tuple[str, ...] = _Writer.LAYOUTS) -> str:
    """A labelled page; ``layouts`` leaves out what is held out. Half of them are the plainest, the rest shared."""
    writer = _Writer(seed)
    return writer.page(layouts[0] if writer.random.random() < 0.4 else writer.random.choice(layouts))


@lru_cache(maxsize=8)
def train(pages: int = TRAIN_PAGES, seed: int = SEED, layouts: tuple[str, ...] = _Writer.LAYOUTS) -> trees.Boosted:
    """Boosted trees over the nodes of ``pages`` labelled pages; a node weighs more with its text."""
    rows, labels = [], []
    for i in range(pages):
        nodes = dom.parse(training_page(seed * 1_000_003 + i, layouts))
        table = dom.features([nodes])
        known = [j for j, node in enumerate(nodes) if node.label is not None]
        rows.append(table[known])
        labels += [int(nodes[j].label) for j in known]
    x = np.concatenate(rows)
    return trees.fit(x, np.array(labels, dtype=float), _weights(x), trees=40, depth=5)


def _weights(x: np.ndarray) -> np.ndarray:
    return 1 + x[:, dom.NAMES.index("log_text")] / 4


def decode(nodes: list[dom.Node], log_odds: np.ndarray, weight: np.ndarray) -> list[bool]:
    """The most likely kept nodes of which no one lies below a dropped one; the root is kept."""
    log_odds = np.clip(log_odds, -SURE, SURE)
    yes, no = -np.log1p(np.exp(-log_odds)) * weight, -np.log1p(np.exp(log_odds)) * weight
    drop, keep = no.tolist(), yes.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent.order
        drop[up] += drop[i]
        keep[up] += max(keep[i], drop[i])
    kept = [True] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        kept[i] = kept[node.parent.order] and not node.silent and keep[i] >= drop[i]
    return kept


def extract(pages: list[str | None], model: trees.Boosted) -> list[str]:
    """Main text per page: the kept blocks in page order, joined as their white space is, by one space."""
    parsed = [dom.parse(page) for page in pages]
    if not parsed:
        return []
    table = dom.features(parsed)
    log_odds, weight = model.log_odds(table), _weights(table)
    texts, at = [], 0
    for nodes in parsed:
        span = slice(at, at + len(nodes))
        at += len(nodes)
        kept = decode(nodes, log_odds[span], weight[span])
        blocks = [block for node, keep in zip(nodes, kept) if keep for block in dom.own_blocks(node)]
        texts.append(" ".join(text for _, text in sorted(blocks)))
    return texts


def _groups(pages: pd.Series) -> Iterator[list[str | None]]:
    """Neighbouring pages that are parsed together: few enough to be held as trees."""
    group, size = [], 0
    for page in pages:
        group.append(page)
        size += len(page or "")
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    yield group


def main_text(html: Column, model: trees.Boosted | None = None) -> Column:
    """Column of main texts: never null, empty for null or empty pages and pages without content.

    The model is a few kilobytes of arrays and travels with the function.
    """
    model = model or train()

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            found = [text for group in _groups(pages) for text in extract(group, model)]
            yield pd.Series(found, dtype=object)

    return texts(html.cast("string"))


def extract_pages(pages: DataFrame, html: str = "html", model: trees.Boosted | None = None) -> DataFrame:
    """``pages`` with columns ``text`` and ``n_chars`` (code points) in place of any of that name.

    Each page is one row of its own: repeated rows give equal texts, an empty table an
    empty result. Whole pages are read, a bounded group of them at a time.
    """
    others = [f"`{c}`" for c in pages.columns if c.lower() not in ("text", "n_chars")]
    found = pages.select(*others, main_text(F.col(html), model).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
