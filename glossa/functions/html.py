"""HTML to paragraphs and metadata, on the standard library's parser, as Arrow functions.

Two container profiles: ``news_site`` has the containers and the direct-text rule of the news
templates; ``generic`` takes the paragraphs of every article element.  Trees are built leniently:
an unclosed element ends with its parent, void elements have no content, and a paragraph does not
end at the next one unless its end tag says so.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from glossa.functions.text import BOILERPLATE, IMAGE_MARKS, SCRAPE_BOILERPLATE, with_field

#: Rows that are held as Python objects at a time.
ROWS = 64
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags in their plainest spelling, which need no further look; elements whose content the parser reads in its own way are left to it.
_PLAIN_TAG = re.compile(r'<(?!(?:script|style|textarea|title|iframe|xmp|no[a-z]+|plaintext)[ >])([a-z][a-z0-9]*)((?: [a-z][a-z-]*="[^"&<>\0]*")*)>')
_PLAIN_ATTRIBUTE = re.compile(r' ([a-z-]+)="([^"]*)"')
_IMAGE = re.compile("|".join(map(re.escape, IMAGE_MARKS)))


class Node:
    """An element: children are nodes or plain texts; comments are left out."""

    __slots__ = ("attributes", "children", "name", "parent")

    def __init__(self, name: str, attributes: dict[str, str], parent: Node | None):
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def texts(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            else:
                stack.extend(reversed(x.children))

    def text(self) -> str:
        return "".join(self.texts())

    def stripped(self) -> str:
        return "".join(t.strip() for t in self.texts())

    def has_class(self, name: str) -> bool:
        return name in self.attributes.get("class", "").split()

    def find_all(self, name: str | None = None, css: str | None = None, ident: str | None = None) -> list[Node]:
        return [n for n in self.walk() if (name is None or n.name == name) and (css is None or n.has_class(css)) and (ident is None or n.attributes.get("id") == ident)]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.open: Counter[str] = Counter()

    def parse_starttag(self, i: int) -> int:
        plain = _PLAIN_TAG.match(self.rawdata, i)
        if plain is None:
            return super().parse_starttag(i)
        self.handle_starttag(plain[1], _PLAIN_ATTRIBUTE.findall(plain[2]))
        return plain.end()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        while self.open[tag]:  # what it leaves is closed for good, so all end tags together take linear time
            left, self.at = self.at, self.at.parent
            self.open[left.name] -= 1
            if left.name == tag:
                break

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def tree(page: str) -> Node:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.root


def valid(text: str) -> bool:
    flat = " ".join(text.split())
    return bool(flat) and not flat.startswith(BOILERPLATE)


def direct_texts(node: Node) -> list[str]:
    """The element's own text, cut at line-break elements; what nested elements hold is left out."""
    out, run = [], []
    for child in node.children:
        if isinstance(child, str):
            run.append(child.replace("\n", ""))
        elif child.name == "br":
            out.append("".join(run))
            run = []
    return [t.strip() for t in [*out, "".join(run)]]


def news_paragraphs(root: Node, iso: str | None) -> list[str]:
    """Paragraphs of a news page: introductions, article bodies (datelines unfiltered), newer article bodies."""
    found: list[str] = []
    for intro in root.find_all("div", css="intro"):
        found += [t.strip() for p in intro.find_all("p") for t in p.text().split("\n") if valid(t)]
    for body in root.find_all("div", ident="article-content"):
        for comments in body.find_all(css="comments")[:1]:
            comments.parent.children.remove(comments)
        found += [d.stripped() for d in body.find_all("span", css="dateline")[:1]]
        paragraphs = body.find_all("p")
        if iso == "sna":
            found += [t for p in paragraphs if valid(t := p.stripped().replace("\n", " "))]
        else:
            found += [t for p in paragraphs or body.find_all("div", css="wsw") for t in direct_texts(p) if valid(t)]
    for body in root.find_all("div", css="article__content"):
        found += [t for p in body.find_all("p") for t in direct_texts(p) if valid(t)]
    return [_IMAGE.sub("", t) for t in found]


def generic_paragraphs(root: Node, iso: str | None = None) -> list[str]:
    """Headings and paragraphs of article elements, nested markup included; a paragraph inside another is its own."""
    found: list[str] = []
    for article in root.find_all("article"):
        for node in article.walk():
            if node.name in ("p", "h1", "h2", "h3", "li"):
                run = [c if isinstance(c, str) else "\n" if c.name == "br" else "" if c.name == "p" else _inline(c) for c in node.children]
                found += [" ".join(t.split()) for t in "".join(run).split("\n") if valid(t)]
    return [_IMAGE.sub("", t) for t in found]


def _inline(node: Node) -> str:
    """Text of inline markup, without the paragraphs that hang below an unclosed one."""
    out: list[str] = []
    stack: list[Node | str] = list(reversed(node.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.name == "br":
            out.append("\n")
        elif x.name != "p":
            stack.extend(reversed(x.children))
    return "".join(out)


PROFILES = {"news_site": news_paragraphs, "generic": generic_paragraphs}


def metadata(root: Node) -> dict:
    """What is kept of a page when it is scraped."""
    of: dict[str, list[Node]] = {"meta": [], "link": [], "title": [], "p": []}
    for n in root.walk():
        if n.name in of:
            of[n.name].append(n)
    metas = {}
    for m in of["meta"]:
        metas.setdefault(m.attributes.get("name") or m.attributes.get("property"), m.attributes.get("content"))
    links = [n.attributes.get("href") for n in of["link"] if n.attributes.get("rel") == "canonical"]
    titles = of["title"]
    split = lambda x: [t.strip() for t in x.split(",")] if x else None
    return {
        "title": metas.get("title") or (titles[0].text() if titles else None),
        "description": metas.get("description"),
        "canonical_link": links[0] if links else None,
        "keywords": split(metas.get("keywords")),
        "authors": [m.attributes.get("content", "") for m in of["meta"] if m.attributes.get("name") == "Author"] or None,
        "has_ptags": any((t := p.text().strip()) and not t.startswith(SCRAPE_BOILERPLATE) for p in of["p"]),
    }


def with_paragraphs(pages: DataFrame, *, html: str = "html", iso: str | None = None, profile: str = "generic") -> DataFrame:
    """The pages with ``paragraphs``."""
    extract = PROFILES[profile]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            isos = batch.column(iso).to_pylist() if iso else [None] * batch.num_rows
            rows = [extract(tree(x), i) if x is not None else None for x, i in zip(batch.column(html).to_pylist(), isos, strict=True)]
            yield batch.append_column("paragraphs", pa.array(rows, pa.list_(pa.string())))

    return pages.mapInArrow(run, with_field(pages.schema, "paragraphs array<string>"))


def with_metadata(pages: DataFrame, *, html: str = "html") -> DataFrame:
    """The pages with ``meta``, a struct of title, description, canonical_link, keywords, authors and has_ptags."""
    kind = pa.struct([("title", pa.string()), ("description", pa.string()), ("canonical_link", pa.string()), ("keywords", pa.list_(pa.string())), ("authors", pa.list_(pa.string())), ("has_ptags", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            rows = [metadata(tree(x)) if x is not None else None for x in batch.column(html).to_pylist()]
            yield batch.append_column("meta", pa.array(rows, kind))

    return pages.mapInArrow(run, with_field(pages.schema, "meta struct<title:string,description:string,canonical_link:string,keywords:array<string>,authors:array<string>,has_ptags:boolean>"))


def last_link_of_class(page: Column, name: str) -> Column:
    """The target of the last link of a class, whatever its quotes; null where there is none."""

    @arrow_udf(StringType())
    def run(pages: pa.Array) -> pa.Array:
        found = [[n.attributes.get("href") for n in tree(p).find_all("a", css=name)] if p is not None and name in p else [] for p in pages.to_pylist()]
        return pa.array([links[-1] if links else None for links in found], pa.string())

    return run(page)
