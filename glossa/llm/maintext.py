"""Main text of web pages: the maximum-scoring run of words and tags.

A page becomes a sequence of text runs and tags.  What stands in elements that are no text (scripts,
forms, menus, and those whose class, id or role names them as adverts, notices, comments and the
like) takes no part.  Of the rest each word scores by the element that it stands in (positive where
labelled pages have their main text) and by the word itself; each tag scores negative, the more so
if labelled pages have it outside their main text.  A linear scan finds the contiguous region with
the largest sum; its text is the page's main text.

Weights come from labelled pages: pages that mark their main text with an ``article`` or ``main``
element.  The mark is only read as a label, never to extract.  All labelled pages are counted (one
pass, a bounded number of counters per task, summed by a grouped aggregation); the weights are log
odds.  Then each page is scored where it is read, in time linear in its length.

Defined cases: a null or empty page has the empty text; malformed markup is read as browsers do
(unclosed elements end with their parents, an unclosed comment runs to the end); a page without any
positive word has the empty text; repeated rows are each read; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import slices

#: Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var img button".split())
CLOSES_P = BLOCKS - frozenset("br body html head option select tbody td tfoot th thead tr".split())
DROPPED = frozenset("nav aside footer form script style noscript template iframe noembed noframes head title textarea select button svg canvas object audio video dialog menu".split())
MAIN = ("article", "main")
#: Words in class, id and role names that mark boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adbox adslot adunit adsense sponsor sponsored sponsors promo promos promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars rail widget widgets related recommended recommendations footer header masthead topbar "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall share sharing social "
    "comment comments disqus respond reply replies toolbar pagination pager complementary contentinfo search form".split()
)
#: Parts of such names that say nothing by themselves.
NEUTRAL = frozenset(
    "box wrap wrapper container content contents block bar list lists item items area inner outer section top bottom left right main site page global "
    "primary secondary mobile desktop fixed sticky header footer button buttons link links post posts article articles stories slot unit text row col "
    "column panel module component group card js user reader readers form field x bg el id the my "
    "news entry blog story topics topic headlines coverage popular label placeholder title heading icon image img inline floating".split()
)
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
NEGATED = frozenset("has with no without is not".split())
WHOLE = frozenset(("html", "body", "main"))
SECTIONS = frozenset(("article", "main", "section"))

ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]*))?""")
NAME = re.compile(r"[A-Za-z][^\s/>]*")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Bounds of the weights, the smallest cost of a tag, hash buckets of words and the prior weight of a word's own odds.
PLACE_LIMIT, TAG_LIMIT, TAG_LEAST, WORD_LIMIT = 4.0, 3.0, 0.01, 1.0
BUCKETS, PRIOR = 4096, 50.0


def named_boilerplate(name: str) -> bool:
    """Does a class, id or role name nothing but boilerplate?  One mark, and other parts that are marks, neutral or numbers."""
    parts = [p.lower() for p in PARTS.findall(name)]
    return bool(parts) and parts[0] not in NEGATED and not MARKS.isdisjoint(parts) and all(p in MARKS or p in NEUTRAL or p.isdigit() for p in parts)


def marked(tag: str, attributes: str, in_section: bool) -> bool:
    """Does the element hold boilerplate?"""
    if tag in DROPPED or tag == "header" and not in_section:
        return True
    if tag in WHOLE or not attributes or not ("class" in attributes or "id" in attributes or "role" in attributes):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for one in value.strip("\"'").split():
                if named_boilerplate(one):
                    hits = MARKS.intersection(p.lower() for p in PARTS.findall(one))
                    if tag == "article":
                        hits &= COMMENTS
                    elif in_section:
                        hits -= {"header"}
                    if hits:
                        return True
    return False


def tag_end(page: str, at: int) -> int:
    """The place after the ``>`` of the tag whose attributes begin here; quoted ones don't count."""
    size = len(page)
    close = page.find(">", at)
    if close < 0:
        return size
    quote = min((q for q in (page.find('"', at, close), page.find("'", at, close)) if q >= 0), default=-1)
    if quote < 0:
        return close + 1
    while at < size:
        c = page[at]
        if c == ">":
            return at + 1
        if c in "\"'" and page[at - 1] == "=":
            end = page.find(c, at + 1)
            if end < 0:
                return close + 1  # a stray quote
            at = end
        at += 1
    return close + 1


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", run, ""), ("open", name, attributes) and ("close", name, "")."""
    at, size = 0, len(page)
    while at < size:
        low = page.find("<", at)
        if low < 0:
            yield "text", page[at:], ""
            return
        follows = page[low + 1 : low + 2]
        if not (follows.isascii() and follows.isalpha() or follows in ("/", "!", "?") and follows):
            nxt = page.find("<", low + 1)
            nxt = size if nxt < 0 else nxt
            yield "text", page[at:nxt], ""
            at = nxt
            continue
        if low > at:
            yield "text", page[at:low], ""
        if page.startswith("<!--", low):
            end = page.find("-->", low + 2)
            at = size if end < 0 else end + 3
        elif follows in "!?":
            end = page.find(">", low)
            at = size if end < 0 else end + 1
        elif follows == "/":
            m = NAME.match(page, low + 2)
            end = page.find(">", low)
            at = size if end < 0 else end + 1
            if m:
                yield "close", m[0].lower(), ""
        else:
            m = NAME.match(page, low + 1)
            at = tag_end(page, m.end())
            name = m[0].lower()
            yield "open", name, page[m.end() : at - 1]
            if name in RAW:
                m = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                at = m.start() if m else size


class Item:
    """A run of text or a tag: the element it stands in (None in boilerplate), whether in a link and in the labelled main text, and its block."""

    __slots__ = ("block", "link", "main", "place", "tag", "text")

    def __init__(self, tag: str, text: str, place: str | None, link: bool, main: bool, block: int):
        self.tag, self.text, self.place, self.link, self.main, self.block = tag, text, place, link, main, block


class Open:
    """The elements that are open; each operation takes time in proportion to what it opens or closes."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str]] = []  # name, and the nearest block element
        self.count: Counter[str] = Counter()
        self.first: dict[str, int] = {}  # by role, the depth of the outermost element that has it

    def push(self, name: str) -> None:
        self.count[name] += 1
        self.stack.append((name, name if name in BLOCKS else self.place))

    @property
    def place(self) -> str:
        return self.stack[-1][1] if self.stack else ""

    def close(self, name: str) -> None:
        """Closes the innermost element of the name, and all in it."""
        if self.count[name]:
            while True:
                last = self.stack.pop()[0]
                self.count[last] -= 1
                if last == name:
                    break
            self.first = {role: depth for role, depth in self.first.items() if depth < len(self.stack)}

    def mark(self, role: str) -> None:
        """The next element has the role."""
        self.first.setdefault(role, len(self.stack))


def items(page: str) -> tuple[list[Item], bool]:
    """The page's items, and whether it is labelled: by articles, or else by a main element."""
    for name in MAIN:
        if re.search("<" + name, page, re.IGNORECASE):
            found, labelled = _items(page, name)
            if labelled:
                return found, True
    return _items(page, "")


def _items(page: str, label: str) -> tuple[list[Item], bool]:
    out: list[Item] = []
    open_, block, labelled = Open(), 0, False
    roles = open_.first
    for kind, name, attributes in tokens(page):
        roles = open_.first
        if kind == "text":
            out.append(Item("", name, None if "boiler" in roles else open_.place, "link" in roles, "main" in roles, block))
            continue
        block += name in BLOCKS
        if kind == "open":
            if name in CLOSES_P:
                open_.close("p")
            elif name in ("li", "dd", "dt", "option", "tr", "td", "th") and open_.stack and open_.stack[-1][0] == name:
                open_.close(name)
            single = name in VOID or attributes.endswith("/") and name not in RAW
            if not single:
                if "boiler" not in open_.first:
                    if marked(name, attributes, any(open_.count[x] for x in SECTIONS)):
                        open_.mark("boiler")
                    elif name == label:
                        labelled = True
                        open_.mark("main")
                if name == "a":
                    open_.mark("link")
                open_.push(name)
        else:
            open_.close(name)
        roles = open_.first
        if name not in SECTIONS:  # these are labels
            out.append(Item(name if name in BLOCKS or name in INLINE or name in DROPPED else "other", "", None if "boiler" in roles else "", False, "main" in roles, block))
    return out, labelled


def bucket(word: str) -> int:
    return zlib.crc32(word.lower().encode("utf-8", "replace")) % BUCKETS


def counted(pages: Iterator[str | None]) -> Counter[tuple[str, bool]]:
    """Over labelled pages, words by place and by hash bucket, and tags by name, inside and outside the main text."""
    total: Counter[tuple[str, bool]] = Counter()
    for page in pages:
        found, labelled = items(page or "")
        for x in found if labelled else ():
            if x.place is None:
                continue
            if x.tag:
                total["<" + x.tag, x.main] += 1
            else:
                words = x.text.split()
                total[f"@{x.place}{' a' * x.link}", x.main] += len(words)
                for w in words:
                    total[f"#{bucket(w)}", x.main] += 1
    return total


class Weights:
    """Log odds of standing in the main text: of places and words, mostly positive there, and of tags, always negative."""

    def __init__(self, counts: dict[tuple[str, bool], int]):
        limited = lambda x, low, high: max(low, min(high, x))
        n = lambda k, main: counts.get((k, main), 0)
        keys = sorted({k for k, _ in counts})
        odds = lambda k: math.log((n(k, True) + 1) / (n(k, False) + 1))
        total = {(link, main): sum(c for (k, m), c in counts.items() if k[0] == "@" and m == main and k.endswith(" a") == link) for link in (True, False) for main in (True, False)}
        plain = math.log((total[False, True] + 1) / (total[False, False] + 1))
        #: Where a place hasn't been seen: words outside and inside links.
        self.plain = limited(plain, 0.5, PLACE_LIMIT)
        self.link = limited(math.log((total[True, True] + 1) / (total[True, False] + 1)), -PLACE_LIMIT, self.plain / 2)
        self.places = {k[1:]: limited(odds(k), -PLACE_LIMIT, PLACE_LIMIT) for k in keys if k[0] == "@"}
        self.tags = {k[1:]: limited(odds(k), -TAG_LIMIT, -TAG_LEAST) for k in keys if k[0] == "<"}
        inside, outside = (sum(c for (k, m), c in counts.items() if k[0] == "#" and m == main) for main in (True, False))
        share = (inside + 1) / (inside + outside + 2)
        self.words = [0.0] * BUCKETS
        for k in keys:
            if k[0] == "#":  # what the word adds to its place
                own = (n(k, True) + PRIOR * share) / (n(k, False) + PRIOR * (1 - share))
                self.words[int(k[1:])] = limited(math.log(own) - math.log(share / (1 - share)), -WORD_LIMIT, WORD_LIMIT)
        self.flat = not any(self.words)

    def score(self, x: Item) -> float:
        if x.place is None:
            return 0.0
        if x.tag:
            return self.tags.get(x.tag, -TAG_LEAST)
        words = x.text.split()
        if not words:
            return 0.0
        place = self.places.get(f"{x.place}{' a' * x.link}", self.link if x.link else self.plain)
        return len(words) * place + (0.0 if self.flat else sum(self.words[bucket(w)] for w in words))


def best_region(scores: list[float]) -> tuple[int, int]:
    """The half-open range with the largest sum (the first of several; empty if no score is positive)."""
    best, low, high = 0.0, 0, 0
    total, start = 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, low, high = total, start, k + 1
    return low, high


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    found, _ = items(page)
    low, high = best_region([weights.score(x) for x in found])
    blocks: dict[int, list[str]] = {}
    for x in found[low:high]:
        if not x.tag and x.place is not None:
            blocks.setdefault(x.block, []).append(x.text)
    texts = (" ".join(entities.unescape("".join(runs)).split()) for runs in blocks.values())
    return " ".join(t for t in texts if t)


def fit(pages: DataFrame, html: str = "html") -> Weights:
    """Weights from every page that marks its main text; counts of the elements' names and of BUCKETS words reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, bool]] = Counter()
        for batch in slices(batches, 64):
            total.update(counted(iter(batch.column(0).to_pylist())))
        cols = [[k for k, _ in total], [m for _, m in total], list(total.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.int64()), strict=True)], names=["what", "main", "n"])

    counts = pages.select(pages[html].cast("string").alias("html")).mapInArrow(run, "what string, main boolean, n bigint")
    return Weights({(r.what, r.main): r.n for r in counts.groupBy("what", "main").agg(F.sum("n").alias("n")).collect()})


def extract(pages: DataFrame, weights: Weights, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: id, url and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = [main_text(x, weights) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    frame = pages.select(pages[page_id].alias("id"), pages[url].alias("url"), pages[html].cast("string").alias("html"))
    out = frame.mapInArrow(run, f"id {pages.schema[page_id].dataType.simpleString()}, url {pages.schema[url].dataType.simpleString()}, text string")
    return out.withColumnRenamed("id", page_id)
