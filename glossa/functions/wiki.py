"""The text of wiki pages: one linear scan with a stack of what is open.

Templates and tables go with all that is in them, at any depth; links leave their last part, links
to files and categories nothing; links to other sites leave their text; comments, references, tags,
quotes of two or more and heading marks go.  A mark that nothing closes, or that closes nothing,
stays with the text around it.  Each character is looked at once, and each piece of text is joined
once when the page ends, so a page costs time in proportion to its length, however deep it nests.

Defined cases: null stays null, an empty page is empty.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:ref|nowiki|math)\b[^<>]*/>|<(?P<name>ref|nowiki|math)\b[^<>]*>.*?(?:</(?P=name)\s*>|\Z)"
    r"|</?[A-Za-z][^<>]*>"
    r"|\{\{|\}\}|\{\||\|\}|\[\[|\]\]|\[(?=https?://)|\]|\||'{2,}|={2,}",
    re.DOTALL,
)
#: What closes what, and namespaces whose links show no text.
_CLOSES = {"}}": "{{", "|}": "{|", "]]": "[[", "]": "["}
_HIDDEN = re.compile(r"\s*:?\s*(?:file|image|category)\s*:", re.IGNORECASE)


class _Open:
    """A mark that is open: the pieces since it, and since the last bar in it."""

    __slots__ = ("first", "mark", "pieces", "since")

    def __init__(self, mark: str):
        self.mark, self.pieces, self.since, self.first = mark, [], 0, ""


def _flat(parts: list) -> str:
    """Nested lists of pieces as text, without recursion."""
    out, todo = [], [parts]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        else:
            todo.extend(reversed(part))
    return "".join(out)


def without_markup(page: str) -> str:
    stack = [_Open("")]
    count = dict.fromkeys(("{{", "{|", "[[", "["), 0)

    def unwound() -> None:
        """What is open on top stays as text."""
        top = stack.pop()
        count[top.mark] -= 1
        stack[-1].pieces += [top.mark, top.pieces]

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            stack[-1].pieces.append(page[at : m.start()])
        at, token = m.end(), m[0]
        if token in count:
            stack.append(_Open(token))
            count[token] += 1
        elif token in _CLOSES:
            if not count[_CLOSES[token]]:
                stack[-1].pieces.append(token)
                continue
            while stack[-1].mark != _CLOSES[token]:
                unwound()
            top = stack.pop()
            count[top.mark] -= 1
            if token == "]]" and not _HIDDEN.match(top.first or _start(top.pieces)):
                stack[-1].pieces.append(top.pieces[top.since :])
            elif token == "]":
                stack[-1].pieces.append(_labelled(top.pieces))
        elif token == "|":
            top = stack[-1]
            top.first = top.first or _start(top.pieces)
            top.pieces.append(token)
            top.since = len(top.pieces)
        # comments, references, tags, quotes and heading marks leave nothing
    stack[-1].pieces.append(page[at:])
    while len(stack) > 1:
        unwound()
    return _flat(stack[0].pieces)


def _start(pieces: list) -> str:
    return pieces[0] if pieces and isinstance(pieces[0], str) else " "


def _labelled(pieces: list) -> list:
    """The text of a link to another site: what follows its address."""
    if not pieces or not isinstance(pieces[0], str):
        return pieces
    address, _, label = pieces[0].partition(" ")
    return [label, *pieces[1:]]


@arrow_udf(StringType())
def _texts(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else without_markup(p) for p in pages.to_pylist()], pa.string())


def text_of(page: Column) -> Column:
    """A wiki page's text without its markup."""
    return _texts(page)


def tokens(page: Column, shortest: int = 1, longest: int = 25) -> Column:
    """Lower-case words of letters within bounds of length."""
    words = F.regexp_extract_all(F.lower(text_of(page)), F.lit(r"\p{L}+"), F.lit(0))
    return F.filter(words, lambda w: F.length(w).between(shortest, longest))
