"""Sentence segmenters and tokenisers: rule-based ones by language, fallbacks, and a registry of plug-ins.

A segmenter or tokeniser is a plain function from a text to a list of texts.  Models are plugged
in by language; where none is, the rule-based ones and the regular-expression fallbacks serve.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions.text import with_field

Splitter = Callable[[str], list[str]]

#: Rows that are held as Python objects at a time.
ROWS = 256
# Languages whose documents are segmented.
SEGMENTABLE = tuple(
    "amh bod cmn ell eng fas fra hye ind kor khm lao lin mya nde por prs pus rus sna som spa srp tha tir tur ukr urd vie "
    "aze ben bos hat hau kat kin kur mkd orm sqi swh uzb".split()
)
ROMAN = ("lin", "nde", "sna", "som")
TIBETAN = "bod"

# Lengths below which a sentence isn't cut off, and the characters whose neighbourhood is looked at.
SHORTEST_ROMAN, SHORTEST_TIBETAN, REACH = 10, 8, 20
# A title that may have prefixes, marks that close a quotation or bracket, the Tibetan marks that end a sentence, and the one that opens a text.
TITLE, CLOSERS, SHAD, OPENING = "Mnu", "'`\"”)}\\]", "།༎", "༅"

#: A token of at most four characters with a capital: an initial, a title, an abbreviation.
_ABBREVIATION = r"(?<!\S)(?:\p{Uppercase}\S{0,3}|\S\p{Uppercase}\S{0,2}|\S{2}\p{Uppercase}\S?|\S{3}\p{Uppercase})"
#: Digits that can't be a year.
_NUMBER = r"(?<!\S)(?:\d{1,3}|\d{5,})"
#: The end of a sentence: a mark that follows none of the above, no other dot and no title; what closes after it; then a capital or nothing.
_ROMAN_END = regex.compile(rf"(?<!(?:\.|{TITLE}|{_ABBREVIATION}|{_NUMBER})\s*)(?:\.(?!\.)|[!?])(?>\s*[{CLOSERS}]*)(?=\s{{{REACH}}}|\s*(?:\p{{Uppercase}}|\Z))")
#: The end of a Tibetan sentence: a mark that doesn't belong to the opening, to a number or to another mark.
_TIBETAN_END = regex.compile(rf"(?<!{OPENING}|{OPENING}.|\d)[{SHAD}](?![{SHAD}\d])", regex.DOTALL)


def _cut(text: str, end: regex.Pattern, shortest: int) -> list[str]:
    """The text cut at those ends that leave no sentence shorter than ``shortest``."""
    sentences, start = [], 0
    for at in (m.end() for m in end.finditer(text)):
        if at - start >= shortest and (sentence := text[start:at].strip()):
            sentences.append(sentence)
            start = at
    rest = text[start:].strip()
    return [*sentences, rest] if rest else sentences


def segment_roman(text: str, shortest: int = SHORTEST_ROMAN) -> list[str]:
    """Sentences by end marks, with guards against abbreviations."""
    return _cut(text, _ROMAN_END, shortest)


def segment_tibetan(text: str, shortest: int = SHORTEST_TIBETAN) -> list[str]:
    """Sentences by shad marks that neither open a text nor stand by another mark or a digit."""
    return _cut(text, _TIBETAN_END, shortest)


# The marks that end a sentence in scripts of their own; the second part ends one only before white space.
END_MARKS = {
    "amh": ("።፧፨", "!?"), "tir": ("።፧፨", "!?"), "hye": ("։", "!?"), "ell": (";", ".!"), "urd": ("۔؟", "!"), "fas": ("؟", ".!"), "prs": ("؟", ".!"), "pus": ("؟", ".!۔"),
    "mya": ("။", "!?"), "khm": ("។៕", "!?"), "cmn": ("。！？", ""), "ben": ("।", "!?"),
}


def segment_marks(text: str, always: str, spaced: str) -> list[str]:
    """Sentences by a script's own marks, with what closes after them."""
    before_space = rf"|[{regex.escape(spaced)}]+[{CLOSERS}»」』]*(?=\s)" if spaced else ""
    return _cut(text, regex.compile(rf"[{regex.escape(always)}]+[{CLOSERS}»」』]*{before_space}"), 1)


def tokenize_syllables(text: str) -> list[str]:
    """Tibetan syllables with their mark, and punctuation."""
    return regex.findall(r"[^་།༎\s]+་?|[།༎]", text)


def tokenize_geez(text: str) -> list[str]:
    """Ethiopic words, which a word mark or blanks separate, and punctuation."""
    return regex.findall(r"[^\s፡።፣፤፥፦፧፨!?]+|[።፣፤፥፦፧፨!?]", text)


def tokenize_characters(text: str) -> list[str]:
    """Chinese characters one by one, other words whole."""
    return regex.findall(r"\p{Han}|[^\W\p{Han}]+|[^\w\s]", text)


def segment_plain(text: str) -> list[str]:
    """Fallback: an end mark followed by white space ends a sentence."""
    return [s for s in re.split(r"(?<=[.!?։።।؟])\s+", text.strip()) if s]


def tokenize_plain(text: str) -> list[str]:
    """Fallback: runs of word characters, other marks one by one."""
    return re.findall(r"\w+(?:['’]\w+)*|[^\w\s]", text)


_SEGMENTERS: dict[str, Splitter] = dict.fromkeys(ROMAN, segment_roman) | {TIBETAN: segment_tibetan} | {iso: partial(segment_marks, always=a, spaced=b) for iso, (a, b) in END_MARKS.items()}
_TOKENIZERS: dict[str, Splitter] = {TIBETAN: tokenize_syllables, "amh": tokenize_geez, "tir": tokenize_geez, "cmn": tokenize_characters}


def register_segmenter(iso: str, segmenter: Splitter) -> None:
    _SEGMENTERS[iso] = segmenter


def register_tokenizer(iso: str, tokenizer: Splitter) -> None:
    _TOKENIZERS[iso] = tokenizer


def segmenter_for(iso: str | None) -> Splitter:
    return _SEGMENTERS.get(iso or "", segment_plain)


def tokenizer_for(iso: str | None) -> Splitter:
    return _TOKENIZERS.get(iso or "", tokenize_plain)


def with_sentences(docs: DataFrame, *, paragraphs: str = "paragraphs", iso: str = "site_language", tokens: bool = False, supported: tuple[str, ...] | None = None) -> DataFrame:
    """The documents with ``sentences`` (and ``tokens``): a list for each paragraph that has any.

    Documents of languages that are not ``supported`` get null; those that are segmented here or have a plug-in are, unless others are named.  Plug-ins registered on the driver go to
    the executors with the function.
    """
    segmenters, tokenizers = dict(_SEGMENTERS), dict(_TOKENIZERS)
    known = frozenset((*SEGMENTABLE, *segmenters) if supported is None else supported)
    sentence_t = pa.list_(pa.list_(pa.string()))
    token_t = pa.list_(sentence_t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            sents, toks = [], []
            for ps, lang in zip(batch.column(paragraphs).to_pylist(), batch.column(iso).to_pylist(), strict=True):
                if ps is None or lang not in known:
                    sents.append(None)
                    toks.append(None)
                    continue
                split = segmenters.get(lang or "", segment_plain)
                words = tokenizers.get(lang or "", tokenize_plain)
                found = [s for p in ps if p and (s := split(p))]
                sents.append(found)
                toks.append([[words(s) for s in p] for p in found])
            out = batch.append_column("sentences", pa.array(sents, sentence_t))
            yield out.append_column("tokens", pa.array(toks, token_t)) if tokens else out

    added = "sentences array<array<string>>" + ", tokens array<array<array<string>>>" * tokens
    return docs.mapInArrow(run, with_field(docs.schema, added))


def plain_sentences(text: Column) -> Column:
    """The fallback segmenter as an expression: text between end marks."""
    return F.filter(F.split(text, r"[.!?]+\s+"), lambda s: s != "")


def plain_tokens(text: Column) -> Column:
    """White-space tokens as an expression."""
    return F.filter(F.split(text, r"\s+"), lambda s: s != "")
