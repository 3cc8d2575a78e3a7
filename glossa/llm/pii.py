"""Personal data: fixed patterns and titled names, and terms whose company gives a protected entity away.

The patterns give base spans, and names after a title ("Dr. Jane Roe") are found as well; each
distinct value (an address, a number, a name) is a protected entity.  Corpus co-occurrence then
estimates what other terms reveal.  For a term t near entity e,

    disclosure(t, e) = 1 - log p(e|t) / log p(e)

is the share of the entity's information, -log p(e), that knowing t gives away, with p(e|t) the
documents that have t near e over those that have t, and p(e) the entity's documents over all
documents; copies count in each.  A term needs ``support`` distinct contexts, so copies of one text
reveal nothing more than the text itself.  In every document that has them, terms at or above
``remove`` vanish, and terms at or above ``generalise`` are generalised: cut to the longest of their
beginnings of three, two or one letters that, by the same measure over all terms that begin so,
stays below the threshold.

All counts cover all documents: one pass counts contexts, one the documents of each term; both are
grouped aggregations (partial sums before the shuffle).  Up to ``max_terms`` revealing terms go to
the executors with the function; more are joined to the documents' own terms.

Defined cases: a null or empty text has no spans; ties in start are ordered by kind; repeated rows
are each scanned; no entities, no terms; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Scratch, cut, slices

KINDS = ("email", "ip", "card", "phone", "name", "term")
NAME_KIND, TERM_KIND = 4, 5
#: Of an address, what may stand before the @, and the rest from the @ on.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # no match starts inside a run of digits
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{2,}")
#: Titles that a name follows.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Professor", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora")
NAME = re.compile(rf"\b(?:{'|'.join(TITLES)})\b\.?\x20((?:[A-ZÀ-ÖØ-Þ][^\W\d_]+[\x20'-]?){{1,4}}(?<=\w))")
#: Words on either side of an entity that are its context, distinct contexts a term needs, thresholds of disclosure.
REACH, SUPPORT, GENERALISE, REMOVE = 8, 3, 0.9, 0.97
#: Revealing terms that go to the executors with the function (some 20 MB), terms that a task counts before it passes sums on, and lengths of beginnings.
MAX_TERMS, COUNTED, BEGINNINGS = 200_000, 200_000, (3, 2, 1)
GENERAL = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "name": "<NAME>"}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their @, so that long unbroken texts cost linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := HOST.match(text, at)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of kind, end) of the fixed patterns, in order."""
    out = []
    out += [(s, 0, e) for s, e in emails(text)]
    if not re.search("[0-9]", text):
        return out
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x := p.lstrip("0")) <= 3 and int(x or "0") <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if 14 <= len(m[0]) <= 37 and 14 <= len(digits := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(out)


def names(text: str) -> list[tuple[int, int, int]]:
    """Spans of names that follow a title."""
    return [(m.start(1), NAME_KIND, m.end(1)) for m in NAME.finditer(text)] if any(t in text for t in TITLES) else []


def spans_of(text: str | None) -> list[tuple[int, int, int]]:
    """Base spans and names, in order."""
    return sorted(base_spans(text) + names(text)) if text else []


def entity(text: str, span: tuple[int, int, int]) -> str:
    """A span's value, in one spelling."""
    start, kind, end = span
    value = text[start:end]
    return f"{KINDS[kind]}:{value.lower() if kind in (0, NAME_KIND) else value if kind == 1 else re.sub('[^0-9]', '', value)}"


def context(text: str, start: int, end: int, reach: int) -> list[str]:
    """The terms next to a span, in lower case; a window of characters is enough to find them."""
    before = TERM.findall(text[max(0, start - 40 * reach) : start])[-reach:]
    after = [m[0] for m, _ in zip(TERM.finditer(text, end), range(reach), strict=False)]
    return [t.lower() for t in before + after]


def contexts(docs: DataFrame, text: str, reach: int) -> DataFrame:
    """Distinct (entity, term, context) with n, for each term that stands near an entity; the term '' stands for the context itself.

    n summed over an entity's and term's contexts gives their documents: each counts in one of its contexts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for value in batch.column(0).to_pylist():
                spans, met = spans_of(value), set()
                covered = [(s, e) for s, _, e in spans]
                for span in spans:
                    near = context(_masked(value, covered, span, reach), *_moved(covered, span, value, reach), reach)
                    whole = " ".join(near)
                    name = entity(value, span)
                    for t in {*near, ""}:
                        rows.append((name, t, whole, int((name, t) not in met)))
                        met.add((name, t))
            cols = zip(*rows, strict=True) if rows else ([], [], [], [])
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names=["entity", "term", "context", "n"])

    found = docs.select(docs[text].cast("string").alias("text")).mapInArrow(run, "entity string, term string, context string, n bigint")
    return found.groupBy("entity", "term", "context").agg(F.sum("n").alias("n"))


def _window(span: tuple[int, int, int], value: str, reach: int) -> tuple[int, int]:
    return max(0, span[0] - 40 * reach), min(len(value), span[2] + 40 * reach)


def _masked(value: str, covered: list[tuple[int, int]], span: tuple[int, int, int], reach: int) -> str:
    """The text around a span, with other spans blanked: parts of one entity aren't terms of another."""
    low, high = _window(span, value, reach)
    out = value[low:high]
    for s, e in covered:
        if s < high and e > low:
            a, b = max(s, low) - low, min(e, high) - low
            out = out[:a] + " " * (b - a) + out[b:]
    return out


def _moved(covered: list[tuple[int, int]], span: tuple[int, int, int], value: str, reach: int) -> tuple[int, int]:
    low, _ = _window(span, value, reach)
    return span[0] - low, span[2] - low


def terms_of(text: str | None) -> set[str]:
    return set(TERM.findall(text.lower())) if text else set()


def document_frequency(docs: DataFrame, text: str) -> DataFrame:
    """In how many documents each term stands: (term, n_docs)."""

    def sums(total: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                total.update(terms_of(value))
            if len(total) >= COUNTED:
                yield sums(total)
                total.clear()
        yield sums(total)

    return docs.select(docs[text].cast("string").alias("text")).mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n_docs"))


def revealing_terms(docs: DataFrame, *, text: str = "text", reach: int = REACH, support: int = SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) at or above the threshold, with ``beginnings``: the disclosure of the term's beginnings, longest first."""
    with Scratch(docs.sparkSession) as own:
        met = own.cut(contexts(docs, text, reach).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_contexts"), F.sum("n").alias("n_near")))
        frequency = own.cut(document_frequency(docs, text))
        n = max(docs.count(), 2)
        entities = met.filter("term = ''").select("entity", F.log(F.least(F.col("n_near") / F.lit(n), F.lit(1 - 1e-9))).alias("prior"))
        share = lambda near, docs: 1 - F.log(F.least(F.col(near) / F.col(docs), F.lit(1.0))) / F.col("prior")
        pairs = met.filter(F.col("n_contexts") >= support).filter("term != ''").join(frequency, "term").join(entities, "entity")
        found = own.cut(pairs.select("entity", "term", "prior", share("n_near", "n_docs").alias("disclosure")).filter(F.col("disclosure") >= generalise))
        out = found
        for k in BEGINNINGS:
            begin = F.substring("term", 1, k).alias(f"b{k}")
            all_docs = frequency.groupBy(begin).agg(F.sum("n_docs").alias(f"d{k}"))
            all_near = met.filter("term != ''").join(found.select("entity").distinct(), "entity", "left_semi").groupBy("entity", begin).agg(F.sum("n_near").alias(f"e{k}"))
            out = out.withColumn(f"b{k}", begin).join(all_docs, f"b{k}").join(all_near, ["entity", f"b{k}"])
        return cut(out.select("entity", "term", "disclosure", F.array(*[share(f"e{k}", f"d{k}") for k in BEGINNINGS]).alias("beginnings")))


def treated_terms(pairs: DataFrame, generalise: float) -> DataFrame:
    """(term, disclosure, general) over all entities: the longest proper beginning that gives none of them away, or null."""
    worst = pairs.groupBy("term").agg(F.max("disclosure").alias("disclosure"), *[F.max(F.col("beginnings")[i]).alias(f"w{k}") for i, k in enumerate(BEGINNINGS)])
    general = F.coalesce(*[F.when((F.col(f"w{k}") < generalise) & (F.length("term") > k), F.substring("term", 1, k)) for k in BEGINNINGS])
    return worst.select("term", "disclosure", general.alias("general"))


def own_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(version, own): for each text, by its hash, those of its terms that are treated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(v, t) for v, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for t in terms_of(value)]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["version", "term"])

    met = docs.select("version", "text").mapInArrow(run, "version bigint, term string").distinct().join(terms, "term")
    return met.groupBy("version").agg(F.collect_list(F.struct("term", "disclosure", "general")).alias("own"))


def find_personal_data(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", reach: int = REACH, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE, max_terms: int = MAX_TERMS) -> DataFrame:
    """Per document: id, spans (kind, start, end, disclosure) by start and kind, and the sanitised text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    terms = cut(treated_terms(revealing_terms(docs, text=text, reach=reach, support=support, generalise=generalise), generalise))
    frame = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    if terms.count() <= max_terms:
        shared = {r.term: (r.disclosure, r.general) for r in terms.collect()}
    else:
        shared = None
        frame = frame.withColumn("version", F.xxhash64("text"))
        frame = frame.join(cut(own_terms(frame, terms)), "version", "left").select("id", "text", "own")
    span_t = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("disclosure", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, rows, clean = batch.column(1).to_pylist(), [], []
            owned = batch.column(2).to_pylist() if shared is None else [None] * len(texts)
            for value, own in zip(texts, owned, strict=True):
                reveals = shared if shared is not None else {t["term"]: (t["disclosure"], t["general"]) for t in own or ()}
                found = spans_of(value)
                levels = dict.fromkeys(found, 1.0)
                for m in TERM.finditer(value) if reveals and value else ():
                    if m[0].lower() in reveals and not any(s < m.end() and m.start() < e for s, _, e in found):
                        levels[m.start(), TERM_KIND, m.end()] = reveals[m[0].lower()][0]
                ordered = sorted(levels.items())
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "disclosure": d} for (s, k, e), d in ordered])
                clean.append(sanitised(value, ordered, reveals, remove) if ordered else value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clean, pa.string()), pa.array(rows, span_t)], names=["id", "sanitised", "spans"])

    return frame.mapInArrow(run, f"id {kind}, sanitised string, spans array<struct<kind:string,start:bigint,end:bigint,disclosure:double>>").withColumnRenamed("id", doc_id)


def sanitised(text: str, spans: list[tuple[tuple[int, int, int], float]], reveals: dict[str, tuple[float, str | None]], remove: float) -> str:
    """The text with spans generalised, and with those terms gone that reveal too much; of overlapping spans the first counts."""
    out, at = [], 0
    for (start, kind, end), level in spans:
        if start < at:
            continue
        out.append(text[at:start])
        if kind != TERM_KIND:
            out.append(GENERAL[KINDS[kind]])
        elif level < remove and (general := reveals[text[start:end].lower()][1]):
            out.append(text[start : start + len(general)] + "…")
        at = end
    return "".join([*out, text[at:]])
