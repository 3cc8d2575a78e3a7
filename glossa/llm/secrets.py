"""Secret scans: fixed patterns, and strings that a primed compressor finds novel.

Every text is scanned whole where it is read.  The patterns give base spans.  Each candidate string
in a sensitive context (a credential word shortly before it, or a line directly before it that has
one) is compressed with zstandard twice: the surrounding code alone, and the surrounding code with
the candidate, both primed with a dictionary of identifiers.  The difference is the candidate's
marginal size.  Identifiers, paths, repeated names and prose are cheap after that priming; keys are
not: a candidate that costs at least ``min_bytes``, and ``novelty`` bytes a character, is reported.
Base spans are measured as well.

The dictionary is a list of names common in code, and the corpus' own identifiers: words near
sensitive ones, over all documents, that stand between at least ``support`` different pairs of
neighbours; the ``dictionary`` most frequent.  Copies of a text count once, so a key that is copied
with its surroundings stays out.

Defined cases: a null or empty text has no spans; ties in start are ordered by kind; repeated
rows are each scanned; without documents the dictionary is the fixed list; other columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import slices

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of fewer is dropped anyway
#: Candidates: unbroken strings of key characters.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{3,63}")
#: What may stand between the lines of one key.
BREAK = re.compile(r"""[ \t"',;+\\]*(?:\r?\n|\\n)[ \t"'#*>]*""")
#: Words that make a context sensitive.
SENSITIVE = re.compile(r"password|passwd|secret|token|api[ _-]?key|credential|private|bearer|authorization|access[ _-]?key|auth[ _-]?key|signing[ _-]?key")
SENSITIVE_WORDS = ("password", "passwd", "secret", "token", "api", "credential", "private", "bearer", "authorization", "key")
#: Names and fragments common in code and configuration and long words of prose, which prime the compressor.
IDENTIFIERS = b"""
import from return class def self none true false null this public private static void string int bool const let var function
username password passwd secret token access_key secret_key api_key apikey authorization bearer credential client_id client_secret
configuration config settings environment default production development localhost example database connection connection_string
application service server client request response session header content-type application/json utf-8 base64 https://www.example.com
get set put post delete update create insert select where order group index value values key keys name names type types path file
getElementById addEventListener toString hashCode equals length substring charAt parseInt parseFloat console.log System.out.println
your_password_here your_api_key_here changeme placeholder undefined exception error warning message logger handler manager factory
controller repository implementation interface abstract protected extends implements override template namespace include define
usr/local/bin usr/lib home/user var/log etc/config src/main/java node_modules package version release license description
international national information organization administration government development management understanding communication
responsibility availability possibility compatibility security authority university community particularly significantly
immediately approximately unfortunately automatically successfully increasingly characteristics experience difference conference
performance importance independence environmental fundamental professional additional traditional conventional constitutional
recommendation representation presentation implementation documentation authentication authorization verification notification
classification specification modification transformation initialization serialization synchronization optimization utilization
construction introduction production distribution contribution institution restriction description subscription transaction
establishment requirement announcement achievement investment agreement assignment equipment statement treatment
considerable comfortable reasonable available responsible accessible impossible different important significant
background foreground everything something throughout furthermore nevertheless meanwhile afterwards yesterday tomorrow
questionnaire encyclopedia psychology technology philosophy photography geography mathematics scientific historical political
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 the and for with that have not are was from they will
"""
BEFORE, AFTER, REACH = 300, 150, 40
#: Letters of the identifiers in random order.  They stand before every stretch that is measured, so
#: that the compressor's table of letters is a typical one in short stretches as well.
LETTERS = bytes(random.Random(3).sample(IDENTIFIERS, len(IDENTIFIERS))[:1200])
#: Marginal bytes per character, and in all, from which a candidate counts as incompressible.  Random
#: base 64 and hex cost about 1 byte a character, lower-case letters 0.65; nearly all words of prose
#: cost less than 9 bytes.
NOVELTY, MIN_BYTES = 0.5, 11
#: Identifiers taken from the corpus, and different surroundings that each needs.
DICTIONARY, SUPPORT = 2000, 20


_LOWER = {k: k + 32 for k in range(65, 91)}


class Novelty:
    """Marginal compressed size of a string, given what surrounds it and the identifier dictionary."""

    def __init__(self, identifiers: tuple[str, ...] = ()) -> None:
        # what stands last is cheapest to refer to
        primed = zstandard.ZstdCompressionDict(" ".join(reversed(identifiers)).encode() + IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.size = lambda raw, c=zstandard.ZstdCompressor(level=19, dict_data=primed, write_checksum=False, write_content_size=False): len(c.compress(raw))

    def bytes(self, before: str, candidate: str, after: str) -> int:
        around = LETTERS + (before + "\n" + after + "\n").encode("utf-8", "replace")
        return max(0, self.size(around + candidate.encode("utf-8", "replace")) - self.size(around))

    def of(self, text: str, start: int, end: int) -> int:
        return self.bytes(text[max(0, start - BEFORE) : start], text[start:end], text[end : end + AFTER])


def incompressible(size: int, length: int, novelty: float, min_bytes: int) -> bool:
    return size >= min_bytes and size >= novelty * length


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, number of kind, end) of the fixed patterns, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def novel_spans(text: str, base: list[tuple[int, int, int]], measure: Novelty, novelty: float = NOVELTY, min_bytes: int = MIN_BYTES) -> list[tuple[int, int, int]]:
    """Strings in a sensitive context that no base span covers and that do not compress."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE_WORDS):
        return []
    found, carried = [], -1
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if not SENSITIVE.search(text[max(0, s - REACH) : s].lower()) and not (carried >= 0 and BREAK.fullmatch(text, carried, s)):
            continue
        carried = e  # lines of a key that follow directly are in its context
        if any(a < e and s < b for a, _, b in base):
            continue
        if incompressible(measure.of(text, s, e), e - s, novelty, min_bytes):
            found.append((s, 3, e))
    return found


def surroundings(text: str) -> set[tuple[str, int]]:
    """(identifier, hash of its neighbours) for each identifier near a sensitive word."""
    low = text.translate(_LOWER)
    if not any(w in low for w in SENSITIVE_WORDS):
        return set()
    found, done = set(), 0
    for m in SENSITIVE.finditer(low):
        start, end = max(done, m.start() - BEFORE), m.end() + AFTER
        names = [x[0] for x in IDENTIFIER.finditer(text, start, min(len(text), end))]
        for left, name, right in zip(["", *names], names, [*names[1:], ""], strict=False):
            found.add((name, zlib.crc32(f"{left} {right}".encode("utf-8", "replace"))))
        done = max(done, end)
    return found


def corpus_identifiers(docs: DataFrame, *, text: str = "text", dictionary: int = DICTIONARY, support: int = SUPPORT) -> tuple[str, ...]:
    """The most frequent identifiers near sensitive words, by different surroundings; at most ``dictionary`` reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = sorted(set().union(*(surroundings(t) for t in batch.column(0).to_pylist() if t)))
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.string()), pa.array([a for _, a in rows], pa.int64())], names=["name", "around"])

    met = docs.select(docs[text].cast("string").alias("text")).mapInArrow(run, "name string, around bigint").distinct()
    counted = met.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= support)
    return tuple(r.name for r in counted.orderBy(F.desc("n"), "name").limit(dictionary).collect())


def find_secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", novelty: float = NOVELTY, min_bytes: int = MIN_BYTES, dictionary: int = DICTIONARY, support: int = SUPPORT) -> DataFrame:
    """Per document: id and spans, an array of (kind, start, end, marginal bytes) in code points, by start and kind."""
    kind = docs.schema[doc_id].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bytes", pa.int64())]))
    identifiers = corpus_identifiers(docs, text=text, dictionary=dictionary, support=support)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Novelty(identifiers)
        for batch in slices(batches):
            rows = []
            for value in batch.column(1).to_pylist():
                base = base_spans(value) if value else []
                spans = sorted(base + novel_spans(value, base, measure, novelty, min_bytes)) if value else []
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "bytes": measure.of(value, s, e)} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, item)], names=["id", "spans"])

    frame = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    return frame.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,bytes:bigint>>").withColumnRenamed("id", doc_id)
