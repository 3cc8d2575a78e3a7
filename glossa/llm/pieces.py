"""SentencePiece encoding and decoding with N-best segmentation.

A text is read as a lattice of a model's pieces.  Forward Viterbi scores give, for every place, the
best way to reach it; they are the exact remaining cost of a backward A-star search, which
therefore finds the N best segmentations in order and touches nothing else.  No piece of the model
joins the end of one word with the next blank, so the lattice falls apart into units (blanks and
the word after them, marks after a word): units are searched one by one and remembered in a bounded table, and the N
best of a text are merged from those of its units, exactly.  All N are spelt, hashed and decoded; an alternative is spelt
from the paths of the few units in which it differs from the best.

The model's scores are merge ranks; a piece of rank r gets the log probability of Zipf's law,
-log(r + 2) - log H.  A character without a piece costs the least score less ten and is written as
its UTF-8 byte pieces.  Texts are not normalised, and a literal U+2581 goes through byte pieces, so
decoding gives the exact text back.

The model file is read on the driver; its pieces (a fixed number) go to the executors with the
function.  Every text is encoded whole where it is read; nothing is shuffled.

Defined cases: a null text has null ids and is not counted as failed; an empty text has no pieces;
ties in score are broken by the order of the search, which is fixed, and the best is the same whatever N; repeated rows are each encoded;
extra columns are ignored.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import heapq
import math
import re
import threading
import unicodedata
from array import array
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from glossa.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Units in a table, of which a worker has two (and their longest length); segmentations that a text is searched for.
REMEMBERED, LONGEST, N_BEST = 250_000, 32, 2
#: Seconds after its last task for which a worker remembers units; idle workers would hold the memory that other stages need.
REST = 2.0
#: Scores are multiples of one in so many, so that sums have no rounding and equal ones are ties in any order of adding.
EXACT = 1 << 30
#: What a literal U+2581 becomes inside, so that it isn't taken for a blank: a character outside Unicode text.
LITERAL = "\ud800"


class Known:
    """Units that have been searched, by row: ids of the best segmentation, what they decode to, its score, what the others score less."""

    def __init__(self) -> None:
        self.row: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.decoded: list[bytes] = []
        self.worse: list[tuple[float, ...]] = []
        self.score, self.first, self.odd = array("d"), array("d"), array("q")

    def add(self, unit: str, scores: list[float], ids: list[int], odd: int, decoded: bytes) -> int:
        top = scores[0]
        self.ids.append(array("i", ids).tobytes())
        self.decoded.append(decoded)
        self.worse.append(tuple([top - s for s in scores[2:]]))
        self.score.append(top)
        self.first.append(top - scores[1] if len(scores) > 1 else math.inf)
        self.odd.append(odd)
        return self._named(unit)

    def again(self, unit: str, other: Known, at: int) -> int:
        """Takes over what another table knows of a unit."""
        for mine, theirs in ((self.ids, other.ids), (self.decoded, other.decoded), (self.worse, other.worse), (self.score, other.score), (self.first, other.first), (self.odd, other.odd)):
            mine.append(theirs[at])
        return self._named(unit)

    def _named(self, unit: str) -> int:
        at = len(self.ids) - 1
        if len(unit) <= LONGEST:
            self.row[unit] = at
        return at


_loaded: dict[str, Pieces] = {}


def _restored(digest: str, source: list[tuple[str, float, bool]]) -> Pieces:
    """A worker builds a model once; later tasks find it with the units that it has met."""
    if digest not in _loaded:
        _loaded.clear()
        _loaded[digest] = Pieces(source)
    return _loaded[digest]


class Pieces:
    """A model's pieces with their scores, and a search over them."""

    def __init__(self, pieces: list[tuple[str, float, bool]]):
        """pieces: (text, rank score, whether it is a byte) by id; unused ones have an empty text."""
        self.source = pieces
        self.digest = hashlib.sha256(repr(pieces).encode()).hexdigest()
        self.bytes = {int(text[3:5], 16): k for k, (text, _, byte) in enumerate(pieces) if byte}
        plain = [(k, text, -score if score > -1e8 else len(pieces)) for k, (text, score, byte) in enumerate(pieces) if text and not byte]
        norm = math.log(sum(1 / (rank + 2) for _, _, rank in plain) or 1.0)
        self.piece = {text: (k, round((-math.log(rank + 2) - norm) * EXACT) / EXACT) for k, text, rank in plain}
        self.unknown = min((s for _, s in self.piece.values()), default=0.0) - 10
        self.root: tuple[dict, int, float] = ({}, -1, 0.0)  # a tree of (following characters, piece or -1, score)
        self.widest = max(map(len, self.piece), default=1)
        for text, (k, score) in self.piece.items():
            at = self.root
            for n, char in enumerate(text, 1):
                old = at[0].get(char, ({}, -1, 0.0))
                at[0][char] = (old[0], k, score) if n == len(text) else old
                at = at[0][char]
        self.raw = [bytes([int(text[3:5], 16)]) if byte else text.replace(SPACE, " ").encode() for text, _, byte in pieces]
        self.unit_pattern = re.compile(self._unit_pattern())
        self.known: dict[int, Known] = {}  # by n; a full table becomes the older one
        self.older: dict[int, Known] = {}
        self.remembered = REMEMBERED
        self.resting: threading.Timer | None = None

    def _unit_pattern(self) -> str:
        """Where a lattice surely falls apart: before a blank, around a line's end, between a word and a mark."""
        if any("\n" in t or SPACE in t.lstrip(SPACE) for t in self.piece):
            return "(?s:.+)"
        pairs = {(a, b) for t in self.piece for a, b in zip(t, t[1:], strict=False) if a != SPACE}
        odd = "".join(sorted({c for t in self.piece for c in t if unicodedata.category(c) == "No"}))  # such as a raised 2: marks, though \\w has them
        inside = re.compile(rf"[^\W{odd}]")
        joined: dict[str, str] = {}  # marks that some piece joins to a word, and the characters before them there: no cut between these
        for a, b in sorted(pairs):
            if inside.match(a) and not inside.match(b):
                joined[b] = joined.get(b, "") + re.escape(a)
        rest = rf"(?:(?:{'|'.join(f'(?<=[{a}]){re.escape(b)}' for b, a in joined.items())})[^{SPACE}\n]*)?" if joined else ""
        return rf"{SPACE}*[^\W{odd}]+{rest}|{SPACE}*(?![{SPACE}\n])[\W{odd}][^{SPACE}\n]*|{SPACE}+|\n"

    def wake(self, remembered: int = REMEMBERED) -> None:
        """A task begins: what is remembered stays, in tables of so many units from now on."""
        self.remembered = remembered
        self._stay()

    def _stay(self) -> None:
        if self.resting is not None:
            self.resting.cancel()
            self.resting = None

    def rest(self, seconds: float | None = None) -> None:
        """A task has ended: if none begins soon, the tables of units are freed."""
        self._stay()
        self.resting = threading.Timer(REST if seconds is None else seconds, self._forget)
        self.resting.daemon = True
        self.resting.start()

    def _forget(self) -> None:
        """Frees the tables, and gives what the allocators keep of them back to the system."""
        self.known, self.older = {}, {}
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim is not None:
            trim(0)

    def __reduce__(self) -> tuple:
        return _restored, (self.digest, self.source)

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        m = SentencePieceProcessor(model_file=path)
        return cls([("" if m.is_control(k) or m.is_unknown(k) or m.is_unused(k) else m.id_to_piece(k), m.get_score(k), m.is_byte(k)) for k in range(m.get_piece_size())])

    def lattice(self, unit: str) -> tuple[list[list[tuple[int, float, int]]], list[float]]:
        """For each place the edges that end there, (start, score, piece or -1), and the best score of reaching it."""
        size = len(unit)
        ends: list[list[tuple[int, float, int]]] = [[] for _ in range(size + 1)]
        best = [0.0] + [-math.inf] * size
        top, widest = self.root[0], self.widest
        for at in range(size):
            here, after, end, alone = best[at], top, at, False
            for char in unit[at : at + widest]:
                node = after.get(char)
                if node is None:
                    break
                after, k, score = node
                end += 1
                if k >= 0:
                    ends[end].append((at, score, k))
                    alone = alone or end == at + 1
                    score += here
                    if score > best[end]:
                        best[end] = score
            if not alone:  # a character without a piece of its own
                ends[at + 1].append((at, self.unknown, -1))
                if here + self.unknown > best[at + 1]:
                    best[at + 1] = here + self.unknown
        return ends, best

    def search(self, unit: str, n: int) -> list[tuple[float, list[int], int]]:
        """The n best segmentations of a unit: score, ids, characters written as bytes."""
        return [(score, *self._spelt(unit, path)) for score, path in self._paths(unit, n)]

    def _paths(self, unit: str, n: int) -> list[tuple[float, tuple | None]]:
        """The n best paths through a unit's lattice, as (score, chain of edges).

        The agenda has partial segmentations from the end, ordered by their score plus the best score
        of what is left, which the forward pass has found exactly.  So each entry stands for a whole
        segmentation of just that score, and no more than the n best entries are ever needed.  Of
        equal entries the newest are followed first, so the first path doesn't depend on n.
        """
        ends, best = self.lattice(unit)
        agenda: list[tuple] = []
        found, turn = [], 0
        cost, at, behind, path = -best[-1], len(unit), 0.0, None
        while True:
            others = n - len(found) - 1  # entries that can be of use besides the one that is followed
            least = -math.inf if not others else agenda[-1][0] if len(agenda) >= others else math.inf
            while at:
                turn -= 1
                follow = None  # the edge that loses nothing is the next entry of all: it needs no place on the agenda
                for start, score, k in ends[at]:
                    score += behind
                    loss = -score - best[start]
                    if follow is None and loss == cost:
                        follow = (start, score, k)
                    elif loss <= least:
                        insort(agenda, (loss, turn, start, score, (start, k, path)))
                        if len(agenda) >= others:
                            del agenda[others:]
                            least = agenda[-1][0]
                at, behind, k = follow
                path = (at, k, path)
            found.append((behind, path))
            if not others or not agenda:
                return found
            cost, _, at, behind, path = agenda.pop(0)

    def _met(self, unit: str, n: int, known: Known, met: dict[str, list]) -> int:
        """Looks a unit up among older ones, or else searches and remembers it; its paths go into ``met`` until the text is done."""
        older = self.older.get(n)
        if older is not None and (at := older.row.get(unit)) is not None:
            return known.again(unit, older, at)
        paths = met[unit] = self._paths(unit, n)
        ids, unknown = self._spelt(unit, paths[0][1])
        return known.add(unit, [score for score, _ in paths], ids, unknown, self._bytes(ids))

    def _spelt(self, unit: str, path: tuple | None) -> tuple[list[int], int]:
        """The ids along a path, and how many characters went through bytes."""
        ids, unknown = [], 0
        while path is not None:
            start, k, path = path
            if k >= 0:
                ids.append(k)
            else:
                char = SPACE if unit[start] == LITERAL else unit[start]
                ids += [self.bytes[b] for b in char.encode()]
                unknown += 1
        return ids, unknown

    def units(self, text: str) -> list[str]:
        marked = text.replace(SPACE, LITERAL) if SPACE in text else text
        return self.unit_pattern.findall(SPACE + marked.replace(" ", SPACE)) if text else []

    def encode(self, text: str, n: int = 1) -> tuple[np.ndarray, float, int, list[float]]:
        """ids, score and unknown characters of the best segmentation of a text; the scores of its n best."""
        found, odd = self.best(text, n)
        return found[0][1], found[0][0], odd, [score for score, _ in found]

    def best(self, text: str, n: int = 1) -> tuple[list[tuple[float, np.ndarray]], int]:
        """The n best segmentations of a text, as (score, ids), from remembered units; unknown characters of the first."""
        return self.best_decoded(text, n)[:2]

    def best_decoded(self, text: str, n: int = 1) -> tuple[list[tuple[float, np.ndarray]], int, list[bytes]]:
        """As ``best``, and what the ids of each segmentation decode to.

        A segmentation's ids are those of its units, so its decoding is the units' decodings, which
        are remembered with the units; where a unit is cut otherwise, those ids are decoded.
        """
        known = self.known.setdefault(n, Known())
        if len(known.ids) >= self.remembered:
            self.older[n] = known
            known = self.known[n] = Known()
        units, met = self.units(text), {}
        rows = list(map(known.row.get, units))
        if None in rows:
            rows = [self._met(u, n, known, met) if (r := known.row.get(u)) is None else r for u in units]
        if not rows:
            return [(0.0, np.empty(0, dtype="<i4"))], 0, [b""]
        at = np.array(rows)
        total = float(np.frombuffer(known.score)[at].sum())
        odd = int(np.frombuffer(known.odd, dtype=np.int64)[at].sum())
        choices: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]  # score lost, and which segmentation of which units instead of the best
        if n > 1:  # among the n best, only those n - 1 units can differ from their best that lose least by it
            first = np.frombuffer(known.first)[at]
            for k in np.argsort(first, kind="stable")[: n - 1].tolist() if n > 2 else [int(first.argmin())]:
                losses = (0.0, float(first[k]), *known.worse[rows[k]])
                choices = heapq.nsmallest(n, [(a + b, (*others, (k, way)) if way else others) for a, others in choices for way, b in enumerate(losses)], key=lambda c: c[0])
        spelt, out = list(map(known.ids.__getitem__, rows)), []
        plain = b"".join(map(known.decoded.__getitem__, rows))
        decoded = []
        for loss, others in choices:
            if loss < math.inf:
                parts, other = spelt.copy() if others else spelt, {}
                for k, way in others:
                    unit = units[k]
                    paths = met[unit] if unit in met else met.setdefault(unit, self._paths(unit, n))
                    ids = self._spelt(unit, paths[way][1])[0]
                    parts[k] = array("i", ids).tobytes()
                    head = self._bytes(ids).decode("utf-8", "replace")[:1]  # which decode takes for the blank before a text
                    other[k] = (head + self.decode(ids)).encode()
                out.append((total - loss, np.frombuffer(b"".join(parts), dtype="<i4")))
                same = all(x == known.decoded[rows[k]] for k, x in other.items())
                decoded.append(plain if same else b"".join(other.get(k, known.decoded[r]) for k, r in enumerate(rows)))
        return out, odd, decoded

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))

    def n_best(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a text, as (score, ids)."""
        best: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        units = [self.search(u, n) for u in self.units(text)]
        for at, found in enumerate(units):
            best = heapq.nsmallest(n, [(loss + found[0][0] - f[0], (*others, (at, k)) if k else others) for loss, others in best for k, f in enumerate(found)], key=lambda b: b[0])
        total = sum(f[0][0] for f in units)
        return [(total - loss, [k for at, f in enumerate(units) for k in f[dict(others).get(at, 0)][1]]) for loss, others in best]

    def decode(self, ids: list[int]) -> str:
        return self._bytes(ids).decode("utf-8", "replace")[1:]


def _all_spell(decoded: list[bytes], text: str) -> bool:
    """Whether each decoding is the text, behind the blank that begins it."""
    whole = f" {text}".encode() if text else b""
    return all(d == whole for d in decoded)


def _lists(rows: list[list | None], kind: pa.DataType) -> pa.ListArray:
    """Lists of ids, or lists of those."""
    offsets = np.concatenate(([0], np.cumsum([len(r) if r is not None else 0 for r in rows]))).astype(np.int32)
    given = [r for r in rows if r is not None and len(r)]
    if pa.types.is_list(kind):
        values = _lists([x for r in given for x in r], kind.value_type)
    else:
        values = pa.array(np.concatenate(given) if given else np.empty(0, "<i4"), kind)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([r is None for r in rows], pa.bool_()))


def encode(docs: DataFrame, pieces: Pieces, *, doc_id: str = "doc_id", text: str = "text", n_best: int = N_BEST, with_ids: bool = True, remembered: int = REMEMBERED) -> DataFrame:
    """Per document: id, ids and others (if asked for), n_pieces, n_unknown, scores (of the n best), ids_sha256, others_sha256, round_trip (null for null).

    ``others`` has the ids of the second to the n-th segmentation, as far as there are so many;
    ``round_trip`` says whether each of the n decodes to the text.  ``remembered`` bounds a worker's
    two tables of units, and with them its memory; it changes no result.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["id", *["ids", "others"] * with_ids, "n_pieces", "n_unknown", "scores", "ids_sha256", "others_sha256", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces.wake(remembered)
        for batch in slices(batches, 128):
            texts = batch.column(1).to_pylist()
            found = [pieces.best_decoded(t, n_best) if t is not None else None for t in texts]
            best = [f[0][0][1] if f else np.empty(0, "<i4") for f in found]
            others = [[ids for _, ids in f[0][1:]] if f else [] for f in found]
            cols = {
                "id": batch.column(0),
                "n_pieces": pa.array([len(f) for f in best], pa.int64()),
                "n_unknown": pa.array([f[1] if f else 0 for f in found], pa.int64()),
                "scores": pa.array([[score for score, _ in f[0]] if f else [] for f in found], pa.list_(pa.float64())),
                "ids_sha256": pa.array([hashlib.sha256(f).hexdigest() for f in best], pa.string()),
                "others_sha256": pa.array([[hashlib.sha256(x).hexdigest() for x in o] for o in others], pa.list_(pa.string())),
                "round_trip": pa.array([None if t is None else _all_spell(f[2], t) for t, f in zip(texts, found, strict=True)], pa.bool_()),
            }
            if with_ids:
                cols["ids"] = _lists([None if t is None else f for t, f in zip(texts, best, strict=True)], pa.int32())
                cols["others"] = _lists([None if t is None else o for t, o in zip(texts, others, strict=True)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([cols[x] for x in names], names=names)
        pieces.rest()

    ddl = {"id": kind, "ids": "array<int>", "others": "array<array<int>>", "n_pieces": "bigint", "n_unknown": "bigint", "scores": "array<double>", "ids_sha256": "string", "others_sha256": "array<string>", "round_trip": "boolean"}
    frame = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    return frame.mapInArrow(run, ", ".join(f"{x} {ddl[x]}" for x in names)).withColumnRenamed("id", doc_id)


def decode(encoded: DataFrame, pieces: Pieces, *, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: id and the text that its ids spell (null for null)."""
    kind = encoded.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            texts = [None if x is None else pieces.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return encoded.select(encoded[doc_id].alias("id"), encoded[ids].alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", doc_id)
