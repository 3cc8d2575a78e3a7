"""Benchmark decontamination with suffix arrays over shards of the training text.

Each executor takes its documents shard by shard (about a million words, or one task's rows), turns
words into ids of the benchmark's vocabulary and sorts the suffixes of the shard by their first
``window`` words.  Every test suffix whose words all occur in the shard is looked up in that order
by binary search; equal ranges give the verbatim matches, which are then extended word by word to
their full length.  Nothing is shuffled: a document is judged where it is read.

The benchmark is the stated query set.  It is brought to the executors in blocks of at most
``block_words`` words, prepared once each.  A block is one pass; between passes the documents are
written to the shared folder, so that the driver and the executors hold one block at a time.

Defined cases: a null or wordless text has no words and is never contaminated; an item without
words (or a null one) matches nothing; an item shorter than ``window`` words matches as a whole;
items that share an id count once; an item with a null id marks words but is not listed;
repeated document rows are each judged alike; other input columns are ignored (or passed on by
``remove_contaminated``, whatever their names).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from glossa.llm.common import Scratch, alnum_words, cut, slices

WINDOW = 10
#: Words of benchmark text in a block (about 6 bytes each), and of documents in a shard.
BLOCK_WORDS = 2_000_000
SHARD_WORDS = 1_000_000
#: Rows that a shard grows by.
SHARD_ROWS = 64
#: What the search says of a document.
FOUND_DDL = {"n_words": "bigint", "spans": "array<struct<first:int,last:int>>", "item_ids": "array<string>", "matches": "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>"}
FOUND = pa.schema(
    {
        "n_words": pa.int64(),
        "spans": pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
        "item_ids": pa.list_(pa.string()),
        "matches": pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())])),
    }
)


class TestSet:
    """A block of benchmark items: their words as ids from 1, one after another with 0 between them."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.vocab = window, {}
        self.ids: list[str | None] = [i for i, _ in items]
        flat, starts, widths, owner = [], [], [], []
        for n, (_, words) in enumerate(items):
            width = min(window, len(words))
            for k in range(len(words) - width + 1 if words else 0):
                starts.append(len(flat) + k)
                widths.append(width)
                owner.append(n)
            flat.extend(self.vocab.setdefault(w, len(self.vocab) + 1) for w in words)
            flat.append(0)
        self.flat = np.array(flat + [0] * window, dtype=">u4")
        self.starts, self.widths, self.owner = (np.array(x, dtype=np.int64) for x in (starts, widths, owner))
        begins = {}
        for s, n in zip(starts, owner, strict=True):
            begins.setdefault(n, s)
        self.begin = np.array([begins[n] for n in owner], dtype=np.int64)  # where the suffix's item begins
        self.least = int(self.widths.min()) if starts else 0
        self.sorted = []  # for each width: the suffixes, and their distinct keys in order with one suffix each
        for width in np.unique(self.widths):
            mine = np.flatnonzero(self.widths == width)
            wanted, one, back = np.unique(keys_at(self.flat, self.starts[mine], int(width)), return_index=True, return_inverse=True)
            self.sorted.append((int(width), mine, wanted, mine[one], back))

    def present(self, ids: np.ndarray) -> np.ndarray:
        """Of each test suffix, whether a shard has all words of its window."""
        there = np.zeros(len(self.vocab) + 1, dtype=bool)
        there[ids] = True
        there[0] = False
        upto = np.concatenate(([0], np.cumsum(there[self.flat])))
        return upto[self.starts + self.widths] - upto[self.starts] == self.widths


def keys_at(ids: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` words of the suffixes at these places, as byte strings that sort like them."""
    out = np.empty((len(at), depth), dtype=">u4")
    for k in range(depth):
        out[:, k] = ids[at + k]
    return out.view(f"S{4 * depth}").ravel()


def suffix_matches(ids: np.ndarray, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (test suffix, place in the shard) that share the suffix's whole window.

    ``ids`` ends with ``window`` zeros.  A suffix that does not begin with as many benchmark words
    as the shortest window has can match nothing, so it is left out before sorting.
    """
    n = len(ids) - tests.window
    inside = np.concatenate(([0], np.cumsum(ids != 0)))
    at = np.flatnonzero(inside[tests.least : tests.least + n] - inside[:n] == tests.least)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys = keys_at(ids, at, tests.window)
    order = np.argsort(keys, kind="stable")
    suffixes, keys = at[order], keys[order]
    lows, highs = np.zeros(len(tests.starts), np.int64), np.zeros(len(tests.starts), np.int64)
    present = tests.present(ids)
    for width, mine, wanted, one, back in tests.sorted:
        ask = np.flatnonzero(present[one])
        have = keys if width == tests.window else np.ascontiguousarray(keys.view("S4").reshape(len(keys), -1)[:, :width]).view(f"S{4 * width}").ravel()
        low, high = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        low[ask] = np.searchsorted(have, wanted[ask], "left")
        high[ask] = np.searchsorted(have, wanted[ask], "right")
        lows[mine], highs[mine] = low[back], high[back]
    counts = highs - lows
    test = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return test, suffixes[lows[test] + within]


def extended(ids: np.ndarray, tests: TestSet, test: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How many words each match goes on for."""
    length = tests.widths[test].copy()
    alive = np.arange(len(test))
    while len(alive):
        a, b = tests.starts[test[alive]] + length[alive], place[alive] + length[alive]
        a, b = np.minimum(a, len(tests.flat) - 1), np.minimum(b, len(ids) - 1)
        same = (tests.flat[a] == ids[b]) & (ids[b] != 0)
        alive = alive[same]
        length[alive] += 1
    return length


def _shard(docs: list[list[bytes]], tests: TestSet, longest: bool) -> list[tuple[list[tuple[int, int]], list[int], list[dict]]]:
    """For each document: hit intervals, item numbers, and the longest match of each item."""
    out = [([], [], []) for _ in docs]
    if not len(tests.starts):
        return out
    sizes = np.array([len(d) + 1 for d in docs], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.zeros(int(begins[-1]) + tests.window, dtype=">u4")
    get = tests.vocab.get
    for d, at in zip(docs, begins[:-1], strict=True):
        ids[at : at + len(d)] = np.fromiter(map(get, d, repeat(0)), np.int64, len(d))
    test, place = suffix_matches(ids, tests)
    if not len(test):
        return out
    doc = np.searchsorted(begins, place, "right") - 1
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + tests.widths[test], -1)
    hit = np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]))
    turns = np.flatnonzero(np.diff(hit))
    for a, b in zip(turns[::2], turns[1::2], strict=True):
        d = int(np.searchsorted(begins, a, "right") - 1)
        out[d][0].append((int(a - begins[d]), int(b - begins[d])))
    for d, n in np.unique(np.stack([doc, tests.owner[test]], 1), axis=0):
        out[int(d)][1].append(int(n))
    if longest:
        length = extended(ids, tests, test, place)
        order = np.lexsort((tests.starts[test], place, -length, tests.owner[test], doc))
        pair = np.stack([doc[order], tests.owner[test][order]], 1)
        first = order[np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]).any(1))))]
        for i in first:
            d, t = int(doc[i]), int(test[i])
            out[d][2].append({"item_id": tests.ids[tests.owner[t]], "item_word": int(tests.starts[t] - tests.begin[t]), "doc_word": int(place[i] - begins[d]), "n_words": int(length[i])})
    return out


def shards(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Rows of about SHARD_WORDS words, with the words of each."""
    held, docs, words = [], [], 0
    for batch in slices(batches, SHARD_ROWS):
        held.append(batch)
        docs += map(alnum_words, batch.column(text).to_pylist())
        words += sum(map(len, docs[-batch.num_rows :])) if batch.num_rows else 0
        if words >= SHARD_WORDS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0], docs
            held, docs, words = [], [], 0
    if docs:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0], docs


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def test_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[TestSet]:
    """The benchmark in blocks of bounded size, read row by row."""
    items, words = [], 0
    for row in benchmark.select(benchmark[item_id].cast("string"), benchmark[text]).toLocalIterator():
        items.append((row[0], alnum_words(row[1])))
        words += len(items[-1][1])
        if words >= block_words:
            yield TestSet(items, window)
            items, words = [], 0
    if items or not words:
        yield TestSet(items, window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, longest: bool = True) -> DataFrame:
    """Per document: id, n_words, spans (hit word intervals), item_ids (sorted strings), matches (longest per item)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    frame = docs.select(docs[doc_id].alias("id"), docs[text].alias("text"))
    with Scratch(docs.sparkSession) as own:
        for tests, last in with_last(test_blocks(benchmark, item_id, item_text, window, block_words)):
            names = ["id", *["text"] * (not last), *FOUND.names]  # the text goes on only to another block

            def run(batches: Iterator[pa.RecordBatch], tests: TestSet = tests, names: list[str] = names) -> Iterator[pa.RecordBatch]:
                for batch, words in shards(batches, "text"):
                    before = batch.select(FOUND.names[1:]).to_pylist() if "spans" in batch.schema.names else [{"spans": [], "item_ids": [], "matches": []}] * batch.num_rows
                    made = {x: [] for x in FOUND.names} | {"n_words": list(map(len, words))}
                    for (spans, owners, matches), old in zip(_shard(words, tests, longest), before, strict=True):
                        whole = united(spans + [(s["first"], s["last"]) for s in old["spans"]])
                        made["spans"].append([{"first": a, "last": b} for a, b in whole])
                        made["item_ids"].append(sorted({tests.ids[n] for n in owners} - {None} | set(old["item_ids"])))
                        made["matches"].append(old["matches"] + matches)
                    cols = {x: pa.array(made[x], FOUND.field(x).type) for x in FOUND.names} | {x: batch.column(x) for x in ("id", "text")}
                    yield pa.RecordBatch.from_arrays([cols[x] for x in names], names=names)

            frame = frame.mapInArrow(run, ", ".join({"id": f"id {kind}", "text": "text string"}.get(x) or f"{x} {FOUND_DDL[x]}" for x in names))
            if not last:
                frame = own.cut(frame)
                own.clear(keep=1)
            elif own.paths:
                frame = cut(frame)
    return frame.withColumnRenamed("id", doc_id)


def with_last(things: Iterator) -> Iterator[tuple]:
    """Each thing, and whether it is the last; one more is read ahead."""
    things = iter(things)
    now = next(things, None)
    while now is not None:
        after = next(things, None)
        yield now, after is None
        now = after


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, all columns as they are, without those that hold a benchmark window."""
    kept = docs
    with Scratch(docs.sparkSession) as own:
        for tests, last in with_last(test_blocks(benchmark, item_id, item_text, window, block_words)):

            def run(batches: Iterator[pa.RecordBatch], tests: TestSet = tests) -> Iterator[pa.RecordBatch]:
                for batch, words in shards(batches, text):
                    yield batch.filter(pa.array([not spans for spans, _, _ in _shard(words, tests, False)], pa.bool_()))

            kept = kept.mapInArrow(run, docs.schema)
            if not last:
                kept = own.cut(kept)
                own.clear(keep=1)
            elif own.paths:
                kept = cut(kept)
    return kept
