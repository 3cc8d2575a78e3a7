"""Quality rules with an isolation forest on rule statistics.

Each text's rule statistics are counted whole, where it is read.  Two base rules fail a document
outright.  On the others an isolation forest judges: trees of random splits over a bounded,
hash-chosen sample of labelled documents, the mean path length of a row turned into an anomaly
score, and the score's threshold calibrated on the labelled rows.  Only the sample's statistics
(``sample`` rows of a few numbers) reach the driver; the fitted trees are broadcast with the
function and every document is scored where it is read.

The sample is the rows of ``labels`` with the smallest hash of their id: ``sample`` rows at
every size of input.

Defined cases: a null or wordless text has zero statistics and fails the base rule of length;
without labelled rows (or with one class only) the forest rejects nothing and the base rules
decide alone; repeated rows are each judged alike; extra columns pass through the filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import slices

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: Labelled rows that the forest is fitted and calibrated on, trees, and rows of each tree.
SAMPLE, TREES, TREE_ROWS = 4000, 100, 256
#: Of labelled good rows, the share that the calibrated threshold may reject.
MAX_LOSS = 0.002
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(text: str | None) -> tuple[tuple[int, int, int, int, int], tuple[float, ...]]:
    """The contract's counts, and the features that the forest sees."""
    if not text:
        return (0, 0, 0, 0, 0), (0.0,) * 6
    words = text.split(" ") if not any(c in text for c in BLANKS[1:]) else text.translate(_TO_BLANK).split(" ")
    words = [w for w in words if w]
    n = len(words)
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = repeated_words(words)
    upper = sum(map(str.isupper, words))
    ends = sum(w[-1] in "!*#$%&|<>" for w in words)
    d = max(n, 1)
    # shares of what is rare in good text; small texts are drawn towards 0, since chance moves theirs most
    features = (symbols / max(chars, 1), repeat / (d + 200), dup / (lines + 20), upper / (d + 5), text.count("!") / (d + 5), ends / (d + 5))
    return (n, chars, symbols, dup, repeat), features


_TO_BLANK = str.maketrans(dict.fromkeys(BLANKS, " "))


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1].astype(np.int64)
    _, back, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = np.concatenate((counts[back] > 1, [False, False]))
    return int((twice | np.roll(twice, 1) | np.roll(twice, 2)).sum())


def base_fails(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > 50 * n_words


def harmonic_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class Forest:
    """An isolation forest as flat arrays: every node has a feature, a cut and two children.

    Trees are grown over good rows, with cuts drawn from the range of all labelled rows.  Anomalies
    that come in clusters would otherwise hide each other; here they end early, in empty leaves.
    """

    def __init__(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.feature, self.cut, self.left, self.right, self.path = [], [], [], [], []
        take = min(tree_rows, len(rows))
        self.norm = harmonic_path(take) or 1.0
        self.depth = max(1, math.ceil(math.log2(max(take, 2))) + 4)
        self.roots = [self._grow(rows[rng.choice(len(rows), take, replace=False)], low, high, 0, rng) for _ in range(trees)]
        self.feature, self.left, self.right = (np.array(x, dtype=np.int64) for x in (self.feature, self.left, self.right))
        self.cut, self.path = np.array(self.cut), np.array(self.path)

    def _grow(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, rng: np.random.Generator) -> int:
        at = len(self.feature)
        for x, v in ((self.feature, 0), (self.cut, 0.0), (self.left, at), (self.right, at), (self.path, depth + harmonic_path(len(rows)))):
            x.append(v)
        open_ = np.flatnonzero(high > low)
        if len(rows) > 1 and depth < self.depth and len(open_):
            self.feature[at] = f = int(rng.choice(open_))
            self.cut[at] = c = float(rng.uniform(low[f], high[f]))
            under, over = high.copy(), low.copy()
            under[f] = over[f] = c
            self.left[at] = self._grow(rows[rows[:, f] < c], low, under, depth + 1, rng)
            self.right[at] = self._grow(rows[rows[:, f] >= c], over, high, depth + 1, rng)
        return at

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores in (0, 1); a leaf's children are itself, so all rows walk the same number of steps."""
        if not len(rows):
            return np.zeros(0)
        at = np.tile(np.array(self.roots), (len(rows), 1))
        who = np.arange(len(rows))[:, None]
        for _ in range(self.depth + 1):
            at = np.where(rows[who, self.feature[at]] < self.cut[at], self.left[at], self.right[at])
        return 2.0 ** (-self.path[at].mean(1) / self.norm)


def calibrated(scores: np.ndarray, good: np.ndarray, max_loss: float) -> float:
    """The threshold, losing at most ``max_loss`` of the good rows, that best parts good from bad."""
    if not len(scores) or good.all() or not good.any():
        return 2.0
    best, cut = 0.0, 2.0
    for t in np.unique(scores):
        lost, caught = (scores[good] >= t).mean(), (scores[~good] >= t).mean()
        if lost <= max_loss and caught - lost > best:
            best, cut = caught - lost, float(t)
    if cut < 1:  # halfway down to the next row that is kept
        below = scores[scores < cut]
        cut = (cut + float(below.max())) / 2 if len(below) else cut
    return cut


class Judge:
    """Base rules, then the forest's verdict."""

    def __init__(self, features: np.ndarray, good: np.ndarray, max_loss: float = MAX_LOSS):
        self.forest, self.threshold = None, 2.0
        if len(features) and good.any():
            self.forest = Forest(features[good], features.min(0), features.max(0))
            self.threshold = calibrated(self.forest.scores(features), good, max_loss)

    def __call__(self, found: list[tuple[tuple, tuple]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """base_failed, score, kept of each row."""
        failed = np.array([base_fails(c[0], c[4]) for c, _ in found], dtype=bool)
        score = self.forest.scores(np.array([f for _, f in found])) if self.forest and found else np.zeros(len(found))
        return failed, score, ~failed & (score < self.threshold)


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", quality: str = "quality", sample: int = SAMPLE, max_loss: float = MAX_LOSS) -> Judge:
    """A judge from at most ``sample`` labelled rows; rows that the base rules fail are left out."""
    chosen = labels.select(labels[label_id].alias("id"), labels[quality].alias("quality")).dropna().orderBy(F.xxhash64("id"), "id", "quality").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [statistics(x) for x in batch.column(0).to_pylist()]
            use = [k for k, (c, _) in enumerate(found) if not base_fails(c[0], c[4])]
            yield pa.RecordBatch.from_arrays([pa.array([found[k][1] for k in use], pa.list_(pa.float64())), batch.column(1).take(pa.array(use, pa.int64())), batch.column(2).take(pa.array(use, pa.int64()))], names=["features", "quality", "id"])

    # at most `sample` rows of two numbers are broadcast, and as many rows of a few come back: one for each id
    chosen = chosen.groupBy("id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
    joined = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text")).join(F.broadcast(chosen), "id").select("text", "quality", "id")
    found = joined.mapInArrow(run, f"features array<double>, quality int, id {docs.schema[doc_id].dataType.simpleString()}")
    rows = [r.row for r in found.groupBy("id").agg(F.min(F.struct("features", "quality")).alias("row")).collect()]
    rows.sort(key=lambda r: (r.features, r.quality))  # the fit doesn't hang on the order of tasks
    return Judge(np.array([r.features for r in rows], dtype=float), np.array([r.quality == 1 for r in rows], dtype=bool), max_loss)


def judge(docs: DataFrame, judged: Judge, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, the five counts, base_failed, score and kept."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [statistics(x) for x in batch.column(1).to_pylist()]
            failed, score, kept = judged(found)
            counts = [pa.array([c[k] for c, _ in found], pa.int64()) for k in range(len(STATS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(failed), pa.array(score), pa.array(kept)], names=["id", *STATS, "base_failed", "score", "kept"])

    frame = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    ddl = f"id {kind}, {', '.join(f'{c} bigint' for c in STATS)}, base_failed boolean, score double, kept boolean"
    return frame.mapInArrow(run, ddl).withColumnRenamed("id", doc_id)


def keep_good(docs: DataFrame, judged: Judge, *, text: str = "text") -> DataFrame:
    """The documents that the judge keeps, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = judged([statistics(x) for x in batch.column(text).to_pylist()])[2]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
