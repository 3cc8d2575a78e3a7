"""A language detector that is learned from the corpus, with shares of a text's languages.

Features are the three-letter windows of a text, hashed into 2^BITS buckets: ASCII letters in lower
case, every run of other ASCII characters one blank, all else as it is, with a blank at both ends.
The model is one grouped count by language and bucket; a bucket's weight for a language is 1,000
times the logarithm of how much more of the language than of an even spread falls there, rounded,
so that a text's score for a language is a sum of whole numbers and the same everywhere.  Its size
is bounded by the number of languages, whatever the corpus.

Detection cuts a text into spans of one language each: the best path over its words, where going
from one language to another costs ``SWITCH``.  A language's proportion is its spans' share of the
windows, its probability what its weights leave to the others over its own spans, with evidence of
at most ``EVIDENCE`` windows, and it is reliable from ``RELIABLE`` on.  The paths of many texts are
followed at the same time, in arrays.

Defined cases: a text without letters has no window and no prediction, like a null one; null
languages are left out of the model; an empty corpus gives an empty model, which predicts nothing;
ties go to the language that is first in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

BITS = 16
#: A bucket's share of a language is mixed with so much of an even spread.
FLOOR = 0.05
#: Weights are whole numbers, so many to a unit of the logarithm.
SCALE = 1000
SWITCH, EVIDENCE, RELIABLE, TOP = 15 * SCALE, 64, 0.7, 5
LANGUAGES = 512
#: Scores of windows by language that are in memory at a time (or one text's).
CHUNK = 1 << 21
#: Fixed multipliers of the hash.
FACTORS = (2654435761, 40503, 1)
PREDICTIONS = "array<struct<key: string, value: struct<cld3_language: string, probability: double, is_reliable: boolean, proportion: double>>>"


def letters(text: str) -> np.ndarray:
    """The code points that windows are taken from."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    codes = np.where((codes < 97) | ((codes > 122) & (codes < 128)), 32, codes)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == 32) & (codes[:-1] == 32)
    return codes[~again]


def windows(codes: np.ndarray) -> np.ndarray:
    """Each three-letter window's bucket."""
    n = max(len(codes) - 2, 0)
    mixed = sum(codes[k : k + n] * factor for k, factor in enumerate(FACTORS))
    return (mixed % (1 << 32)) >> (32 - BITS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            of = counts.setdefault(lang, np.zeros(1 << BITS, np.int64))
            of += np.bincount(windows(letters(text.as_py())), minlength=1 << BITS)
        for lang, of in counts.items():
            at = np.flatnonzero(of)
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(at)), pa.array(at), pa.array(of[at])], ["lang", "bucket", "n"])


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, weight) of the buckets that each language has."""
    rows = docs.select(docs[lang].cast("string").alias("lang"), docs[text].cast("string").alias("text")).dropna()
    counts = rows.mapInArrow(_counted, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = F.col("n") * F.lit(float(1 << BITS)) / F.col("total")
    weight = F.round(F.lit(SCALE) * F.log((share + F.lit(FLOOR)) / F.lit(1 + FLOOR))).cast("bigint")
    return counts.join(totals, "lang").select("lang", "bucket", weight.alias("weight"))


class Detector:
    """A model in arrays: weights by language and bucket."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    @classmethod
    def of(cls, model: DataFrame) -> Detector:
        """The model on the driver: at most 2^BITS rows for each of at most LANGUAGES languages."""
        languages = sorted((r.lang for r in model.select("lang").distinct().limit(LANGUAGES + 1).collect()), key=lambda x: x.encode())
        if len(languages) > LANGUAGES:
            raise ValueError(f"more than {LANGUAGES} languages")
        rows = model.toArrow()
        weights = np.full((1 << BITS, max(len(languages), 1)), round(SCALE * float(np.log(FLOOR / (1 + FLOOR)))), np.int32)
        if languages:
            column = pc.index_in(rows.column("lang"), value_set=pa.array(languages)).to_numpy()
            weights[rows.column("bucket").to_numpy(), column] = rows.column("weight").to_numpy()
        return cls(languages, weights)

    def score(self, text: str | None) -> np.ndarray:
        """The text's score for each language."""
        return self.weights[windows(letters(text or ""))].sum(axis=0, dtype=np.int64)

    def _words(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """For each word its scores by language and its number of windows; a window belongs to the word that it begins in."""
        codes = letters(text or "")
        at = windows(codes)
        if not len(at):
            return np.zeros((0, self.weights.shape[1]), np.int64), np.zeros(0, np.int64)
        starts = np.flatnonzero(codes[: len(at)] == 32)
        starts = starts if len(starts) and starts[0] == 0 else np.insert(starts, 0, 0)
        return np.add.reduceat(self.weights[at].astype(np.int64), starts, axis=0), np.diff(starts, append=len(at))

    def spans(self, texts: list[str | None]) -> list[list[tuple[str, float, bool, float]]]:
        """For each text (language, probability, reliable, proportion), the largest proportion first."""
        out: list[list[tuple[str, float, bool, float]]] = [[] for _ in texts]
        found = [self._words(t) for t in texts] if self.languages else []
        order = [k for k in sorted(range(len(found)), key=lambda k: -len(found[k][1])) if len(found[k][1])]
        if not order:
            return out
        lengths = np.array([len(found[k][1]) for k in order])
        scores = np.zeros((len(order), lengths[0], len(self.languages)), np.int64)
        sizes = np.zeros((len(order), lengths[0]), np.int64)
        for row, k in enumerate(order):
            scores[row, : lengths[row]], sizes[row, : lengths[row]] = found[k]
        path = self._paths(scores, lengths)
        for lang in range(len(self.languages)):
            mine = path == lang
            n = (sizes * mine).sum(axis=1)
            sums = (scores * mine[:, :, None]).sum(axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                scaled = sums / SCALE * np.minimum(1, EVIDENCE / np.maximum(n, 1))[:, None]
            probability = 1 / np.exp(scaled - scaled[:, lang : lang + 1]).sum(axis=1)
            for row in np.flatnonzero(n):
                p = float(probability[row])
                out[order[row]].append((self.languages[lang], p, p >= RELIABLE, float(n[row] / sizes[row].sum())))
        return [sorted(x, key=lambda e: -e[3])[:TOP] for x in out]

    def batch_spans(self, texts: list[str | None]) -> list[list[tuple[str, float, bool, float]]]:
        """``spans`` of any number of texts; those of like length share a group, as a group takes the steps of its longest."""
        order = sorted(range(len(texts)), key=lambda k: len(texts[k] or ""))
        out: list[list[tuple[str, float, bool, float]]] = [[] for _ in texts]
        places = iter(order)
        for group in _groups([texts[k] for k in order], len(self.languages)):
            for found, k in zip(self.spans(group), places, strict=False):
                out[k] = found
        return out

    @staticmethod
    def _paths(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best language of each word; texts are sorted by length, the longest first, and -1 stands behind their ends."""
        rows, steps, _ = scores.shape
        value = scores[:, 0].copy()
        stays, best = np.zeros(scores.shape, bool), np.zeros((rows, steps), np.int16)
        for t in range(1, steps):
            n = int(np.searchsorted(-lengths, -t, "left"))  # texts of more than t words
            top = value[:n].argmax(axis=1)
            switched = value[np.arange(n), top] - SWITCH
            stays[:n, t] = value[:n] >= switched[:, None]
            best[:n, t] = top
            value[:n] = np.maximum(value[:n], switched[:, None]) + scores[:n, t]
        path = np.full((rows, steps), -1, np.int16)
        at = value.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            n = int(np.searchsorted(-lengths, -t, "left"))
            path[:n, t] = at[:n]
            if t:
                at[:n] = np.where(stays[np.arange(n), t, at[:n]], at[:n], best[:n, t])
        return path


def _groups(texts: list[str | None], languages: int) -> Iterator[list[str | None]]:
    """Texts of at most CHUNK scores together, filled up to the longest of them, or one."""
    held: list[str | None] = []
    longest = 0
    for text in texts:
        n = len(text or "")
        if held and (len(held) + 1) * max(longest, n) * languages > CHUNK:
            yield held
            held, longest = [], 0
        held.append(text)
        longest = max(longest, n)
    if held:
        yield held


def detect(text: Column, detector: Detector, docs: DataFrame) -> Column:
    """A text's languages as a map, the five with the largest proportion; ``docs`` names the session."""
    sent = docs.sparkSession.sparkContext.broadcast(detector)

    @arrow_udf(PREDICTIONS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            rows = sent.value.batch_spans(texts)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]), pa.int32())
            flat = [e for r in rows for e in r]
            keys, probabilities, reliable, proportions = ([e[k] for e in flat] for k in range(4))
            value = pa.StructArray.from_arrays([pa.array(keys, pa.string()), pa.array(probabilities, pa.float64()), pa.array(reliable, pa.bool_()), pa.array(proportions, pa.float64())], ["cld3_language", "probability", "is_reliable", "proportion"])
            yield pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(keys, pa.string()), value], ["key", "value"]))

    return F.map_from_entries(found(text))


def scored(docs: DataFrame, detector: Detector, *, key: str, text: str = "text") -> DataFrame:
    """(key, lang, score) for each text and language of the model."""
    sent = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sent.value.languages
        for batch in batches:
            if batch.num_rows and names:
                scores = np.concatenate([sent.value.score(t) for t in batch.column(1).to_pylist()])
                keys = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), len(names))))
                yield pa.RecordBatch.from_arrays([keys, pa.array(names * batch.num_rows, pa.string()), pa.array(scores)], [key, "lang", "score"])

    rows = docs.select(key, docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, lang string, score bigint")
