"""The learned detector: weights and paths against plain loops, held-out accuracy, and shares of mixed texts."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.functions import langmodel as lm


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def detector(docs):
    return lm.Detector.of(lm.fit(docs.filter("doc_id % 5 <> 0")))


def plain_windows(text):
    kept = " "
    for c in f"{text} ":
        c = c.lower() if "A" <= c <= "Z" else c
        c = c if "a" <= c <= "z" or ord(c) > 127 else " "
        kept += "" if c == kept[-1] == " " else c
    return [(ord(a) * 2654435761 + ord(b) * 40503 + ord(c)) % 2**32 >> 16 for a, b, c in zip(kept, kept[1:], kept[2:], strict=False)]


@pytest.mark.parametrize("text", ["", " ", "a", "A-b  c", "été İ 日本\U0001f600!", "x" * 300])
def test_windows(text):
    assert lm.windows(lm.letters(text)).tolist() == plain_windows(text)


def test_weights(spark):
    rows = [("ab ab", "x"), ("abc", "x"), ("zz", "y"), (None, "y"), ("ab", None)]
    got = {(r.lang, r.bucket): r.weight for r in lm.fit(spark.createDataFrame(rows, "text string, lang string")).collect()}
    counts = {"x": Counter(plain_windows("ab ab") + plain_windows("abc")), "y": Counter(plain_windows("zz"))}
    assert got == {(g, b): round(1000 * math.log((n * 65536 / sum(c.values()) + 0.05) / 1.05)) for g, c in counts.items() for b, n in c.items()}


def test_paths_are_the_best_of_all():
    rng = np.random.default_rng(0)
    lengths = np.array([5, 4, 4, 1])
    scores = rng.integers(-20_000, 20_000, (4, 5, 3))
    path = lm.Detector._paths(scores, lengths)
    for row, n in enumerate(lengths):
        worth = {p: sum(scores[row, t, p[t]] for t in range(n)) - lm.SWITCH * sum(a != b for a, b in itertools.pairwise(p)) for p in itertools.product(range(3), repeat=int(n))}
        assert worth[tuple(path[row, :n].tolist())] == max(worth.values()) and (path[row, n:] == -1).all()


def test_held_out_accuracy(docs, detector):
    held = docs.filter("doc_id % 5 = 0")
    best = held.select("lang", lm.detect(F.col("text"), detector, docs).alias("p")).select("lang", F.array_sort(F.transform(F.map_entries("p"), lambda e: F.struct(-e["value"]["proportion"], e["key"])))[0]["key"].alias("best")).collect()
    assert sum(r.lang == r.best for r in best) >= 0.98 * len(best) and len(best) == 200


def test_mixed_texts_give_their_shares(spark, docs, detector):
    rows = [(r.lang, r.text) for r in docs.filter("doc_id % 5 = 0 AND length(text) BETWEEN 600 AND 4000").collect()]
    rng = random.Random(0)
    mixed = []
    while len(mixed) < 60:
        (a, x), (b, y) = rng.sample(rows, 2)
        if a != b:
            x, y = x[: rng.randint(300, 600)], y[: rng.randint(300, 600)]
            mixed.append((a, b, len(x) / (len(x) + len(y)), f"{x} {y}"))
    frame = spark.createDataFrame(mixed, "a string, b string, share double, text string")
    got = frame.select("a", "b", "share", lm.detect(F.col("text"), detector, frame).alias("p")).collect()
    near = [set(r.p) == {r.a, r.b} and abs(r.p[r.a].proportion - r.share) < 0.06 and r.p[r.a].probability > 0.9 for r in got]
    assert sum(near) >= 0.9 * len(near)  # some of the texts quote another language themselves


def test_texts_without_letters_and_empty_models(spark, detector):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "12 -- 34"), (4, "the " * 30_000)], "k int, text string")
    got = {r.k: r.p for r in frame.select("k", lm.detect(F.col("text"), detector, frame).alias("p")).collect()}
    assert got[1] == got[2] == got[3] == {} and list(got[4]) == ["en"] and got[4]["en"].proportion == 1.0
    none = lm.Detector.of(lm.fit(spark.createDataFrame([], "text string, lang string")))
    assert [r.p for r in frame.select(lm.detect(F.col("text"), none, frame).alias("p")).collect()] == [{}] * 4
    assert lm.scored(frame, none, key="k").count() == 0


def test_long_texts_do_not_lengthen_the_groups_of_short_ones(detector, monkeypatch):
    """The steps of all groups together stay near those of the long texts, and every text keeps its own result."""
    rng = random.Random(1)
    texts = [None, "", *(" ".join(rng.choice(["the house", "la maison", "das Haus", "la casa"]) for _ in range(4000 if k % 20 == 0 else rng.randint(1, 40))) for k in range(300))]
    steps = []
    paths = lm.Detector._paths
    monkeypatch.setattr(lm.Detector, "_paths", staticmethod(lambda scores, lengths: steps.append(scores.shape[1]) or paths(scores, lengths)))
    assert detector.batch_spans(texts) == [detector.spans([t])[0] for t in texts]
    alone = sum(steps[-300:])
    assert sum(steps[:-300]) < alone / 4
