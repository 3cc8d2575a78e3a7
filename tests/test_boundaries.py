"""Learned sentence boundaries: counts and ratios against plain versions, and planted abbreviations."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from glossa.functions.segment import segment_plain
from glossa.operators import boundaries as bd


def planted(n=250, seed=0):
    """Texts with known sentences: abbreviations (always with a full stop), initials and numbers inside them."""
    rng = random.Random(seed)
    nouns = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(80)]
    short, starts = ["dr.", "inc.", "approx.", "e.g."], ["The", "But", "However"]
    texts = []
    for _ in range(n):
        sentences = []
        for _ in range(rng.randint(2, 6)):
            words = [rng.choice(starts) if rng.random() < 0.7 else rng.choice(nouns).capitalize()]
            for _ in range(rng.randint(4, 10)):
                x = rng.random()
                words += [rng.choice(short), rng.choice(nouns)] if x < 0.12 else ["J.", rng.choice(nouns).capitalize()] if x < 0.15 else ["3.", rng.choice(nouns)] if x < 0.18 else [rng.choice(nouns)]
            sentences.append(" ".join(words) + rng.choice([".", ".", ".", "!", "?"]))
        texts.append(sentences)
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, " ".join(s), "en", "w") for k, s in enumerate(planted())], "id int, text string, lang string, words string").repartition(3)


@pytest.fixture(scope="module")
def learned(docs):
    return bd.learn(docs)


def test_counts_and_scores(learned):
    stops, plain = Counter(), Counter()
    for sentences in planted():
        for w in " ".join(sentences).split():
            kind = "##" if re.fullmatch(r"\d\.", w) else re.sub(r"[.!?]+$", "", w.lower())
            (stops if w.endswith(".") else plain)[kind] += 1
    n, all_stops = sum(stops.values()) + sum(plain.values()), sum(stops.values())
    rows = {r.type: r for r in learned.words.collect()}
    assert {t: (r.stops, r.plain) for t, r in rows.items()} == {t: (stops[t], plain[t]) for t in {*stops, *plain}}
    for t in ("dr", "e.g", "approx"):
        p, a, dots = all_stops / n, stops[t], t.count(".")
        score = -2 * (a * math.log(p) - a * math.log(0.99)) * math.exp(dots - len(t)) * (dots + 1)
        assert rows[t].score == pytest.approx(score) and score > bd.ABBREVIATION
    assert rows["the"].starter > bd.STARTER


def test_planted_abbreviations_do_not_end_sentences(docs, learned):
    got = {r.id: r.sentences for r in bd.with_sentences(docs, learned, key="id").collect()}
    right = wrong = missed = plain_wrong = 0
    for k, sentences in enumerate(planted()):
        ends = lambda parts: {sum(len(p.split()) for p in parts[: j + 1]) for j in range(len(parts))}
        gold, found = ends(sentences), ends(got[k])
        right, wrong, missed = right + len(gold & found), wrong + len(found - gold), missed + len(gold - found)
        plain_wrong += len(ends(segment_plain(" ".join(sentences))) - gold)
    assert wrong < plain_wrong / 10 and 2 * right / (2 * right + wrong + missed) > 0.98


def test_defined_cases(spark, learned):
    rows = [(1, None, "en", "w"), (2, " \n ", "en", "w"), (3, "One", None, "w"), (3, "One", None, "w"), (None, "A b. C d", "xx", "w"), (5, 'He said "no." Then   dr. who left.', "en", "w"), (6, "Yes. " * 30_000, "en", "w")]
    frame = spark.createDataFrame(rows, "id int, text string, lang string, words string")
    out = bd.with_sentences(frame, learned, key="id")
    assert out.columns == [*frame.columns, "sentences"]
    got = [(r.id, r.sentences) for r in out.collect()]
    assert sorted((k, s) for k, s in got if k and k < 6) == [(1, []), (2, []), (3, ["One"]), (3, ["One"]), (5, ['He said "no."', "Then dr. who left."])]
    assert dict(got)[None] == ["A b.", "C d"] and len(dict(got)[6]) == 30_000
    none = bd.learn(frame.limit(0))
    assert bd.with_sentences(frame.limit(0), none, key="id").count() == 0


def test_tables_beyond_the_bound_are_shuffled(docs, learned, monkeypatch):
    want = sorted((r.id, r["at"]) for r in bd.boundaries(docs, learned, key="id").collect())
    monkeypatch.setattr(bd, "BROADCAST_ROWS", 0)
    assert sorted((r.id, r["at"]) for r in bd.boundaries(docs, learned, key="id").collect()) == want
    assert docs.filter(F.col("id") < 0).count() == 0


def test_classes_are_those_of_the_columns(spark):
    """The class that a task gives a token is that of the patterns on its columns; texts are not exploded into rows of tokens."""
    rng = random.Random(3)
    odd = ["", ".", "..", "…", "?!", "a.", "abc.", "abcd.", '"abcd."', "12.", "1,2.", "x12.", "12. ", "abcd. ", "abcd!\x85", "ſ.", "İst.", "İsta.", "٣.", "³.", "##.", "(3.)", "«e.g.»", "a\xa0b.", "--1.", "1.a.", "\x00.", "\U0001f600."]
    odd += ["".join(rng.choice("aÉ1.,!?…\"')»“ \x85:-/٣İ") for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    frame = bd._described(spark.createDataFrame([(w,) for w in odd], "w string"), "w", "")
    sure = (F.col("mark") == "end") | ((F.col("mark") == "stop") & (F.length("type") > 3) & (F.col("type") != bd.NUMBER))
    want = frame.select("w", F.when(sure, bd.SURE).when(F.col("mark") == "stop", bd.DOUBTFUL).otherwise(bd.NONE).alias("class"))
    assert [(r.w, r["class"]) for r in want.collect() if bd._class(r.w) != r["class"]] == []
    docs = spark.createDataFrame([(1, "Dr. A b. C", "en")], "id int, text string, lang string")
    assert "Generate" not in bd.boundaries(docs, bd.learn(docs), key="id")._jdf.queryExecution().executedPlan().toString()


def test_words_alone(docs, learned):
    """What needs no pairs doesn't count them."""
    assert sorted(map(str, bd.learn_words(docs).collect())) == sorted(map(str, learned.words.collect()))
