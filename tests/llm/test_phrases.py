"""Phrase mining against plain counts, its parts against plain versions, and its defined cases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from glossa.llm import phrases


def plain(rows, least=3, longest=4, contained=80, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, w), a in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                longer[lang, w[i : i + size]] = max(longer[lang, w[i : i + size]], a)
    out = {}
    for (lang, w), a in candidates.items():
        if 100 * longer[lang, w] < contained * a:
            score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -score) for lang, rows in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    words = ["New", "york", "city", "é", "日本", "a\x01", "a", "x\x00y", "İ", "of", "the"] + [f"w{k}" for k in range(30)]
    rows = []
    for _ in range(n):
        parts = ["new york city" if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randint(0, 30))]
        rows.append(("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "!", "\x0b"]) for w in parts), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", None), (" . ", "fr"), ("buy " * 3000, "en"), rows[0], rows[0]]


def frame(spark, rows):
    return spark.createDataFrame([(t, g, "x", "y", "z") for t, g in rows], "text string, lang string, word string, key string, phrase string").repartition(4)


def mined(docs, **options):
    return sorted(tuple(r) for r in phrases.mine(docs, least=3, **options).collect())


def test_equals_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 200)
    monkeypatch.setattr(phrases, "CHUNK_IDS", 50)
    rows = corpus()
    assert mined(frame(spark, rows)) == plain(rows)


def test_long_dictionaries_and_tables_and_a_full_bit_table(spark):
    rows = corpus(seed=1)
    assert mined(frame(spark, rows), block=7, broadcast_rows=0, bits=5) == plain(rows)


def test_other_lengths_and_the_first_of_each_language(spark):
    rows = corpus(seed=2)
    assert mined(frame(spark, rows), longest=3, top=5, contained=60) == plain(rows, longest=3, top=5, contained=60)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("one two", "en")]])
def test_tables_without_phrases(spark, rows):
    assert mined(frame(spark, rows)) == []


def test_words_pieces_and_counts_of_texts():
    texts = pa.array(["A b,c", None, "", "İ\tD. e"]).slice(0)
    words, pieces, counts = phrases.words_of(texts)
    assert words.to_pylist() == ["a", "b", "c", "İ", "d", "e"] and counts.tolist() == [3, 0, 0, 3]
    assert pieces[0] == pieces[1] != pieces[2] and pieces[3] == pieces[4] != pieces[5] and pieces[2] != pieces[3]


def test_runs_break_at_unknown_words_and_pieces():
    ids = np.array([1, 2, 0, 3, 4, 5, 6, 0, 7], np.uint32)
    assert phrases._runs(ids, np.array([0, 0, 0, 0, 0, 1, 1, 1, 1])).tolist() == [1, 2, 0, 3, 4, 0, 5, 6, 0]


def test_radix_order_is_the_order_of_the_keys():
    keys = np.random.default_rng(0).integers(0, 2**32, (5000, 3), dtype=np.uint32)
    keys[:2000] %= 5
    assert keys[phrases.radix_order(keys)].tolist() == sorted(keys.tolist())


def test_runs_go_on_over_batches():
    keys = np.array([[1, 1], [1, 2], [1, 2], [3, 0]], np.uint32)
    batches = [phrases._packed(keys[i : i + 1], np.array([2])) for i in range(4)]
    out = list(phrases._run_lengths(2, 3)(iter(batches)))
    assert [(phrases._unpacked(b.column("key"), 2).tolist(), b.column("f").to_pylist()) for b in out] == [([[1, 2]], [4])]
