"""Rule statistics against brute force; the forest on labelled rows that it has not seen."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from glossa.llm import quality as ql
from glossa.llm.queries import op3_quality_rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for i in (k, k + 1, k + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "c ", "\n", "\t", "#", "é", "\xa0", "a b c "]) for _ in range(rng.randint(0, 60)))
        assert ql.statistics(text)[0] == brute(text)
    assert ql.statistics(None)[0] == (0, 0, 0, 0, 0)


def test_forest_isolates_what_lies_apart():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 0.05, (500, 3))
    bad = np.concatenate([rng.normal(1, 0.05, (30, 3)), rng.normal(-1, 0.05, (30, 3))])
    rows, labels = np.concatenate([good, bad]), np.array([True] * 500 + [False] * 60)
    judge = ql.Judge(rows, labels)
    fresh = judge.forest.scores(np.concatenate([rng.normal(0, 0.05, (300, 3)), rng.normal(1, 0.05, (50, 3))]))
    assert (fresh[:300] < judge.threshold).mean() > 0.98 and (fresh[300:] >= judge.threshold).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = ql.fit(docs, labels.filter("doc_id % 2 = 0"))
    rest = ql.judge(docs, judged).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed").collect()
    good, bad = [r.kept for r in rest if r.quality == 1], [r.kept for r in rest if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_query_and_weird_rows(spark, sf_dir, weird):
    got = op3_quality_rules(spark, sf_dir)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in got.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    none = ql.fit(weird, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert ql.judge(weird, none).count() == 9 and not any(r.kept for r in ql.judge(weird, none).collect())
    assert ql.keep_good(weird, none).columns == weird.columns and ql.keep_good(weird, none).count() == 0
    assert ql.judge(weird.limit(0), none).count() == 0


def plain_score(forest, row):
    """The mean depth of a row over all trees, walked node by node."""
    total = 0.0
    for node in forest.roots:
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] < forest.cut[node] else forest.right[node]
        total += forest.path[node]
    return 2 ** (-total / len(forest.roots) / forest.norm)


def test_path_lengths_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    rows = rng.random((60, 6)) ** 2
    forest = ql.Forest(rows, rows.min(0) - 0.1, rows.max(0) + 0.5, trees=20, tree_rows=60)
    other = rng.random((40, 6)) * 1.4
    assert forest.scores(other) == pytest.approx([plain_score(forest, r) for r in other])
    for root in forest.roots:  # a leaf's path is its depth and the mean path among its rows
        seen = {}
        for row in rows:
            node, depth = root, 0
            while forest.left[node] != node:
                node, depth = (forest.left if row[forest.feature[node]] < forest.cut[node] else forest.right)[node], depth + 1
            seen.setdefault((node, depth), []).append(row)
        for (node, depth), held in seen.items():
            n = len(held)
            mean = 0 if n == 1 else 1 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
            assert forest.path[node] == pytest.approx(depth + mean)


def test_verdicts_equal_a_plain_version(spark, sf_dir):
    """kept: no base rule fails, and the plain walk stays under the calibrated threshold."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    judged = ql.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in ql.judge(docs, judged).collect():
        counts, features = ql.statistics(texts[r.doc_id])
        failed = counts[0] < 50 or 2 * counts[4] > counts[0]
        assert (r.base_failed, r.kept) == (failed, not failed and plain_score(judged.forest, features) < judged.threshold)
