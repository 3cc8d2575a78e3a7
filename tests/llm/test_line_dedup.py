"""Line dedup against a brute-force version."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from glossa.llm import linededup
from glossa.llm.linededup import dedup_lines


def tokens_of(line, words=5):
    w = re.findall("[^ \t\x0b\x0c\r]+", line)
    return frozenset(zip(*(w[k:] for k in range(words)), strict=False)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute(rows, similarity=0.8, words=5):
    """Texts after dedup: every line is held against every earlier one."""
    kept, seen = {}, []
    order = sorted({(d is not None, d, t) for d, t in rows if t is not None}, key=lambda r: (r[0], r[1] or 0))
    for _, doc, text in order:
        out = []
        for line in text.split("\n"):
            tokens = tokens_of(line, words)
            if tokens:
                dup = any(len(tokens & s) >= similarity * len(tokens | s) - 1e-9 for s in seen)
                seen.append(tokens)
                if dup:
                    continue
            out.append(line)
        kept[doc, text] = "\n".join(out)
    return sorted(((d, kept.get((d, t))) for d, t in rows), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["é", "a", "", "\t"]
    base = [[rng.choice(words) for _ in range(rng.randint(0, 40))] for _ in range(25)]
    rows = []
    for doc in range(n):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2])):
                if line:
                    line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line))
        rows.append((doc * 7 % n, "\n".join(lines)))
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 1000), (2, 2), (3, 6)])
def test_equals_brute_force(spark, seed, hot):
    rows = corpus(seed)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=hot).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize(("words", "similarity", "hot"), [(1, 0.8, 1000), (1, 0.8, 3), (1, 0.6, 5), (2, 0.8, 1000), (3, 0.9, 4)])
def test_other_tokens_equal_brute_force(spark, words, similarity, hot):
    """Words as tokens, or shorter shingles, and other thresholds."""
    rows = corpus(words * 10 + hot, n=40)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), words=words, similarity=similarity, hot=hot).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute(rows, similarity, words)


def test_near_copies_settle_on_representatives(spark):
    base = [f"t{k}" for k in range(40)]
    rows = [(d, " ".join([*base, f"x{d}", f"y{d}"])) for d in range(40)]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=5).collect()}
    assert got == {d: t if d == 0 else "" for d, t in rows}


def test_edge_cases(spark):
    line = "one two three four five six"
    rows = [(1, line, "a", 7), (1, line, "b", 8), (None, line, "c", 9), (2, None, "d", 1), (3, "", "e", 2), (4, f"short\n{line}\nshort\n\n \n\n", "f", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, holes string, `Version` int")
    got = sorted((r.holes, r.text, r["Version"]) for r in dedup_lines(docs).collect() if r.text is not None)
    assert got == [("a", "", 7), ("b", "", 8), ("c", line, 9), ("e", "", 2), ("f", "short\n\n \n\n", 3)]
    assert dedup_lines(docs).columns == docs.columns
    assert dedup_lines(docs.limit(0)).count() == 0


def test_weird_rows_and_other_ids(spark, weird):
    got = dedup_lines(weird)
    assert got.columns == weird.columns and got.count() == weird.count()
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] is None and texts[3] == " \n\t " and texts[5] == "a " * 40_000 and texts[7] is not None
    rows = [("b", "read more\nx"), ("a", "Read more\nread more"), (None, "x"), ("b", "read more\ny")]
    named = spark.createDataFrame(rows, "doc_id string, text string")
    assert sorted(r.text for r in dedup_lines(named).collect()) == ["", "Read more\nread more", "x", "y"]


def test_short_lines(spark):
    """Equal lines go whatever their length; words are what any white space separates."""
    wide = "a\tb\tc\td\te\tf\tg"
    rows = [(1, "Read more\n\n日本語の行\none two"), (2, "Read  more\n\n日本語の行\nRead more\nother"), (3, wide), (4, wide.replace("\t", " ") + "\nlast"), (5, "alpha beta gamma delta"), (6, " alpha beta gamma delta\nalpha beta gamma")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.length("text"))
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == {1: rows[0][1], 2: "\nother", 3: wide, 4: "last", 5: rows[4][1], 6: "alpha beta gamma"} == dict(brute(rows))


def test_nothing_is_left_behind(spark):
    """Of the intermediate tables only those stay that the result reads."""
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    dedup_lines(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id bigint, text string")).collect()
    assert len(set(folder.iterdir()) - before) == 2


@pytest.mark.parametrize("sample", [1, 8, 10**9])
def test_rarity_of_a_sample_gives_the_same_lines(spark, monkeypatch, sample):
    """Rarity is only an order: with all, some or no texts counted the result is the brute-force one."""
    monkeypatch.setattr(linededup.rarity_ranks, "__defaults__", (sample,))
    rows = corpus(5)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=6).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute(rows)


def test_tokens_are_sorted_in_generated_code(spark):
    """Beside a lambda, a sort would be interpreted on boxed numbers."""
    lines = spark.createDataFrame([(1, "a b c d e f a b c d e f"), (2, "a b c d")], "rid bigint, line string")
    ranks = F.split(F.lit(",".join(["0"] * (1 << linededup.BUCKET_BITS))), ",").cast("array<bigint>")
    sets = linededup.token_sets(linededup.shingles(lines, "rid", words=5), "rid", ranks=ranks)
    assert {r.rid: (len(r.ids), r.ids == sorted(set(r.ids))) for r in sets.collect()} == {1: (6, True), 2: (0, True)}
    plan = sets._jdf.queryExecution().executedPlan().toString()
    generators = [line for line in plan.split("\n") if "Generate explode(" in line]
    assert generators and not any("lambda" in g and ("sort_array" in g or "array_distinct" in g) for g in generators)
    assert any("sort_array" in g for g in generators)


def test_texts_are_not_shuffled(spark):
    """The lines that go are few: they are broadcast to the texts, whatever Spark's own threshold is."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = dedup_lines(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("hot", [1000, 4])
def test_tables_too_large_for_a_broadcast(spark, monkeypatch, hot):
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", 0)
    rows = corpus(6)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=hot).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute(rows)


def test_pairs_whose_prefixes_differ_too_much_are_not_verified(spark):
    """Of two lines of 20 tokens five are in a prefix; at 0.8 they share 18, so three of the five at least."""
    sets = {1: range(20), 2: [*range(3), *range(23, 40)], 3: [0, *range(51, 70)]}
    rows = [(t, k, 20 << 32 | sorted(v)[4], at + 1) for k, v in sets.items() for at, t in enumerate(sorted(v)[:5])]
    cold = spark.createDataFrame(rows, "token bigint, key bigint, size bigint, pos int")
    assert [tuple(r) for r in linededup._met(cold.withColumn("hot", F.lit(0)), 0.8).collect()] == [(1, 2)]
    assert {tuple(r) for r in linededup._met(cold.withColumn("hot", F.lit(2)), 0.8).collect()} == {(1, 2), (1, 3), (2, 3)}


def test_near_copies_that_share_long_lists(spark):
    """Lines whose first shared tokens are rare and whose others are in many lines."""
    rng, common = random.Random(3), [[f"c{k}x{j}" for j in range(12)] for k in range(6)]
    rows = []
    for d in range(120):
        own = [f"o{d % 40}x{j}" for j in range(30)]
        parts = [own, *[common[k] for k in sorted(rng.sample(range(6), 3))]]
        line = [w for part in parts for w in part]
        line[rng.randrange(len(line))] = f"e{d}"
        rows.append((d, " ".join(line)))
    for hot in (4, 12, 30):
        got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=hot).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute(rows)


def test_lines_of_one_token_in_a_hot_list(spark):
    """They match each other by their only token, though the list's two earliest lines have more."""
    lines = [(1, [7, 21, 22, 23]), (2, [7, 31, 32, 33]), (3, [7]), (4, [7])]
    rows = spark.createDataFrame([(7, bytes([k]), len(ids), 1, k) for k, ids in lines], "token bigint, rid binary, n int, pos int, first bigint")
    sets = spark.createDataFrame([(bytes([k]), k, ids) for k, ids in lines], "rid binary, first bigint, ids array<bigint>")
    with linededup.Scratch(spark) as own:
        assert [bytes(r.later) for r in linededup._hot_matches(rows, sets, 0.8, own).collect()] == [b"\x04"]


def test_tokens_shared_too_far_back_make_no_pairs(spark):
    """Lines of 20 tokens that match share one of their first three; those that share a token of a long list before are found there."""
    sets = {1: [0, 1, 2, 3, 4], 2: [-4, -3, -2, -1, 4], 3: [0, 1, 2, 3, 4]}
    rows = [(t, k, 20 << 32 | 4, at + 1, 2) for k, v in sets.items() for at, t in enumerate(v)]
    cold = spark.createDataFrame(rows, "token bigint, key bigint, size bigint, pos int, hot int")
    assert [tuple(r) for r in linededup._met(cold, 0.8).collect()] == [(1, 3)]


@pytest.mark.parametrize("long", [0, 5, 1000])
def test_long_lists_equal_brute_force(spark, monkeypatch, long):
    """What representatives leave is joined by one token in shorter lists and by two in longer ones."""
    monkeypatch.setattr(linededup, "LONG", long)
    rows = corpus(7)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=3).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute(rows)
