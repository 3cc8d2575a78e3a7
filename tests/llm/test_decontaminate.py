"""Decontamination against a brute-force version."""

import random

from pyspark.sql import functions as F

from glossa.llm import queries
from glossa.llm.common import alnum_words
from glossa.llm.decontaminate import find_contamination, remove_contaminated


def brute(docs, items, window=10):
    out = {}
    for doc, text in docs:
        words = alnum_words(text)
        hit, found = set(), set()
        for item, passage in items:
            w = alnum_words(passage)
            n = min(window, len(w))
            for k in range(len(w) - n + 1 if w else 0):
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == w[k : k + n]:
                        hit |= set(range(at, at + n))
                        found.add(item)
        out[doc] = (len(words), len(hit), sorted({str(i) for i in found if i is not None}))
    return out


def fixture(seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["Ünder", "x1"]
    say = lambda n: " ".join(rng.choice(words) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(k, say(rng.choice([0, 3, 9, 10, 11, 30]))) for k in range(12)] + [(3, say(12)), (None, say(14)), (20, None)]
    docs = []
    for d in range(40):
        parts = [say(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 2)):
            passage = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, 3)
            parts += [" ".join(passage[a:]), say(rng.randint(0, 3))]
        docs.append((d, " ".join(parts)))
    return docs, items


def check(spark, **options):
    docs, items = fixture()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = find_contamination(frame, bench, **options).collect()
    want = brute(docs, items)
    assert {r.doc_id: (r.n_words, sum(s.last - s.first for s in r.spans), r.item_ids) for r in got} == want
    clean = {r.doc_id for r in remove_contaminated(frame, bench, **({"block_words": options["block_words"]} if "block_words" in options else {})).collect()}
    assert clean == {d for d, (_, n, _) in want.items() if n == 0}
    return got, dict(docs), dict(items)


def test_equals_brute_force(spark):
    check(spark)


def test_blocks_of_the_benchmark_give_the_same(spark):
    check(spark, block_words=25)


def test_shards_of_any_size_give_the_same(spark, monkeypatch):
    monkeypatch.setattr("glossa.llm.decontaminate.SHARD_WORDS", 40)
    monkeypatch.setattr("glossa.llm.decontaminate.SHARD_ROWS", 3)
    import pyarrow as pa

    from glossa.llm import decontaminate as dc

    docs, items = fixture(8)
    tests = next(dc.test_blocks(spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text", 10, 10**6))
    batch = pa.RecordBatch.from_pydict({"id": [d for d, _ in docs], "text": [t for _, t in docs]})
    found, sizes = [], []
    for part, words in dc.shards(iter([batch]), "text"):
        sizes.append(part.num_rows)
        found += [(len(w), sum(b - a for a, b in dc.united(s)), sorted({tests.ids[n] for n in o} - {None})) for w, (s, o, _) in zip(words, dc._shard(words, tests, True), strict=True)]
    assert dict(zip([d for d, _ in docs], found, strict=True)) == brute(docs, items) and len(sizes) > 5


def test_an_empty_benchmark_finds_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    got = find_contamination(docs, spark.createDataFrame([], "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.spans, r.item_ids, r.matches) for r in got) == [(1, 3, [], [], []), (2, 0, [], [], [])]


def test_longest_matches_are_verbatim_and_maximal(spark):
    got, docs, items = check(spark)
    seen = 0
    for r in got:
        words = alnum_words(docs[r.doc_id])
        for m in r.matches:
            if m.item_id is None or m.item_id == "3":
                continue
            item = alnum_words(items[int(m.item_id)])
            a, b, n = m.item_word, m.doc_word, m.n_words
            assert item[a : a + n] == words[b : b + n]
            assert a + n == len(item) or b + n == len(words) or item[a + n] != words[b + n]
            seen += 1
    assert seen


def test_weird_rows(spark, weird):
    bench = spark.createDataFrame([(1, "one two three"), (2, None)], "item_id int, text string")
    got = find_contamination(weird, bench).collect()
    assert sorted((r.doc_id or 0, len(r.spans)) for r in got) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (5, 0), (6, 0), (7, 0)]
    left = remove_contaminated(weird, bench)
    assert left.columns == weird.columns and left.count() == 7
    assert find_contamination(weird.limit(0), bench).count() == 0
    assert remove_contaminated(weird, bench.limit(0)).count() == 9


def test_query(spark, sf_dir):
    got = queries.op1_decontamination(spark, sf_dir)
    assert got.count() == 200 and got.filter("contaminated AND n_hit < 3").count() == 0
    assert got.filter(F.col("contaminated") != (F.col("n_items") > 0)).count() == 0
