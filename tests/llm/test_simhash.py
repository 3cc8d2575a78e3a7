"""SimHash against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from glossa.llm import simhash as sh
from glossa.llm.common import Scratch
from glossa.llm.components import components
from glossa.llm.queries import op5_simhash


def naive_print(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split() if text else []
    words = [w for w in words if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_prints_equal_naive_ones():
    for text in ("", "one", "One two", "a b c d e A B c", "é ä x " * 30, "w " * 500):
        for k in (3, 5):
            assert sh.fingerprint(text, k) == naive_print(text, k)
    assert sh.fingerprint(None, 3) == 0


def test_links_equal_all_pairs(spark):
    rng = random.Random(4)
    prints = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(rng.randint(0, 12)):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            prints.add(x)
    signed = [sh._signed(p) for p in prints]
    want = roots([(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2], signed)
    with Scratch(spark) as own:
        found = {r.node: r.root for r in components(sh.close_links(spark.createDataFrame([(p,) for p in signed], "print bigint"), own), own).collect()}
    assert {p: found.get(p, p) for p in signed} == want


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    with Scratch(spark) as own:
        got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u bigint, v bigint"), own).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = {r.doc_id: naive_print(r.text, 3) for r in docs}
    want = roots([(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2], prints)
    got = op5_simhash(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{p:016x}", want[d]) for d, p in prints.items()}


def test_weird_rows(spark, weird):
    got = sh.near_duplicates(weird).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 5), (6, 6), (7, 7)]
    left = sh.one_of_each(weird)
    assert left.columns == weird.columns
    assert sorted(r.doc_id or 0 for r in left.select(F.col("doc_id")).collect()) == [0, 1, 4, 5, 6, 7]
    assert sh.near_duplicates(weird.limit(0)).count() == 0


def test_one_of_each_component_stays_whatever_the_ids(spark):
    say = lambda seed: " ".join(random.Random(seed).choices([f"w{k}" for k in range(500)], k=60))
    rows = [(None, say(1)), (None, say(2)), (None, say(2)), (7, say(3)), (7, say(4)), (None, say(4)), (8, say(5)), (8, say(5)), (9, say(5))]
    left = sh.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(0, say(1)), (0, say(2)), (7, say(3)), (7, say(4)), (8, say(5))])


@pytest.mark.parametrize("small", [9, 2])
def test_one_of_each_finds_edited_copies(spark, monkeypatch, small):
    """With two texts at most under a key of all pairs, larger groups go the way of heads and second keys."""
    monkeypatch.setattr(sh.similar_links, "__kwdefaults__", {"small": small})
    rng = random.Random(9)
    words = [f"w{k}" for k in range(3000)]
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(60, 400))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = list(base)
            for at in rng.sample(range(len(copy)), rng.randint(1, max(1, len(copy) // 30))):
                copy[at] = rng.choice(words)
            texts.append(" ".join(copy))
    grams = [frozenset(zip(*(t.split()[k:] for k in range(5)), strict=False)) for t in texts]
    prints = [naive_print(t, 5) for t in texts]
    ids = range(len(texts))
    near = {(a, b) for a in ids for b in ids if a < b and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])}
    close = {(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2}
    assert len(near - close) > 10
    left = sh.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.doc_id for r in left.collect()} == set(roots(near | close, ids).values())


def test_recall_of_minhash_keys():
    """Of pairs with a similarity of just over 0.8 nearly all share a key; of those at 0.4 few do."""
    rng = np.random.default_rng(7)
    met = {0.8: 0, 0.4: 0}
    for similarity in met:
        for _ in range(300):
            n = 400
            shared = int(np.ceil(similarity * 2 * n / (1 + similarity)))
            ids = rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64)
            met[similarity] += bool(set(sh.minhash_keys(ids[:n])) & set(sh.minhash_keys(ids[n - shared :])))
    assert met[0.8] >= 297 and met[0.4] <= 30


def test_components_of_random_graphs(spark):
    rng = random.Random(11)
    for n, m in ((30, 20), (60, 60), (40, 200)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        nodes = {x for a, b in links if a != b for x in (a, b)}
        with Scratch(spark) as own:
            got = {r.node: r.root for r in components(spark.createDataFrame(links, "u bigint, v bigint"), own).collect()}
        assert got == roots(links, nodes | {x for p in links for x in p}) or got == {k: v for k, v in roots(links, {x for p in links for x in p}).items() if k in nodes}
