"""Source mixing against a plain sorted walk, and its defined cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from glossa.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, mix string, size string, parts int, `of` string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "m", "s", 1, "o", "k") for r in rows], SCHEMA)


def plain(rows, share=1.5, cap=2.0, weights=(5, 2, 1)):
    """Targets by reshare rounds, copies by a walk over each source's documents in the order of their keys."""
    size = [len(re.findall(r"[^\x20\x09-\x0d]+", t or "")) for _, t, _ in rows]
    key = [int(hashlib.md5(f"mix:{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:15], 16) for i, t, _ in rows]
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in names}
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(total.values()) - cap * sum(total[s] for s in full)
        free = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in free) if free else 0
        new = {s for s in free if weight[s] * level > cap * total[s]}
        if not new:
            break
        full |= new
    target = {s: cap * total[s] if s in full else weight[s] * level for s in names}
    taken = [0] * len(rows)
    for s in names:
        own = [k for k, r in enumerate(rows) if r[2] == s]
        whole = int(target[s] // total[s]) if total[s] else 0
        rest, before = target[s] - whole * total[s], 0
        for one in sorted({key[k] for k in own}):
            group = [k for k in own if key[k] == one]
            n = sum(size[k] for k in group)
            for k in group:
                taken[k] = (whole + (2 * before + n <= 2 * rest)) * size[k]
            before += n
    return sorted((str(r[0]), size[k], total[r[2]], round(target[r[2]], 6), taken[k]) for k, r in enumerate(rows))


def mixed(docs, **options):
    rows = mixing.mix(docs, **options).select("doc_id", "mix.*").collect()
    return sorted((str(r.doc_id), r["size"], r.source_size, round(r.mixes[0].target, 6), r.mixes[0].taken) for r in rows)


def documents(n, seed=0):
    rng = random.Random(seed)
    names = ["b", "a", None, "é", "Z", "", "hot"]
    rows = [(k, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 5, 50, 400]))), rng.choice(names + ["hot"] * 4)) for k in range(n)]
    return rows + [(1, None, "a"), (1, None, "a"), (None, "no id", "hot"), (None, None, None), (7, "same row", "b"), (7, "same row", "b"), (7, "other text", "b"), (9, "\t\n \x0b", "blank")]


@pytest.mark.parametrize("bits", [12, 4])
def test_equals_a_sorted_walk(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "LEVEL_BITS", bits)
    rows = documents(300)
    docs = frame(spark, rows).repartition(6)
    assert mixed(docs) == plain(rows)
    assert mixing.mix(docs).columns == ["doc_id", "text", "source", "size", "parts", "of", "key", "mix"]


def test_long_tables_of_sources_are_shuffled(spark):
    rows = documents(200, seed=3)
    assert mixed(frame(spark, rows), broadcast_rows=0) == plain(rows)


def test_targets_are_met_within_half_a_document_and_no_document_exceeds_the_cap(spark):
    rows = documents(400, seed=5)
    by = {}
    for r in mixing.mix(frame(spark, rows)).select("source", "mix.*").collect():
        m = r.mixes[0]
        assert m.taken <= 2 * r["size"]
        one = by.setdefault(r.source, [m.target, 0, 0])
        one[1] += m.taken
        one[2] = max(one[2], r["size"])
    assert all(abs(target - taken) <= largest / 2 + 1 for target, taken, largest in by.values())


def test_mixes_of_smaller_shares_lie_within_larger_ones(spark):
    rows = documents(200, seed=9)
    got = mixing.mix(frame(spark, rows), shares=(0.3, 0.9, 1.5)).select("mix.mixes").collect()
    assert all(r.mixes[0].copies <= r.mixes[1].copies <= r.mixes[2].copies for r in got)
    assert sum(r.mixes[0].taken for r in got) < sum(r.mixes[1].taken for r in got)


def test_copies_repeat_the_documents(spark):
    rows = documents(100, seed=2)
    found = mixing.mix(frame(spark, rows))
    n = found.select(F.sum(F.get("mix.mixes", F.lit(0))["copies"]).alias("n")).first().n
    out = mixing.copies(found)
    assert out.count() == n and out.columns == found.columns[:-1]


def test_empty_tables_and_tables_without_words(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    blank = [(1, "", "a"), (2, None, None)]
    assert mixed(frame(spark, blank)) == [("1", 0, 0, 0.0, 0), ("2", 0, 0, 0.0, 0)]


def test_reruns_agree_whatever_the_partitions(spark):
    docs = frame(spark, documents(150, seed=4))
    assert mixed(docs.repartition(1)) == mixed(docs.repartition(9, "text"))


def test_no_python_runs_in_the_plan(spark):
    plan = mixing.mix(frame(spark, documents(20)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
