"""Scans over a total order against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from glossa.operators import scans

ROWS = [(k // 7 if k % 11 else None, k, random.Random(k).choice([None, 1, 2, 5]), "x" * (k % 3), "r") for k in range(500)]


def by():
    return [F.col("g").asc_nulls_last(), F.col("k").desc()]


@pytest.fixture(scope="module")
def rows(spark):
    shuffled = random.Random(1).sample(ROWS, len(ROWS))
    return spark.createDataFrame(shuffled, "g int, k int, v int, range string, place string").repartition(5)


def in_order():
    return sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, -r[1]))


def test_ranks_are_places_in_the_order(rows):
    out = scans.ranked(rows, by(), ranges=7)
    assert out.columns == [*rows.columns, "rank"]
    assert [r[:5] for r in sorted(out.collect(), key=lambda r: r["rank"])] == in_order()
    assert sorted(r["rank"] for r in out.collect()) == list(range(500))


def test_ranks_start_again_within_keys(rows):
    got = {(r["g"], r["k"]): r["rank"] for r in scans.ranked(rows, by(), ranges=7, within=("g",)).collect()}
    want, last = {}, {}
    for r in in_order():
        want[r[:2]] = last[r[0]] = last.get(r[0], -1) + 1
    assert got == want


def test_running_sums_and_last_values(rows):
    sums = {(r["g"], r["k"]): (r["s"], r["n"]) for r in scans.running(rows, by(), {"s": F.col("v"), "n": F.lit(1)}, ranges=6).collect()}
    lasts = {(r["g"], r["k"]): r["last"] for r in scans.filled(rows, by(), {"last": F.col("v")}, ranges=6).collect()}
    s, last = 0, None
    for n, r in enumerate(in_order(), 1):
        s, last = s + (r[2] or 0), r[2] if r[2] is not None else last
        assert sums[r[:2]] == (s, n) and lasts[r[:2]] == last


def test_one_key_fills_as_many_ranges_as_its_rows(rows):
    hot = rows.withColumn("g", F.when(F.col("k") % 3 > 0, 1).otherwise(F.col("g")))
    found, part, _ = scans.in_ranges(hot, by(), ranges=8)
    sizes = [r["count"] for r in found.groupBy(part).count().collect()]
    assert sum(sizes) == 500 and max(sizes) < 150
    ranks = [r["rank"] for r in scans.ranked(hot, by(), ranges=8, within=("g",)).filter("g = 1").collect()]
    assert sorted(ranks) == list(range(len(ranks)))


def test_empty_tables_stay_empty(rows):
    none = rows.limit(0)
    assert scans.ranked(none, by()).count() == scans.running(none, by(), {"s": F.col("v")}).count() == scans.filled(none, by(), {"s": F.col("v")}).count() == 0
