"""Keyed state of versions: late, repeated and many pages of a key, restarts, and a batch that reads only itself."""

import random

import pytest
from pyspark.sql import functions as F

from glossa.operators.versions import with_superseded
from glossa.streaming import latest

SCHEMA = "ingest_seq bigint, iso string, url string, canonical_link string, success boolean"


def pages(n=400, seed=0):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["eng", "fra", None]), rng.choice(["hot", "hot", f"u{k % 17}", None, ""]), rng.choice(["l1", f"c{k % 23}", None, ""]), rng.choice([True, True, False, None])) for k in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [3, 1024])
def test_chunks_give_what_a_sorted_list_gives(size):
    rng = random.Random(size)
    kept, found, seen = {}, {}, {}
    heads = []
    for _ in range(12):
        numbers = latest.Sequence(heads, lambda no: ([*kept[no][0]], [*kept[no][1]]), size)
        for _ in range(rng.randint(1, 20)):
            seq, flag = rng.randint(0, 300), rng.random() < 0.3
            if seq not in seen:
                seen[seq] = flag
            for s, by in numbers.add(seq, seen[seq]):
                assert s not in found or by < found[s]
                found[s] = by
        heads = numbers.heads
        kept.update({no: numbers.chunks[no] for no in numbers.changed})
        assert found == {s: min(t for t, f in seen.items() if f and t > s) for s in seen if any(f and t > s for t, f in seen.items())}
    assert all(len(c[0]) <= size for c in kept.values())


def test_batches_in_any_order_and_after_a_restart_give_what_one_batch_gives(spark, tmp_path):
    rows = pages()
    source, changes, state = (f"{tmp_path}/{x}" for x in ("new", "changes", "state"))
    for part, more in enumerate((rows[:150], rows[100:250], rows[250:])):  # some come twice, and the stream starts again each time
        spark.createDataFrame(more, SCHEMA).repartition(2).write.mode("append").parquet(source)
        latest.follow(spark, source, SCHEMA, changes, state, files_per_batch=1).awaitTermination()
        assert len(list((tmp_path / "changes").glob("_batch=*"))) == 2 * part + 2
    whole = spark.createDataFrame(rows, SCHEMA)
    columns = ("ingest_seq", "superseded_seq", "latest")
    want = [tuple(r) for r in with_superseded(whole).select(*columns).collect()]
    got = latest.current(whole, changes).select(*columns).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])
    assert sum(r[2] for r in want) not in (0, len(want))


def test_a_batch_reads_its_rows_and_the_state_only(spark, tmp_path):
    spark.createDataFrame(pages(40), SCHEMA).write.parquet(f"{tmp_path}/new")
    query = latest.follow(spark, f"{tmp_path}/new", SCHEMA, f"{tmp_path}/changes", f"{tmp_path}/state")
    query.awaitTermination()
    assert sum(p.numInputRows for p in query.recentProgress) == 40
    assert sum(p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators) > 0


def test_columns_of_the_same_names_give_way(spark, tmp_path):
    spark.createDataFrame(pages(40), SCHEMA).write.parquet(f"{tmp_path}/new")
    latest.follow(spark, f"{tmp_path}/new", SCHEMA, f"{tmp_path}/changes", f"{tmp_path}/state").awaitTermination()
    versions = spark.createDataFrame(pages(40), SCHEMA).withColumns({"superseded_seq": F.lit("x"), "latest": F.lit(True), "seq": F.lit(1)})
    out = latest.current(versions, f"{tmp_path}/changes", latest="latest")
    assert out.count() == 40 and sorted(out.columns) == sorted([*versions.columns])
