"""Indexes and sketches: what is moved, what is skipped, and what merges."""

import duckdb
import pytest
from pyspark.sql import functions as F

from glossa.operators import sketches
from glossa.plans import catalogue, details
from glossa.sources import indexed


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = spark.range(40_000).select(F.col("id"), F.md5((F.col("id") % 9_000).cast("string")).alias("link"), F.md5(F.col("id").cast("string")).alias("url"))
    rows = rows.withColumn("link", F.when(F.col("id") % 50 > 0, F.col("link")))
    made = indexed.written(rows.repartition(3), str(tmp_path_factory.mktemp("index")), "link", bloom=("url",), values=10_000, buckets=4, row_group=64 << 10)
    yield made
    indexed.dropped(spark, made)


def scanned(frame):
    """Rows that the scan gives, after what row groups it skips."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()) if leaves.apply(k).nodeName().startswith("Scan parquet"))


def test_keys_are_found_without_moving_the_stored_side(spark, index):
    keys = spark.createDataFrame([(None,), ("none",)], "k string").union(index.rows(spark).filter("id % 777 = 0").select("link"))
    for missing in (False, True):
        out = indexed.found(index, keys, "k", missing=missing)
        plan = out._jdf.queryExecution().executedPlan().toString()
        stored_side = plan.split("Join")[1].split("Exchange")[0]
        assert "Scan parquet" in stored_side and "Bucketed: true" in stored_side
        wanted = {r.k for r in keys.collect()} - {None}
        want = {r.id for r in index.rows(spark).collect() if (r.link in wanted) != missing}
        assert {r.id for r in out.collect()} == want


def test_one_value_reads_few_row_groups(spark, index):
    row = index.rows(spark).filter("id = 4321").first()
    by_link = indexed.rows_with(spark, index, "link", row.link)
    assert sorted(r.id for r in by_link.collect()) == [4321, 13321, 22321, 31321] and scanned(by_link) < 10_000
    by_url = indexed.rows_with(spark, index, "url", row.url)
    assert [r.id for r in by_url.collect()] == [4321] and scanned(by_url) < 10_000
    nothing = indexed.rows_with(spark, index, "url", "7" * 32)  # within the statistics of every row group
    assert nothing.count() == 0 and scanned(nothing) < 4_000


def test_another_session_opens_the_folder(spark, index):
    again = indexed.opened(spark, index.path, "id bigint, link string, url string", "link", 4)
    assert again.rows(spark).count() == 40_000 and indexed.rows_with(spark, again, "url", index.rows(spark).filter("id = 7").first().url).count() == 1
    indexed.dropped(spark, again)
    assert index.rows(spark).count() == 40_000


def test_sketches_of_batches_merge_and_are_replaced(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("g"), (F.col("id") % 5).alias("b"))
    for b in (0, 1, 2, 3, 4, 2):
        sketches.taken_in(rows.filter(F.col("b") == b), str(tmp_path / "s"), f"b{b}", F.col("v"), "g")
    got = {r.g: (r.n_rows, r.n_distinct) for r in sketches.stored_counts(spark, str(tmp_path / "s"), "g").collect()}
    want = {r.g: (r.n, r.d) for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("d")).collect()}
    assert set(got) == set(want) == {None, 0, 1}
    assert all(got[g][0] == n and abs(got[g][1] - d) < 0.06 * d for g, (n, d) in want.items())


def test_sketches_of_nulls_and_of_nothing(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b")], "v int, g string")
    assert {r.g: r.n_distinct for r in sketches.merged(sketches.sketched(rows, F.col("v"), "g"), "g").collect()} == {"a": 0, "b": 1}
    assert sketches.merged(sketches.sketched(rows.limit(0), F.col("v"), "g"), "g").count() == 0


def test_sketches_count_empty_strings_and_every_row(spark, tmp_path):
    """An empty string is a value, and estimates stay well within six percent: rare misses of a coarse sketch are wrong rows in a report."""
    rows = spark.createDataFrame([("a", "")], "g string, v string")
    assert [r.n_distinct for r in sketches.merged(sketches.sketched(rows, F.col("v"), "g"), "g").collect()] == [1]
    many = spark.range(200_000).select((F.col("id") % 10).cast("string").alias("g"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("v"))
    got = sketches.merged(sketches.sketched(many, F.col("v"), "g"), "g").collect()
    assert len(got) == 10 and all(abs(r.n_distinct - 20_000) <= 0.015 * 20_000 for r in got)


def test_vocabulary_of_odd_rows(spark, tmp_path):
    """Rows without a number or with a negative one count, a vertical tab is part of a word as in the SQL, and a language whose only word is empty is near."""
    rows = [(None, "a b", "x"), (-3, "c", "x"), (4, "d\x0be f", "x"), (5, "", "y"), (14, None, "z"), (6, "g", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in details.stored_vocabulary(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.sql(catalogue.oracle_sql()["stored_vocabulary"]).fetchall(), key=str)
