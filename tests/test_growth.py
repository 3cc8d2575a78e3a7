"""What has to stay in proportion to the input, and be right, when tables grow."""

import hashlib
import inspect
import re
import tracemalloc
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from glossa.functions import json5, text
from glossa.operators import lexicon, versions
from glossa.plans import details
from glossa.sources import named, readers

PAGE = "ingest_seq bigint, iso string, url string, canonical_link string, success boolean"


def test_versions_carry_on_from_row_to_row(spark):
    """A window over what follows is computed anew for each row, so with one link for all pages it takes the square of their number."""
    rows = [(k, "eng", f"u{k % 3}", "c", k % 4 == 0) for k in range(40)]
    found = versions.with_superseded(spark.createDataFrame(rows, PAGE))
    assert "unboundedfollowing" not in found._jdf.queryExecution().toString().lower()
    marks = [k for k in range(40) if k % 4 == 0]
    assert {r.ingest_seq: r.superseded_seq for r in found.collect()} == {k: min((m for m in marks if m > k), default=None) for k in range(40)}


def test_titles_with_cut_references(spark):
    """``terminated`` leaves what has no semicolon, as the query's SQL does."""
    page = F.lit("<title>a &amp;amp &lt;&#x27;&amp;&amp &ampx; &nosuch;</title>")
    assert spark.range(1).select(text.title_of(page, terminated=True)).first()[0] == "a &amp <'&&amp &ampx; &nosuch;"


def test_files_of_a_name_stream(spark, tmp_path):
    """A name's texts in files of many tasks give the digest of the whole, in order; empty and hidden files give no row."""
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("name"), (-F.col("id")).alias("at"), F.concat(F.lit("line "), F.col("id").cast("string"), F.lit("\n")).alias("line"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one task's
    try:
        named.write_parts(rows.repartition(5), str(tmp_path / "out"), F.col("name"), F.col("line"), [F.col("at")], ".txt")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = named.named_files(spark, str(tmp_path / "out"))
    got = {r.name: r.digest for r in named.named_digests(spark, str(tmp_path / "out"), F.substring("name", 1, 1)).collect()}
    want = {n: hashlib.md5("".join(f"line {k}\n" for k in range(1999, -1, -1) if (k % 3 == 0) == (n == "a")).encode()).hexdigest() for n in "ab"}
    assert got == want and files.count() > 2
    (tmp_path / "out/d/_x").mkdir(parents=True)
    for name, body in (("d/e", ""), ("d/f", "é\r\n"), ("d/_x/g", "no"), (".h", "no")):
        (tmp_path / "out" / name).write_bytes(body.encode())
    assert {r.name: r.text for r in named.read_named(spark, str(tmp_path / "out")).filter("name LIKE 'd%' OR name LIKE '.%'").collect()} == {"d/f": "é\r\n"}


def test_lines_of_one_file_in_parts(spark, tmp_path):
    spark.range(0, 3000, 1, 6).select(F.col("id").cast("string").alias("value")).write.text(str(tmp_path / "in"))
    assert all(int(r.value) == r.line_no for r in readers.numbered_lines(spark, str(tmp_path / "in"), parts=True).collect())


def test_no_task_writes_a_fixed_share():
    """Queries that write files leave the number of tasks to the size of their tables."""
    for query in (details.exported_text, details.named_release, details.named_dump, details.named_plaintext, details.split_lines, details.gunzipped_files):
        assert not re.search(r"repartition(ByRange)?\([0-9]", inspect.getsource(query))
    assert "coalesce(1)" not in inspect.getsource(details.keyed_versions)  # would read its input in one task as well


def test_substrings_of_long_runs(spark):
    """Counted in arrays: a run of many letters, letters beyond 16 bits, marks; no row for each occurrence reaches the shuffle."""
    runs = ["ab" * 3000, "é𐐀a𐐀a", "x", "".join(map(chr, range(0x4E00, 0x4E00 + 70_000 // 4)))]  # the last: too many letters to be packed
    frame = spark.createDataFrame([(" ".join(runs),), (None,), ("1 2",)], "text string")
    found = lexicon.substrings(frame, "text", 4)
    want = Counter(run[i : i + k] for run in runs for k in range(1, 5) for i in range(len(run) - k + 1))
    assert {r.gram: r.n for r in found.collect()} == want
    packed = lexicon._counted(runs[:3], 4)
    assert {g: want[g] for g in packed.column("gram").to_pylist()} == dict(zip(packed.column("gram").to_pylist(), packed.column("n").to_pylist(), strict=True))
    assert "sequence(" not in found._jdf.queryExecution().toString()


def test_shared_ends(spark):
    rows = [(["ab", "c", "d"], ["a", "bc", "d"]), (["x"], ["x"]), (["a"] * 20_000, ["a"] * 20_000), (None, ["a"])]
    frame = spark.createDataFrame(rows, "found array<string>, right array<string>")
    assert [r[0] for r in frame.select(lexicon.shared_ends(F.col("found"), F.col("right"))).collect()] == [1, 0, 19_999, None]


def test_few_texts_of_a_batch_are_python_strings(spark):
    """A batch of long texts was held twice as Python strings, before and after."""
    texts = pa.array([f"{{a: '{k}{'x' * 20_000}',}}" for k in range(2_000)] + [None])
    run = json5._each(True).func
    tracemalloc.start()
    found = run(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000 and len(found) == 2_001 and found[1_999].as_py() == f'{{"a":"1999{"x" * 20_000}"}}' and found[2_000].as_py() is None
    assert len(run(texts[:0])) == 0
