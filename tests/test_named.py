"""Named files: names, whole texts, aborted tasks and jobs, odd names."""

import time

import pytest
from pyspark.sql import functions as F

from glossa.sources import named, writers


def files(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file() and not p.name.startswith("."))


def test_files_have_their_names_and_texts(spark, tmp_path):
    rows = [(f"d{k % 3}/naïve +%20 {k}.txt", None if k == 5 else f"text {k}\n\n é") for k in range(40)]
    frame = spark.createDataFrame(rows, "n string, t string").repartition(3)
    named.write_named(frame, str(tmp_path / "out"), F.col("n"), F.col("t"))
    assert files(tmp_path / "out") == sorted(["_SUCCESS", *[n for n, _ in rows]])
    got = {r.name: r.text for r in named.read_named(spark, str(tmp_path / "out")).collect()}
    assert got == {n: t for n, t in rows if t}
    named.write_named(frame.filter("n LIKE 'd1%'"), f"file://{tmp_path}/out", F.col("n"), F.lit("new"))
    got = {r.name: r.text for r in named.read_named(spark, f"file://{tmp_path}/out").collect()}
    assert got == {n: "new" if n[:2] == "d1" else t for n, t in rows if t or n[:2] == "d1"}
    named.write_named(frame.limit(1), str(tmp_path / "out"), F.lit("a/only"), F.lit("x"), mode="overwrite")
    assert files(tmp_path / "out") == ["_SUCCESS", "a/only"]


def test_rows_of_one_name_follow_each_other(spark, tmp_path):
    frame = spark.range(200).repartition(5)
    named.write_named(frame, str(tmp_path / "out"), F.concat((F.col("id") % 3).cast("string"), F.lit(".txt")), F.concat(F.col("id").cast("string"), F.lit("\n")), order=[F.col("id")])
    assert {r.name: r.text for r in named.read_named(spark, str(tmp_path / "out")).collect()} == {f"{k}.txt": "".join(f"{i}\n" for i in range(200) if i % 3 == k) for k in range(3)}


@pytest.mark.parametrize("bad", ["/x", "../x", "a/../b", "a//b", "", None, "_named/x"])
def test_a_job_that_fails_leaves_no_file(spark, tmp_path, bad):
    frame = spark.createDataFrame([(f"ok{k}", "t") for k in range(30)], "n string, t string").repartitionByRange(4, "n")
    frame = frame.withColumn("n", F.when(F.col("n") == "ok9", F.lit(bad)).otherwise(F.col("n")))
    with pytest.raises(Exception, match="not a name below the target"):
        named.write_named(frame, str(tmp_path / "out"), F.col("n"), F.col("t"))
    for _ in range(100):  # tasks that still ran
        if all(f.endswith(".aborted") for f in files(tmp_path / "out")):
            break
        time.sleep(0.1)
    assert all(f.startswith("_named/") and f.endswith(".aborted") for f in files(tmp_path / "out"))


def test_an_empty_table_leaves_the_mark_of_success(spark, tmp_path):
    named.write_named(spark.range(0), str(tmp_path / "out"), F.lit("a"), F.lit("b"))
    assert files(tmp_path / "out") == ["_SUCCESS"]


def test_releases_by_the_documents_own_paths(spark, tmp_path):
    schema = "iso_domain string, route string, content_type string, filename string, url string, tokens array<string>"
    rows = [("eng_x", "article", "article", "a.html", "u1", ["t"]), ("eng_x", "lang_id_filtered", "article", "b.html", "u2", []), ("eng_x", "empty_output", None, "c", "u9", []), ("eng_x", "empty_output", None, "d", "u3", [])]
    writers.named_release(spark.createDataFrame(rows, schema), str(tmp_path / "out"))
    got = {r.name: r.text for r in named.read_named(spark, str(tmp_path / "out")).collect()}
    assert got["eng_x/other/empty_output.txt"] == "u3\nu9\n" and set(got) == {"eng_x/article/a.html.json", "eng_x/lang_id_filtered/b.html.json", "eng_x/other/empty_output.txt"}
    assert '"tokens":["t"]' in got["eng_x/article/a.html.json"] and "tokens" not in got["eng_x/lang_id_filtered/b.html.json"]


def test_plain_texts_begin_with_their_titles(spark, tmp_path):
    schema = "content_type string, filename string, title string, paragraphs array<string>, tokens array<array<array<string>>>"
    rows = [("article", "a.html", "T", ["p", "q"], [[["x", "y"], ["z"]], [["w"]]]), ("article", "b", None, None, None), ("lang_id_filtered", "c", "T", ["p"], None)]
    writers.named_plaintext(spark.createDataFrame(rows, schema), str(tmp_path / "out"))
    got = {r.name: r.text for r in named.read_named(spark, str(tmp_path / "out")).collect()}
    assert got == {"raw_paragraphs/article/a.txt": "T\n\np\n\nq", "tokenized_sentences/article/a.txt": "T\n\nx y\nz\n\nw", "tokenized_sentences/article/b.txt": "\n\n"}
