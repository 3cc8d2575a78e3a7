"""Operators over small tables, readers and writers over folders, and streaming against batch."""

import json
import random

import pytest
from pyspark.sql import functions as F

from glossa import api
from glossa.operators import filters, mutations, ordered, stats, versions
from glossa.sources import readers, schemas, writers
from glossa.streaming import ingest

PAGE = "ingest_seq bigint, iso string, url string, canonical_link string, success boolean"


def stored(rows):
    """Pages inserted one after another, by the rule itself."""
    latest, parallel = {}, {}
    for i, (seq, iso, url, link, success) in enumerate(rows):
        parallel[seq] = None
        if success and link:
            for match in (3, 2):  # links first, so that URLs override
                for s, jiso, jurl, jlink, _ in rows[:i]:
                    if jiso != iso and latest[s] and (jlink == link if match == 3 else jurl == url) and (jlink or match == 2):
                        parallel[seq] = jurl
                if match == 2:
                    break
            for s, jiso, jurl, jlink, _ in rows[:i]:
                if jiso == iso and (jlink == link or jurl == url):
                    latest[s] = False
        latest[seq] = True
    return latest, parallel


def pages(seed, n=80):
    rng = random.Random(seed)
    return [(k, rng.choice(["eng", "fra"]), f"u{rng.randint(0, 9)}", rng.choice(["c1", "c2", "c3", "", None]), rng.random() < 0.8) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_versions_equal_insertion(spark, seed):
    rows = pages(seed)
    frame = spark.createDataFrame(rows, PAGE)
    latest, parallel = stored(rows)
    assert {r.ingest_seq: r.latest for r in versions.with_superseded(frame).collect()} == latest
    assert {r.ingest_seq: r.parallel_url for r in versions.with_parallel(frame).collect()} == parallel


@pytest.mark.parametrize(("seed", "ranges"), [(4, 7), (5, 40)])
def test_one_link_fills_many_tasks(spark, seed, ranges):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["eng", "fra", "deu"]), rng.choice(["hot", f"u{k}"]), "c1", rng.random() < 0.5) for k in range(150)]
    parallel = stored(rows)[1]
    frame = spark.createDataFrame(rows, PAGE).repartition(4)
    assert {r.ingest_seq: r.parallel_url for r in versions.with_parallel(frame, ranges=ranges).collect()} == parallel


def test_stream_equals_batch(spark, tmp_path):
    rows = pages(5)
    source, table = f"{tmp_path}/in", f"{tmp_path}/table"
    for k in range(4):
        spark.createDataFrame(rows[k * 20 : k * 20 + 20], PAGE).coalesce(1).write.mode("append").parquet(source)
        ingest.ingest(spark, source, PAGE, table, f"{tmp_path}/checkpoint", files_per_batch=1).awaitTermination()
    batch = versions.with_superseded(spark.createDataFrame(rows, PAGE))
    assert sorted(ingest.current(spark, table).select(batch.columns).collect()) == sorted(batch.collect())


def test_inventories(spark):
    early = spark.createDataFrame([("eng", "a"), ("eng", "b"), ("fra", "c")], "iso string, url string")
    late = spark.createDataFrame([("eng", "b"), ("eng", "d"), ("som", "e")], "iso string, url string")
    assert [(r.iso, r.url) for r in versions.added(early, late).collect()] == [("eng", "d")]
    assert sorted((r.iso, r.url) for r in versions.lost(early, late).collect()) == [("eng", "a"), ("fra", "c")]
    assert [r.iso for r in versions.new_languages(early, late).collect()] == ["som"]
    assert [(r.url) for r in versions.first_per_key(early.union(late), ["iso"], ["url"]).orderBy("iso").collect()] == ["a", "c", "e"]
    assert versions.sampled_per_key(early, ["iso"], "url", 1).count() == 2
    listing = spark.createDataFrame([("http://x:80/", 1), ("http://x/", 3)], "original_url string, snapshot bigint")
    assert [tuple(r) for r in versions.latest_snapshots(listing).collect()] == [("http://x/", 3)]
    assert versions.distinct_with_null(spark.createDataFrame([("a",), (None,), ("a",)], "k string"), "k", "n").first().n == 2


def test_release_filters(spark):
    rows = [("eng", True, True, True, "article", {"byline": "x"}, ["AP"]), ("eng", True, True, True, "article", {}, ["AP"]), ("eng", True, True, False, "article", {}, None), ("eng", True, True, True, "video", {"page_title": "AFP x"}, None)]
    frame = spark.createDataFrame(rows, "iso string, success boolean, has_ptags boolean, latest boolean, content_type string, utag_data map<string,string>, authors array<string>")
    assert filters.ready(frame, "eng").count() == 1
    assert filters.ready(frame, "eng", content_type="video").count() == 0
    with pytest.raises(ValueError):
        filters.of_types(frame, "article,poem")
    assert filters.of_types(frame, "video").count() == 1 and filters.of_types(frame, None).count() == 4
    route = lambda *a: spark.range(1).select(filters.route(*[F.lit(x) for x in a]).alias("x")).first().x
    assert route("1999-12-31", "eng", "eng", "eng", True, "article") == "publication_date_too_early"
    assert route("2001-01-01", "mul", "fra", "x", True, "article") == "lang_id_filtered" and route("2001", "eng", "eng", "fra", True, "article") == "lang_id_filtered"
    assert route("2001", "fra", "fra", "x", True, None) == "other" and route("2001", "fra", "fra", "x", False, "article") == "empty_output"
    tokens = lambda j: spark.range(1).select(filters.long_enough(F.from_json(F.lit(j), "array<array<array<string>>>"), F.lit(21)).alias("x")).first().x
    assert [tokens(j) for j in ("[]", "[[]]", '[[["a"]]]', '[[["a"],["b"]]]', '[[["a"]],[["b"]]]')] == [True, False, False, True, True]
    broken = filters.violations(frame, filters.required_rules(("iso", "authors"))).collect()
    assert {r.rule: r.n_broken for r in broken} == {"iso_present": 0, "authors_present": 2}
    released = filters.released(spark.createDataFrame([("a", "article"), ("b", "poll"), ("c", "article")], "filename string, route string"), names=spark.createDataFrame([("c",)], "filename string"))
    assert [r.filename for r in released.collect()] == ["a"]


def test_statistics(spark):
    rows = spark.createDataFrame([("eng", "article")] * 12 + [("fra", "video")] * 11 + [("bam", "audio")] * 20 + [("som", "audio")], "language string, content_type string")
    full = stats.counted(rows, "language")
    assert {r.language: r.log_n_docs for r in stats.reported(full, "n_docs").collect()} == {"eng": pytest.approx(1.079181), "fra": pytest.approx(1.041393)}
    table = {r.language: r.asDict() for r in stats.pivoted(rows, "language", "content_type").collect()}
    assert table["Total"] == {"language": "Total", "article": 12, "audio": 21, "video": 11} and table["som"]["video"] == 0
    urls = spark.createDataFrame([("eng", "a"), ("eng", "a"), ("fra", "b")], "iso string, url string")
    assert {r.iso: (r.n_urls, r.n_duplicates) for r in stats.url_counts(urls, "iso", "url").collect()} == {"eng": (2, 1), "fra": (1, 0)}
    years = spark.createDataFrame([("eng", "2001")] * 6 + [("eng", "2002")] * 5 + [("fra", "2001")] * 3 + [("eng", None)], "k string, y string")
    assert {r.year: r.n_docs for r in stats.per_year(years, key="k", year=F.col("y")).collect()} == {"2001": 6, "2002": 5}
    assert [r.x for r in stats.frequency(spark.createDataFrame([(v,) for v in "bbaac"], "x string"), F.col("x"), "x", 2).collect()] == ["a", "b"]


def test_ordered(spark):
    lines = spark.createDataFrame([("f", k, v) for k, v in enumerate(["Hello", ",", "you", "", "Second", "one", ".", "", "last"])], "file_name string, line_no int, value string")
    assert [r.sentence for r in ordered.grouped_sentences(lines).orderBy("island").collect()] == ["Hello, you", "Second one.", "last"]
    assert [r.sentence for r in ordered.grouped_sentences(lines, keep_last=False).orderBy("island").collect()] == ["Hello, you", "Second one."]
    texts = spark.createDataFrame([("# text = A b.",), ("1\tA",)], "value string")
    assert [r.sentence for r in ordered.annotated_texts(texts).collect()] == ["A b."]


def test_mutations(spark):
    rows = spark.createDataFrame([("eng", "x", ("a", 1)), ("fra", None, ("b", 2))], "iso string, content_type string, prov struct<name:string,n:int>")
    assert [r.prov.name for r in mutations.set_nested(rows, F.col("iso") == "fra", "prov", "name", "new").orderBy("iso").collect()] == ["a", "new"]
    assert mutations.flagged_latest(mutations.removed(mutations.renamed(rows, "iso", "code"), "prov")).columns == ["code", "content_type", "latest"]


def document(name, **more):
    base = {"filename": f"{name}.json", "url": "u", "content_type": "article", "site_language": "eng", "title": "T", "authors": ["A"], "paragraphs": ["p1", "p2"], "keywords": ["k"], "n_paragraphs": 2, "sentences": [["s1", "s2"], ["s3"]]}
    return base | more


def test_corpus_reading_and_commands(spark, tmp_path):
    root = tmp_path / "corpus"
    for kind, name, more in (("article", "a", {}), ("video", "b", {"content_type": "video", "keywords": ["z"]})):
        (root / "eng_site" / kind).mkdir(parents=True)
        (root / "eng_site" / kind / f"{name}.json").write_text(json.dumps(document(name, **more), indent=1))
    (root / "eng_site" / "article" / "bad.json").write_text("{")
    docs = readers.documents(spark, str(root)).cache()
    assert docs.count() == 3 and docs.filter("_corrupt_record IS NOT NULL").count() == 1
    assert readers.documents(spark, str(root), articles_only=True).count() == 2
    good = docs.filter("_corrupt_record IS NULL")
    assert [r.filename for r in api.search(good, "k").collect()] == ["a.json"]
    got = {r.filename: r.text for r in api.extract(good, "sentences", include_title=True, max_per_file=2).collect()}
    assert got == {"a.txt": "T\n\ns1\ns2\n", "b.txt": "T\n\ns1\ns2\n"}
    assert api.extract(good, "paragraphs", max_files=1).count() == 1 and api.extract(good, "paragraphs", types="video").count() == 1
    with pytest.raises(Exception, match="no tokens"):
        api.extract(good, "tokens").collect()
    (tmp_path / "list.txt").write_text(str(root / "eng_site/video/b.json") + "\n")
    assert [r.filename for r in readers.listed_documents(spark, str(tmp_path / "list.txt"), str(root)).collect()] == ["b.json"]


def test_writers(spark, tmp_path):
    docs = spark.createDataFrame([("eng_a", "article", "f", None, 0, ["x"]), ("eng_a", "empty_output", "g", "p", 2, [])], "iso_domain string, route string, url string, parallel_article string, n_tokens bigint, sentences array<string>")
    writers.routed(docs, f"{tmp_path}/out")
    found = {(r.route, r.value) for r in spark.read.text(f"{tmp_path}/out").collect()}
    assert found == {("article", '{"url":"f","sentences":["x"]}'), ("empty_output", '{"url":"g","parallel_article":"p","n_tokens":2}')}
    writers.empty_list(docs, f"{tmp_path}/empty")
    assert [r.value for r in spark.read.text(f"{tmp_path}/empty").collect()] == ["g"]
    with pytest.raises(ValueError):
        writers.named_once(docs, "iso_domain")
    removed = spark.createDataFrame([("f", [(1, 0.9, 0.5, "a\tb\nc")])], "filename string, removed array<struct<par_num:int,probability:double,proportion:double,paragraph:string>>")
    writers.removed_paragraphs(removed, f"{tmp_path}/removed")
    assert spark.read.text(f"{tmp_path}/removed").first().value == "f\t1\t0.9\t0.5\ta b c"


def test_other_readers(spark, tmp_path):
    (tmp_path / "s.xml").write_text('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>http://a/1</loc><lastmod>2020-01-01</lastmod></url><url><lastmod>x</lastmod></url></urlset>')
    assert [(r.url, r.sitemap_last_modified) for r in readers.sitemap(spark, str(tmp_path / "s.xml")).collect()] == [("http://a/1", "2020-01-01")]
    (tmp_path / "cdx").write_text("com,a)/x.html 20200102030405 http://a:80/x.html more\n")
    row = readers.archive_listing(spark, str(tmp_path / "cdx")).first()
    assert (row.url_key, row.snapshot, row.original_url) == ("com,a)/x.html", 20200102030405, "http://a:80/x.html")
    (tmp_path / "d.tsv").write_text("region\tiso\tlanguage\tsite_name\tnews\tradio\tvideo\ttv\tdirect\nAfrica\tsom\tSomali\tS\tn\t\t\t\t\n\thau\tHausa\tH\tn\t\t\t\t\n\t\tnone\t\t\t\t\t\t\n")
    assert [(r.region, r.iso) for r in readers.domains(spark, str(tmp_path / "d.tsv")).collect()] == [("Africa", "som"), ("Africa", "hau")]
    (tmp_path / "som_x.txt").write_text("abc\nde\n")
    assert [(r.language, r.n_chars) for r in readers.article_lines(spark, str(tmp_path / "som_x.txt")).collect()] == [("som", 4), ("som", 3)]
    (tmp_path / "w.xml").write_text("<t><s><w>A</w><w>b</w><w>.</w></s><s><w>C</w></s></t>")
    assert [r.sentence for r in readers.word_sentences(spark, str(tmp_path / "w.xml")).collect()] == ["A b.", "C"]
    (tmp_path / "p.jsonl").write_text('{"url": "a", "timestamp": "2020-01-01T00:00:00Z"}\n')
    assert str(readers.inventory_pages(spark, str(tmp_path / "p.jsonl")).first().sitemap_last_modified).startswith("2020-01-01")
    assert schemas.DOCUMENT.count("STRING") > 10


def test_sitemap_entries_of_a_language_count_once(spark, tmp_path):
    entry = "<url><loc>{}</loc><priority>{}</priority></url>"
    head = "<urlset xmlns='s' xmlns:video='v' xmlns:news='n'>"
    (tmp_path / "b.xml").write_text(head + entry.format(" http://x/1 ", "b1") + entry.format("http://x/2", "b2") + entry.format("http://x/2", "b3") + "<url><priority>no</priority></url></urlset>")
    (tmp_path / "a.xml").write_text(head + entry.format("http://x/1", "a1") + "<url><loc>http://x/3</loc><video:video><video:title>t</video:title></video:video></url></urlset>")
    (tmp_path / "c.xml").write_text(head + entry.format("http://x/1", "c1") + "</urlset>")
    order = spark.createDataFrame([("b.xml", "eng"), ("a.xml", "eng"), ("c.xml", "fra")], "Filename string, ISO string").coalesce(1)
    got = {(r.iso, r.url): (r.priority, r.video) for r in readers.sitemap_pages(spark, f"{tmp_path}/*.xml", order).collect()}
    assert got == {("eng", "http://x/1"): ("b1", None), ("eng", "http://x/2"): ("b2", None), ("eng", "http://x/3"): (None, {"title": "t"}), ("fra", "http://x/1"): ("c1", None)}


def test_lines_of_split_files_are_numbered(spark, tmp_path):
    lines = {name: [f"{name} {k} " + "x" * (k * 37 % 90) for k in range(3000)] for name in ("one", "two")}
    for name, own in lines.items():
        (tmp_path / name).write_text("\n".join(own) + "\n")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "20k")
    try:
        got = readers.numbered_lines(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 8
        assert sorted((r.file_name, r.line_no, r.value) for r in got.collect()) == [(n, k, v) for n, own in lines.items() for k, v in enumerate(own)]
    finally:
        spark.conf.set(setting, before)


def test_ordered_rows_in_many_ranges(spark):
    rows = [(k % 3, k, "" if k % 7 else f"v{k}") for k in range(300)]
    frame = spark.createDataFrame(rows, "k int, at int, v string").repartition(4)
    last, want = {}, {}
    for key, at, v in rows:
        last[key] = v or last.get(key)
        want[at] = last[key]
    assert {r["at"]: r["v"] for r in ordered.filled_down(frame, "v", "at", ("k",), ranges=5).collect()} == want
    lines = frame.withColumn("v", F.when(F.col("at") % 20 == 0, "").otherwise(F.col("at").cast("string")))
    found = {(r.k, r.island): r.sentence for r in ordered.grouped_sentences(lines, file="k", order="at", value="v", ranges=5).collect()}
    plain, island = {}, {}
    for key, at, _ in rows:
        island[key] = island.get(key, 0) + (at % 20 == 0)
        if at % 20:
            plain.setdefault((key, island[key]), []).append(str(at))
    assert found == {k: " ".join(v) for k, v in plain.items()}


def test_lines_are_numbered_by_file(spark, tmp_path):
    (tmp_path / "one").write_text("a\nb\n\nc")
    got = sorted((r.file_name, r.line_no, r.value) for r in readers.numbered_lines(spark, str(tmp_path)).collect())
    assert got == [("one", 0, "a"), ("one", 1, "b"), ("one", 2, ""), ("one", 3, "c")]


def test_lost_urls_of_a_language_that_is_gone(spark):
    early = spark.createDataFrame([("eng", "u1"), ("eng", "u2"), ("fra", "u3")], "iso string, url string")
    late = spark.createDataFrame([("eng", "u1"), ("deu", "u9")], "iso string, url string")
    assert sorted(r.url for r in versions.lost(early, late).collect()) == ["u2", "u3"] and versions.added(early, late).count() == 0


def test_a_dump_without_a_date_is_an_error(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"_id": "1", "date_published": null}')
    with pytest.raises(Exception, match="no publication date"):
        readers.reinserted(spark, f"{tmp_path}/d.json", "_id STRING, date_published STRING").collect()


def test_single_line_texts_and_archives(spark, tmp_path):
    docs = spark.createDataFrame([("x", [["One.", "Two."], ["Three."]])], "iso_domain string, sentences array<array<string>>")
    writers.sentences(docs, f"{tmp_path}/flat", lines=False)
    assert [r.value for r in spark.read.text(f"{tmp_path}/flat").collect()] == ["One. Two. Three."]
    writers.archives(docs, f"{tmp_path}/release")
    assert len(list((tmp_path / "release" / "iso_domain=x").glob("*.gz"))) == 1


def test_segmentation_data_of_three_kinds(spark, tmp_path):
    (tmp_path / "ner").write_text("Moyo B-PER\nwahamba O\n. O\n\nKwaba O\nnjalo O\n")
    (tmp_path / "ud").write_text("# sent_id = 1\n# text = One two.\n1\tOne\n\n# text = Three.\n")
    (tmp_path / "xml.xml").write_text("<t><s><w>One</w><w>two</w><w>.</w></s><s><w>Three</w></s></t>")
    got = {k: sorted(r.sentence for r in readers.segmentation_data(spark, str(tmp_path / f), k).collect()) for k, f in (("ner", "ner"), ("ud", "ud"), ("xml", "xml.xml"))}
    assert got == {"ner": ["Kwaba njalo", "Moyo wahamba."], "ud": ["One two.", "Three."], "xml": ["One two.", "Three"]}


def test_tables_for_papers(spark):
    rows = spark.createDataFrame([("a_b", 1200), (None, 3)], "lang string, n bigint").orderBy("n")
    assert stats.latex(rows) == "\\begin{tabular}{ll}\nlang & n \\\\\n\\hline\n & 3 \\\\\na\\_b & 1,200 \\\\\n\\end{tabular}"
    with pytest.raises(ValueError, match="more than 1"):
        stats.latex(rows, most=1)


def test_linked_data_that_is_not_json_is_an_error(spark):
    from glossa.functions import text

    page = spark.createDataFrame([('<script type="application/ld+json">{broken</script>',)], "html string")
    with pytest.raises(Exception, match="the text ends early"):
        page.select(F.to_json(text.linked_data(F.col("html")))).collect()


def test_commands(spark, tmp_path):
    folder = tmp_path / "in" / "eng_site" / "article"
    folder.mkdir(parents=True)
    for name in ("a", "b"):
        (folder / f"{name}.json").write_text(json.dumps({"filename": f"{name}.json", "content_type": "article", "title": f"T {name}", "paragraphs": [f"{name} one", "two"], "keywords": ["k"] if name == "a" else []}))
    api.main(["search", "k", str(tmp_path / "in"), f"{tmp_path}/found"])
    assert [r.value.rsplit("/", 1)[1] for r in spark.read.text(f"{tmp_path}/found").collect()] == ["a.json"]
    api.main(["extract", "paragraphs", str(tmp_path / "in"), f"{tmp_path}/texts", "--include-title"])
    files = {f.name: f.read_text() for f in (tmp_path / "texts" / "article").iterdir() if not f.name.startswith(".")}
    assert files == {f"{n}.txt": f"T {n}\n\n{n} one\n\ntwo\n\n" for n in ("a", "b")}
    api.main(["extract", "paragraphs", str(tmp_path / "in"), f"{tmp_path}/lines", "--lines", "--max-per-file", "1"])
    assert {(r.filename, r.text) for r in spark.read.json(f"{tmp_path}/lines").collect()} == {("a.txt", "a one\n\n"), ("b.txt", "b one\n\n")}
