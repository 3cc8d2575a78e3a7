"""Archives: an exact round trip, revisits, and odd pages."""

import hashlib

from glossa.llm import warc


def test_round_trip_and_revisits(spark, tmp_path):
    long, odd = "x" * 1200, "é\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(1, "http://a/", long), (2, "http://b/\r\nX: y", long), (3, None, long), (4, "http://c/", "short"), (5, "http://d/", "short"), (6, "http://e/", None), (7, "http://f/", odd), (8, "http://g/", odd + "z")]
    pages = spark.createDataFrame([(*r, 9) for r in rows], "page_id bigint, url string, html string, digest int")
    path = f"file://{tmp_path}/archives"
    got = {r.page_id: r for r in warc.round_trip(pages, path=path, records_per_file=2).collect()}
    assert len(got) == 8
    for i, _, html in rows:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {1: ("revisit", 3), 2: ("revisit", 3)}
    full = {r.page_id: r.payload for r in warc.read_archives(spark, path, payloads=True).collect()}
    assert bytes(full["7"]).decode() == odd and full["1"] is None and bytes(full["3"]).decode() == long


def test_ties_nulls_and_empty_tables(spark):
    html = "y" * 1000
    pages = spark.createDataFrame([(None, "u", html), (5, "u", html), (5, "u", html), (2, "u", html)], "page_id bigint, url string, html string")
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    assert got == [(0, "revisit", 5), (2, "revisit", 5), (5, "response", None), (5, "response", None)]
    assert warc.round_trip(pages.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "u", html), (None, "u", html)], "page_id bigint, url string, html string")
    assert [r.record_type for r in warc.round_trip(alone).collect()] == ["response", "response"]


def test_the_bit_table_gives_the_same(spark, tmp_path):
    """Without a broadcast: repeated payloads are shuffled, others are not."""
    bodies = [f"{k} " * 600 for k in range(40)] + ["", "short"]
    pages = spark.createDataFrame([(i, f"http://h/{i}", bodies[i * 7 % 42 if i % 3 else i % 5]) for i in range(120)], "page_id bigint, url string, html string")
    fields = ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")
    one = sorted(tuple(r[f] for f in fields) for r in warc.round_trip(pages, path=f"file://{tmp_path}/one").collect())
    two = sorted(tuple(r[f] for f in fields) for r in warc.round_trip(pages, path=f"file://{tmp_path}/two", broadcast_rows=0).collect())
    assert one == two and sum(r[1] == "revisit" for r in one) > 10


def test_record_ids_are_unique_and_long_pages_stay_whole(spark, tmp_path):
    html, huge = "z" * 1500, "<p>long</p>" * 400_000
    rows = [(5, "u", html), (5, "u", html), (5, "v", html), (2, "u", html), (2, "u", html), (7, "w", "tiny"), (7, "w", "tiny"), (8, "x", huge)]
    path = f"file://{tmp_path}/archives"
    got = warc.round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string"), path=path).collect()
    assert len({r.record_id for r in got}) == len(rows)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got)[:5] == [(2, "revisit", 5), (2, "revisit", 5), (5, "response", None), (5, "response", None), (5, "response", None)]
    assert {r.payload_bytes for r in got if r.page_id == 8} == {len(huge)}


def test_every_file_begins_with_its_own_warcinfo(spark, tmp_path):
    import gzip
    import io

    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 300) for i in range(57)], "page_id bigint, url string, html string")
    for name, options in (("n", {"records_per_file": 10}), ("bytes", {"file_bytes": 20_000})):
        warc.write_archives(pages.repartition(2), f"file://{tmp_path}/{name}", **options)
        files, total = list((tmp_path / name).glob("*.gz")), 0
        for f in files:
            kinds = [h["warc-type"] for h, _ in warc.parsed(io.BufferedReader(gzip.open(f)))]
            assert kinds[0] == "warcinfo" and "warcinfo" not in kinds[1:]
            total += len(kinds) - 1
        assert total == 57 and len(files) >= 6
        assert warc.read_archives(spark, f"file://{tmp_path}/{name}").count() == 57
