"""WARC archives with revisit resolution.

Writing: payload digests are computed where the pages are read.  Only headers (id, digest, URL)
are shuffled by digest to find, for each payload of at least ``min_bytes`` that occurs more than
once, the page that keeps it (the largest id).  That table goes to the shared folder.  If it is
short, it is sent to the pages; if it is long, a bit table of fixed size keeps apart the pages whose
payload occurs once, which are written where they are read, and only the rest is shuffled.  Every
page becomes one record with fresh headers: a full ``response``, or a ``revisit`` that names its
original and has the HTTP header but no payload.  The records are valid UTF-8, so Spark's own text
sink writes real gzipped WARC files (its line separator is the blank line that ends a WARC record;
a file is one gzip member and begins with a warcinfo record), on any file system and with Spark's commit protocol.

Reading: the files are parsed by Content-Length, response payloads are hashed again, and revisits
are resolved by joining their WARC-Refers-To with the record ids of the responses.

Defined cases: a null page is an empty payload; payloads below ``min_bytes`` are all responses; of
equal payloads, rows that tie for the largest id are all responses; a null id counts as smallest
and is read back as null, and a payload that only null ids have stays a response; a null URL gives
no target header; control characters in a URL are percent-encoded; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossa.llm.common import cut, shared_dir

MIN_BYTES = 1000
#: Bytes of payload that a file has on average (a reader holds one compressed file at a time).
FILE_BYTES = 128 << 20
#: Repeated payloads whose table is broadcast (some 30 MB in memory), and bits of the table that stands for a longer one.
BROADCAST_ROWS, FILTER_BITS = 200_000, 1 << 22
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = pa.schema([("record_id", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _bit(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(FILTER_BITS))


def _may_repeat(first: DataFrame) -> Column:
    """Whether a payload may be one of the repeated ones; false only if it is not."""
    rows = first.select(_bit(F.col("digest")).alias("bit")).groupBy(F.expr("bit div 63").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 63 as int))")).alias("bits"))
    words = [0] * (FILTER_BITS // 63 + 1)
    for r in rows.collect():  # FILTER_BITS / 63 rows at most
        words[r.word] = r.bits
    table, bit = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>"), _bit(F.col("digest"))
    return F.get(table, F.floor(bit / 63).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 63).cast("int"))) != 0


def with_originals(pages: DataFrame, min_bytes: int = MIN_BYTES, broadcast_rows: int = BROADCAST_ROWS, seen: Observation | None = None) -> DataFrame:
    """``seen`` gets the number of pages and their bytes, as ``n`` and ``bytes``.

    Columns: id, url, html with the payload's size and digest, the original's id and URL for revisits, and ``copy``: 0 but for further rows of the original's own id."""
    html = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select("id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("bytes"), F.sha1(html).alias("digest"))
    watched = known if seen is None else known.observe(seen, F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    heads = watched.filter(F.col("bytes") >= min_bytes).groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"), F.max("url").alias("url"))
    top = F.max(F.struct("id", "url", "n")).alias("top")
    first = heads.groupBy("digest").agg(top, F.sum("n").alias("n")).filter("n > 1 AND top.id IS NOT NULL")
    first = cut(first.select("digest", F.col("top.id").alias("original"), F.col("top.url").alias("original_url"), F.col("top.n").alias("ties")))
    if first.count() <= broadcast_rows:
        joined = known.join(F.broadcast(first), "digest", "left")
    else:
        repeats = F.coalesce(_may_repeat(first), F.lit(True))
        alone = known.filter(~repeats).select("digest", "id", "url", "html", "bytes", *[F.lit(None).cast(first.schema[c].dataType).alias(c) for c in first.columns[1:]])
        joined = known.filter(repeats).join(first, "digest", "left").unionByName(alone)
    tied = F.coalesce((F.col("ties") > 1) & (F.col("id") == F.col("original")), F.lit(False))
    if first.filter("ties > 1").isEmpty():
        return joined.withColumn("copy", F.lit(0))
    numbered = joined.filter(tied).withColumn("copy", F.row_number().over(W.partitionBy("digest", "id").orderBy("url")) - 1)
    return joined.filter(~tied).withColumn("copy", F.lit(0)).unionByName(numbered)


def _urn(*parts: Column) -> Column:
    """A record id that follows from its parts."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), *[x for k, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.lit("-" * (k > 1)), F.substring(h, k, n))], F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _clean(url: Column) -> Column:
    for code, char in ((13, "\r"), (10, "\n"), (0, "\0")):
        url = F.replace(url, F.lit(char), F.lit(f"%{code:02X}"))
    return url


def records(known: DataFrame, date: str) -> DataFrame:
    """One column, ``value``: a WARC record without the blank line that ends it.

    An original's record id follows from page and payload, so that revisits can name it; all others
    get ids of their own, also where page and payload are the same.
    """
    revisit = F.col("original").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("original")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", F.when(F.coalesce((F.col("id") == F.col("original")) & (F.col("copy") == 0), F.lit(False)), _urn(F.col("id"), F.col("digest"))).otherwise(_urn(F.col("id"), F.col("digest"), F.monotonically_increasing_id()))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _clean(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("X-Page-ID", F.col("id").cast("string")),
        F.when(revisit, F.concat(_field("WARC-Profile", F.lit(PROFILE)), _field("WARC-Refers-To", _urn(F.col("original"), F.col("digest"))), _field("WARC-Refers-To-Target-URI", _clean(F.col("original_url"))))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return known.select(F.concat(head, http, F.when(revisit, "").otherwise(F.col("html"))).alias("value"))


def with_info(found: DataFrame, date: str, records_per_file: int) -> DataFrame:
    """The records, the first of each file with a warcinfo record before it: files are cut after so many rows of a task."""
    number = F.monotonically_increasing_id()
    fields = "software: glossa\r\nformat: WARC File Format 1.1\r\n"
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: warcinfo\r\n"), _field("WARC-Record-ID", _urn(F.lit("warcinfo"), F.lit(date), number)), _field("WARC-Date", F.lit(date)))
    info = F.concat(head, F.lit(f"Content-Type: application/warc-fields\r\nContent-Length: {len(fields)}\r\n\r\n{fields}\r\n\r\n"))
    first = number.bitwiseAND(F.lit((1 << 33) - 1)) % records_per_file == 0  # the lower bits count a task's rows
    return found.select(F.when(first, F.concat(info, F.col("value"))).otherwise(F.col("value")).alias("value"))


def write_archives(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES, date: str | None = None, records_per_file: int | None = None, file_bytes: int = FILE_BYTES, broadcast_rows: int = BROADCAST_ROWS) -> None:
    """Writes the pages as gzipped WARC files into the folder ``path``; ``date`` is now if it isn't given.

    Files are cut after ``records_per_file`` records, or else after as many as have ``file_bytes`` on average.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    plain = pages.select(pages[page_id].alias("id"), pages[url].cast("string").alias("url"), pages[html].cast("string").alias("html"))
    seen = Observation()
    known = with_originals(plain, min_bytes, broadcast_rows, seen)
    if records_per_file is None:
        records_per_file = max(1, file_bytes * seen.get["n"] // max(1, seen.get["bytes"] or 0))
    out = with_info(records(known, date), date, records_per_file)
    out.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError("no WARC record where one should begin")
            continue
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a WARC record is cut off")
        yield head, block


def read_archives(spark: SparkSession, path: str, *, payloads: bool = False) -> DataFrame:
    """One row for each record of the WARC files in ``path``; response digests are those of the payload as read."""
    schema = HEAD.append(pa.field("payload", pa.binary())) if payloads else HEAD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows, size = [], 0
                raw = batch.column(0)[k].as_buffer()
                with gzip.GzipFile(fileobj=pa.BufferReader(raw)) as stream:
                    for head, block in parsed(io.BufferedReader(stream, 1 << 16)):
                        if head["warc-type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        sizes = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                        full = head["warc-type"] == "response"
                        rows.append(
                            {
                                "record_id": head["warc-record-id"],
                                "page_id": head.get("x-page-id"),
                                "url": head.get("warc-target-uri"),
                                "record_type": head["warc-type"],
                                "refers_to": head.get("warc-refers-to"),
                                "payload_bytes": len(payload) if full else sizes[0],
                                "payload_digest": hashlib.sha1(payload).hexdigest() if full else head["warc-payload-digest"].removeprefix("sha1:"),
                                "payload": payload if full else None,
                            }
                        )
                        size += len(payload) * payloads + 500
                        if size > 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ddl = "record_id string, page_id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string" + ", payload binary" * payloads
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, ddl)


def resolved(found: DataFrame) -> DataFrame:
    """The records with ``original_id``: the page whose response a revisit refers to.

    Only responses with a payload that is revisited are joined: their table has one row for each.
    """
    named = found.filter("record_type = 'revisit'").select(F.col("refers_to").alias("named"), F.col("payload_digest").alias("digest")).distinct()
    originals = found.filter("record_type = 'response'").join(named, (F.col("record_id") == F.col("named")) & (F.col("payload_digest") == F.col("digest")), "left_semi")
    one = cut(originals.groupBy(F.col("record_id").alias("named")).agg(F.max("page_id").alias("original_id")))
    return found.join(one, found["refers_to"] == one["named"], "left").drop("named")


def round_trip(pages: DataFrame, *, page_id: str = "page_id", path: str | None = None, **options) -> DataFrame:
    """Writes archives (to the shared folder unless a path is given), reads them back and resolves revisits."""
    spark = pages.sparkSession
    path = path or shared_dir(spark)
    write_archives(pages, path, page_id=page_id, **options)
    kind = pages.schema[page_id].dataType
    back = resolved(cut(read_archives(spark, path)))
    return back.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("original_id").cast(kind)).drop("original_id")
