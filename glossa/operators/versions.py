"""Versions of pages and differences of inventories: latest flags, parallel links, diffs, lookups."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossa.operators import scans
from glossa.operators.scans import fresh
from glossa.sources.shared import stored


def _earlier_than(rows: DataFrame, iso: str, key: str, seq: str) -> Column:
    """The smallest later sequence number of a superseding row with the same language and key.

    Rows without a key are no group: each gets a partition of its own, so they don't meet in one task.
    The window runs from the last row to the first: Spark carries a sum over what came before on from
    row to row, but takes one over what follows anew for each row, so a key's square of rows.
    """
    own = F.when(F.coalesce(F.length(key), F.lit(0)) == 0, F.col(seq))
    window = W.partitionBy(iso, key, own).orderBy(F.col(seq).desc()).rowsBetween(W.unboundedPreceding, -1)
    return F.min(F.when(F.col("_supersedes"), F.col(seq))).over(window)


def with_superseded(pages: DataFrame, *, iso: str = "iso", url: str = "url", canonical: str = "canonical_link", seq: str = "ingest_seq", success: str = "success", latest: str | None = None) -> DataFrame:
    """The pages with ``superseded_seq`` and ``latest``.

    A successful page with a canonical link supersedes each earlier page of its language that has
    the same canonical link or the same URL.  The two keys are two windows, not a join, so nothing
    multiplies.  ``latest`` names a column that says which rows were inserted as latest at all.
    """
    rows = pages.withColumn("_supersedes", F.coalesce(F.col(success), F.lit(False)) & F.coalesce(F.length(canonical) > 0, F.lit(False)))
    by_link = F.when(F.coalesce(F.length(canonical) > 0, F.lit(False)), _earlier_than(rows, iso, canonical, seq))
    by_url = F.when(F.col(url).isNotNull(), _earlier_than(rows, iso, url, seq))
    found = rows.withColumn("_by_link", by_link).withColumn("_by_url", by_url).withColumn("superseded_seq", F.least("_by_link", "_by_url"))
    inserted = F.coalesce(F.col(latest), F.lit(True)) if latest else F.lit(True)
    return found.withColumn("latest", F.col("superseded_seq").isNull() & inserted).drop("_supersedes", "_by_link", "_by_url")


class _Living:
    """For each language the rows that can still be an answer, the latest on top.

    A later row that lives as long makes an earlier one useless, and one that has died is dropped
    when it comes up; so every row is put on a stack and taken off it once.
    """

    def __init__(self) -> None:
        self.stacks: dict[str, list[tuple]] = {}

    def add(self, iso: str, row: tuple) -> None:
        """``row``: (seq, url, until)."""
        stack = self.stacks.setdefault(iso, [])
        while stack and (row[2] is None or stack[-1][2] is not None and stack[-1][2] <= row[2]):
            stack.pop()
        stack.append(row)

    def last(self, iso: str, seq: int) -> tuple | None:
        """The last row of another language that lives at ``seq``."""
        best = None
        for other, stack in self.stacks.items():
            while stack and stack[-1][2] is not None and stack[-1][2] <= seq:
                stack.pop()
            if other != iso and stack and (best is None or stack[-1][0] > best[0]):
                best = stack[-1]
        return best

    def rows(self) -> list[tuple]:
        return [(iso, *row) for iso, stack in self.stacks.items() for row in stack]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range its first and last key, and what lives of the last one when the range ends."""
    at, first, key, living = None, None, None, _Living()

    def ended() -> Iterator[pa.RecordBatch]:
        if at is not None:
            rows = living.rows() or [(None, None, None, None)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(at, pa.int32()), len(rows)), pa.repeat(first, len(rows)), pa.repeat(key, len(rows)), *columns], ["part", "first", "last", "iso", "seq", "url", "until"])

    for batch in batches:
        for part, value, seq, iso, url, until in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if part != at:
                yield from ended()
                at, first = part, value
                key = None
            if value != key:
                key, living = value, _Living()
            if iso is not None:
                living.add(iso, (seq, url, until))
    yield from ended()


def _carried(ends: pd.DataFrame) -> pd.DataFrame:
    """What lives of a key when each of its ranges begins; ``ends``: the ranges that it begins or ends, one or more rows each."""
    out, living = [], _Living()
    for part, rows in ends.sort_values(["part", "seq"]).groupby("part", sort=True):
        key = rows["key"].iloc[0]
        if (rows["first"] == key).any():
            out += [(part, key, *row) for row in living.rows()]
        if (rows["last"] == key).any():
            if not (rows["first"] == key).any():
                living = _Living()
            for iso, seq, url, until in zip(rows["iso"], rows["seq"], rows["url"], rows["until"], strict=True):
                if iso is not None and not pd.isna(seq):
                    living.add(iso, (int(seq), url, None if pd.isna(until) else int(until)))
    frame = pd.DataFrame(out, columns=["part", "key", "iso", "seq", "url", "until"])
    return frame.astype({"seq": "Int64", "until": "Int64"})


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seq, url): for each row that links, the last living one; carried rows come first in their range and ask nothing."""
    at, living = None, _Living()
    for batch in batches:
        found, urls = [], []
        for part, value, seq, iso, url, until, links in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
            if (part, value) != at:
                at, living = (part, value), _Living()
            if iso is None:
                continue
            if links and (best := living.last(iso, seq)) is not None:
                found.append(seq)
                urls.append(best[1])
            living.add(iso, (seq, url, until))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(urls, pa.string())], ["of", "found"])


def _last_living(rows: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """(of, found): for each row that links, the URL of the last earlier row of another language with the same key that still lives.

    Rows are cut into ranges of key and sequence number, so a key may fill many tasks.  A first pass
    finds what of a range's last key lives when the range ends; these few rows are put together for
    the ranges that the key goes on in, and stand before their rows in the second pass.
    """
    keyed = rows.filter(F.coalesce(F.length(key) > 0, F.lit(False))).select(F.col(key).alias("key"), "seq", "iso", "url", "until", "links")
    found, part, _ = scans.in_ranges(keyed, [F.col("key"), F.col("seq")], ranges)
    by_range = found.withColumnRenamed(part, "part").select("part", "key", "seq", "iso", "url", "until", "links")
    ordered = by_range.drop("links").repartition("part").sortWithinPartitions("part", "key", "seq")
    ends = stored(ordered.mapInArrow(_ends, "part int, first string, last string, iso string, seq bigint, url string, until bigint"))
    touched = ends.select("*", F.explode(F.array_distinct(F.array("first", "last"))).alias("key"))
    carried = touched.groupBy("key").applyInPandas(_carried, "part int, key string, iso string, seq bigint, url string, until bigint")
    all_rows = by_range.union(carried.withColumn("links", F.lit(False)).select(*by_range.columns))
    return all_rows.repartition("part").sortWithinPartitions("part", "key", "seq").mapInArrow(_answers, "of bigint, found string")


def with_parallel(pages: DataFrame, *, iso: str = "iso", url: str = "url", canonical: str = "canonical_link", seq: str = "ingest_seq", success: str = "success", ranges: int | None = None) -> DataFrame:
    """The pages with ``parallel_url``: the last earlier page of another language, still latest then.

    Matches by URL come before matches by canonical link.  Sequence numbers are whole numbers.
    """
    rows = with_superseded(pages, iso=iso, url=url, canonical=canonical, seq=seq, success=success)
    links = F.coalesce(F.col(success), F.lit(False)) & F.coalesce(F.length(canonical) > 0, F.lit(False))
    known = rows.select(F.col(seq).cast("bigint").alias("seq"), F.col(iso).cast("string").alias("iso"), F.col(url).alias("url"), F.col(canonical).alias("link"), F.col("superseded_seq").cast("bigint").alias("until"), links.alias("links"))
    out = rows
    hits = {key: fresh(f"hit_{key}", rows) for key in ("url", "link")}
    for key, hit in hits.items():
        of = fresh("of", out)
        out = out.join(_last_living(known, key, ranges).toDF(of, hit), F.col(seq) == F.col(of), "left").drop(of)
    return out.withColumn("parallel_url", F.coalesce(*hits.values())).drop(*hits.values())


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return capped_per_key(rows, keys, order, 1)


def capped_per_key(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """At most n rows of each key, in order (Spark prunes the groups before the shuffle)."""
    window = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= n).drop("_n")


def sampled_per_key(rows: DataFrame, keys: list[str], ident: str, n: int, seed: int = 0) -> DataFrame:
    """A repeatable sample of at most n rows of each key, by hash."""
    return capped_per_key(rows, keys, [F.md5(F.concat_ws(":", F.lit(seed), F.col(ident)).cast("binary")), F.col(ident)], n)


def added(early: DataFrame, late: DataFrame, *, iso: str = "iso", url: str = "url") -> DataFrame:
    """Pages of the later inventory that the earlier one lacks, in languages that both have."""
    languages = early.select(iso).distinct()
    return late.join(early.select(iso, url), [iso, url], "left_anti").join(languages, iso, "left_semi")


def lost(early: DataFrame, late: DataFrame, *, iso: str = "iso", url: str = "url") -> DataFrame:
    """Pages of the earlier inventory that the later one lacks; a language that is gone has lost all of them."""
    return early.join(late.select(iso, url), [iso, url], "left_anti")


def new_languages(early: DataFrame, late: DataFrame, *, iso: str = "iso") -> DataFrame:
    return late.select(iso).subtract(early.select(iso))


def refreshed(rows: DataFrame, source: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The rows with a column taken from a lookup table where that has the key (one row for each key)."""
    lookup = source.groupBy(*keys).agg(F.max(column).alias("_new"))
    return rows.join(lookup, keys, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def of_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return rows.join(ids, key, "left_semi")


def latest_snapshots(listing: DataFrame, *, url: str = "original_url", snapshot: str = "snapshot") -> DataFrame:
    """The last snapshot of each URL, a default port removed first."""
    plain = listing.withColumn(url, F.replace(F.col(url), F.lit(":80"), F.lit("")))
    return plain.groupBy(url).agg(F.max(snapshot).alias(snapshot))


def distinct_with_null(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values, nulls counting as one."""
    return rows.agg((F.countDistinct(column) + F.max(F.col(column).isNull().cast("int"))).alias(name))


def languages_of(*inventories: DataFrame, iso: str = "iso", more: tuple[str, ...] = ()) -> DataFrame:
    """The languages of several inventories, each once, and those that are named besides (also where they are there already)."""
    found = inventories[0].select(iso)
    for other in inventories[1:]:
        found = found.union(other.select(iso))
    extra = [found.sparkSession.range(1).select(F.lit(x).alias(iso)) for x in more]
    out = found.distinct()
    for x in extra:
        out = out.union(x)
    return out
