"""Latest versions by keyed state: each micro-batch reads its own rows and the state of their keys only.

A successful page with a canonical link supersedes the earlier pages of its language with the same
link or the same URL, so every page is an event under its link and one under its URL.  The state of
a key has the sequence numbers seen so far with a flag for those that supersede, sorted and in
chunks of at most ``CHUNK``; an index tells each chunk's first number and its first and last one
that supersedes.  A new page reads the chunk that it belongs to, finds what supersedes it by the
index, and touches the pages between the superseding one before it and itself: these are the rows
whose answer changes, and they are the output.  So a key may have any number of pages: a batch costs
time in proportion to its rows and to its changes, and pages may come late, again, or in any order.

The changes are a table of (sequence number, superseded by); the smallest one of a page holds.

Defined cases: pages without a link, or without a URL, have no event there; languages that are null
are one language; a sequence number that comes again under the same key changes nothing; null
sequence numbers are left out.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Sequence numbers in a chunk of a key's state.
CHUNK = 1024
CHANGES = "seq bigint, superseded_seq bigint"


class Sequence:
    """The sorted numbers of one key in chunks that are read when they are needed.

    ``heads``: (number of the chunk, first, first superseding or None, last superseding or None).
    """

    def __init__(self, heads: list[list], load, size: int = CHUNK):
        self.heads, self.load, self.size = heads, load, size
        self.chunks: dict[int, tuple[list[int], list[bool]]] = {}
        self.changed: set[int] = set()

    def _chunk(self, at: int) -> tuple[list[int], list[bool]]:
        no = self.heads[at][0]
        if no not in self.chunks:
            self.chunks[no] = self.load(no)
        return self.chunks[no]

    def _described(self, at: int) -> None:
        no = self.heads[at][0]
        seqs, flags = self.chunks[no]
        marks = [s for s, f in zip(seqs, flags, strict=True) if f]
        self.heads[at] = [no, seqs[0], marks[0] if marks else None, marks[-1] if marks else None]
        self.changed.add(no)

    def _place(self, seq: int) -> int:
        """Where the chunk is that has the number, or would have it."""
        return max(bisect_right([h[1] for h in self.heads], seq) - 1, 0)

    def _mark(self, seq: int, later: bool) -> int | None:
        """The next superseding number after ``seq``, or the last one before it."""
        if not self.heads:
            return None
        at = self._place(seq)
        seqs, flags = self._chunk(at)
        if later:
            inside = [s for s, f in zip(seqs, flags, strict=True) if f and s > seq]
            return inside[0] if inside else next((h[2] for h in self.heads[at + 1 :] if h[2] is not None), None)
        inside = [s for s, f in zip(seqs, flags, strict=True) if f and s < seq]
        return inside[-1] if inside else next((h[3] for h in reversed(self.heads[:at]) if h[3] is not None), None)

    def _between(self, low: int | None, high: int) -> Iterator[int]:
        """The numbers from ``low`` on and below ``high``."""
        at = self._place(low) if low is not None else 0
        while at < len(self.heads) and self.heads[at][1] < high:
            for s in self._chunk(at)[0]:
                if (low is None or s >= low) and s < high:
                    yield s
            at += 1

    def add(self, seq: int, supersedes: bool) -> list[tuple[int, int]]:
        """Takes a number in; the numbers whose answer changes, and by what they are superseded now."""
        if not self.heads:
            self.heads.append([0, seq, None, None])
            self.chunks[0] = ([seq], [supersedes])
            self._described(0)
            return []
        at = self._place(seq)
        seqs, flags = self._chunk(at)
        k = bisect_left(seqs, seq)
        if k < len(seqs) and seqs[k] == seq:
            return []
        later = self._mark(seq, later=True)
        out = [] if later is None else [(seq, later)]
        if supersedes:
            # the one before superseded all that came before it
            out += [(s, seq) for s in self._between(self._mark(seq, later=False), seq)]
        seqs.insert(k, seq)
        flags.insert(k, supersedes)
        self._described(at)
        if len(seqs) > self.size:
            half, no = len(seqs) // 2, max(h[0] for h in self.heads) + 1
            self.chunks[no] = (seqs[half:], flags[half:])
            del seqs[half:], flags[half:]
            self.heads.insert(at + 1, [no, 0, None, None])
            self._described(at)
            self._described(at + 1)
        return out


class Superseded(StatefulProcessor):
    """Rows (seq, supersedes) of a key to the changes that they make."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.index = handle.getValueState("index", "no array<bigint>, least array<bigint>, first array<bigint>, last array<bigint>")
        self.chunks = handle.getMapState("chunks", "no bigint", "seqs array<bigint>, flags array<boolean>")

    def _load(self, no: int) -> tuple[list[int], list[bool]]:
        seqs, flags = self.chunks.getValue((no,))
        return list(seqs), list(flags)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.index.get()
        numbers = Sequence([list(h) for h in zip(*held, strict=True)] if held is not None else [], self._load)
        for frame in rows:
            changes = []
            for seq, supersedes in sorted(zip(frame["seq"].tolist(), frame["supersedes"].tolist(), strict=True)):
                changes += numbers.add(seq, supersedes)
            if changes:
                yield pd.DataFrame(changes, columns=["seq", "superseded_seq"])
        for no in sorted(numbers.changed):
            self.chunks.updateValue((no,), numbers.chunks[no])
        if numbers.changed:
            self.index.update(tuple(list(column) for column in zip(*numbers.heads, strict=True)))

    def close(self) -> None:
        pass


def events(pages: DataFrame, *, iso: str = "iso", url: str = "url", canonical: str = "canonical_link", seq: str = "ingest_seq", success: str = "success") -> DataFrame:
    """(kind, iso, key, seq, supersedes): a row for each page's link and one for its URL."""
    has_link = F.coalesce(F.length(canonical) > 0, F.lit(False))
    supersedes = F.coalesce(F.col(success), F.lit(False)) & has_link
    keys = F.array(F.struct(F.lit("link").alias("kind"), F.col(canonical).alias("key")), F.struct(F.lit("url").alias("kind"), F.col(url).alias("key")))
    rows = pages.select(F.coalesce(F.concat(F.lit("="), F.col(iso).cast("string")), F.lit("")).alias("iso"), F.col(seq).cast("bigint").alias("seq"), supersedes.alias("supersedes"), F.explode(keys).alias("of"))
    return rows.filter("seq IS NOT NULL AND length(of.key) > 0").select("of.kind", "iso", "of.key", "seq", "supersedes")


def follow(spark: SparkSession, source: str, schema: str, changes: str, checkpoint: str, *, files_per_batch: int = 100, **columns: str) -> StreamingQuery:
    """Reads new Parquet files below ``source`` and appends to the table ``changes`` what they change; goes on from ``checkpoint``.

    A batch that runs again after a failure starts from the state before it and replaces its rows.
    """

    def append(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("_batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(changes)

    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    changed = events(pages, **columns).groupBy("kind", "iso", "key").transformWithStateInPandas(Superseded(), CHANGES, outputMode="Append", timeMode="None")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # a query takes the settings of its start
    try:
        return changed.writeStream.foreachBatch(append).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before)


def current(versions: DataFrame, changes: str, *, seq: str = "ingest_seq", latest: str | None = None) -> DataFrame:
    """The versions with ``superseded_seq`` and ``latest`` by the table of changes; ``latest`` names a column that says which were inserted as latest at all."""
    found = versions.sparkSession.read.schema(f"{CHANGES}, _batch int").parquet(changes)
    found = found.groupBy("seq").agg(F.min("superseded_seq").alias("superseded_seq"))
    rows = versions.drop("superseded_seq")
    out = rows.join(found, F.col(seq) == found["seq"], "left").select(*[rows[c] for c in rows.columns if c != "latest" or latest == "latest"], found["superseded_seq"])
    inserted = F.coalesce(F.col(latest), F.lit(True)) if latest else F.lit(True)
    return out.withColumn("latest", F.col("superseded_seq").isNull() & inserted)
