"""Phrase collocation mining: frequent word n-grams, packed as ids, sorted by radix and counted by run length.

1. Words are counted by language where the texts are read, in vectorised chunks, and summed by one
   shuffle.  Those with at least ``least`` occurrences are the dictionary: each (language, word) has
   an id below 2^32, the most frequent first, given by a distributed rank.
2. The texts are encoded once: runs of ids, broken at piece marks, at ends of documents and at words
   outside the dictionary (no phrase with such a word is frequent).  The dictionary is sent to the
   tasks in blocks of at most ``BLOCK`` words; a longer one takes more passes, each of which fills
   in the words of its block.
3. For n = 2, 3, ... the ids' n-grams are packed into keys of 4n bytes, sorted in each chunk by a
   least-significant-digit radix sort and counted by runs; the counted keys are range-partitioned
   and sorted by Spark (which sorts by the radix of its key prefixes, and spills), and equal
   neighbours are summed in one streaming pass.  An n-gram occurs at most as often as its parts, so
   those whose parts are not frequent are left out: a bit table of fixed size, made of the frequent
   (n-1)-grams, never misses one, and what it lets through wrongly the exact count removes.
4. Frequent n-grams are joined with the counts of their parts for each cut, and with the most
   frequent longer one that contains them; what is left is decoded and ranked by language in ranges
   of the order, so a language may have any share of the phrases.

No table of all phrases is in one task or on the driver: it sees a block of the dictionary and the
words of the bit table.  Scores are computed in decimals of 28 digits and floored.

Defined cases: a null text is empty; a null language is ``und``, like that name itself; repeated
rows count each; a text may be of any length (a chunk has whole texts); ties in score and count go
by the phrase's UTF-8 bytes; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Scratch, cut
from glossa.operators.scans import ranked

LEAST, LONGEST, CONTAINED, TOP = 30, 4, 80, 2000
#: Bytes of text, and ids, that a task holds as arrays at a time (or one text, if that is longer).
CHUNK_BYTES, CHUNK_IDS = 8 << 20, 1 << 20
#: Words of the dictionary that a task holds at a time, and bits of the table of frequent n-grams (8 MB).
BLOCK, FILTER_BITS = 500_000, 26
#: A table of at most so many counts or words is broadcast; a longer one is shuffled, single words with salts.
BROADCAST_ROWS, SALTS = 200_000, 16
UNKNOWN = "und"

#: Classes of bytes: 0 in a word, 1 between words, 2 between pieces; and A-Z in lower case.
_CLASS = np.array([2 if c in b".,;:!?" or 10 <= c <= 13 else 1 if c in b" \t" else 0 for c in range(256)], np.uint8)
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def _binary(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, each word's piece (no two texts share one), and how many words each text has."""
    whole = pc.binary_join_element_wise(texts.cast(pa.binary()), b"\n", b"", null_handling="replace")
    at = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    kind = _CLASS[raw]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[0::2], edges[1::2]
    words = _binary(_LOWER[raw[inside]], np.concatenate([[0], np.cumsum(ends - starts)]), pa.string())
    pieces = np.searchsorted(np.flatnonzero(kind == 2), starts)
    return words, pieces, np.diff(np.searchsorted(starts, at - at[0]))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """(language, rows of that language) with at most CHUNK_BYTES of text, or one row."""
    for batch in batches:
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            rows = batch.filter(pc.equal(langs, lang))
            sizes = np.cumsum(pc.fill_null(pc.binary_length(rows.column("text")), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < rows.num_rows:
                before = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, before + CHUNK_BYTES, "right")))
                yield lang, rows.slice(at, to - at)
                at = to


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, word, n); the row without a word has the number of all."""
    for lang, rows in _chunks(batches):
        counts = words_of(rows.column("text"))[0].value_counts()
        words, n = counts.field("values"), counts.field("counts")
        all_words = pa.concat_arrays([words, pa.nulls(1, pa.string())])
        sums = pa.concat_arrays([n, pa.array([pc.sum(n).as_py() or 0], pa.int64())])
        yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(sums)), all_words, sums], ["lang", "word", "n"])


def _runs(ids: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """The ids in runs of two or more, a 0 behind each run; 0 stands for a word outside the dictionary."""
    known = np.flatnonzero(ids)
    if not len(known):
        return ids[:0]
    follows = (np.diff(known) == 1) & (np.diff(pieces[known]) == 0)
    # neighbours in a run on either side
    behind, before = np.append(follows, False), np.insert(follows, 0, False)
    stays = behind | before
    left, last = ids[known][stays], ~behind[stays]
    out = np.zeros(len(left) + int(last.sum()), np.uint32)
    out[np.arange(len(left)) + np.cumsum(last) - last] = left
    return out


def _encoder(sent, first: bool, last: bool):
    """Rows (lang, text[, ids]) to the same with this block's ids filled in, or to their runs of ids after the last block.

    ``sent``: the block's words and their ids by language, broadcast.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, rows in _chunks(batches):
            words, pieces, counts = words_of(rows.column("text"))
            ids = np.zeros(len(words), np.uint32)
            if lang in sent.value:
                known, numbers = sent.value[lang]
                found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()
                ids = np.where(found >= 0, numbers[found], 0).astype(np.uint32)
            if not first:
                held = rows.column("ids").flatten().to_numpy().view(np.uint32)
                ids = np.where(held > 0, held, ids)
            if last:
                ids = _runs(ids, pieces)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids.view(np.int32)))], ["ids"])
            else:
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.RecordBatch.from_arrays([rows.column("lang"), rows.column("text"), pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32)))], ["lang", "text", "ids"])

    return encoded


def encoded(texts: DataFrame, dictionary: DataFrame, own: Scratch, block: int = BLOCK) -> DataFrame:
    """Rows of ids: runs of frequent words, a 0 behind each."""
    spark, n = texts.sparkSession, dictionary.count()
    if n >= (1 << 32) - 1:
        raise ValueError("more frequent words than ids of 32 bits")
    passes = max(1, -(-n // block))
    rows = texts
    for k in range(passes):
        words = dictionary.filter(F.col("id").between(k * block + 1, (k + 1) * block)).select("lang", "word", "id").toArrow().combine_chunks()
        of = {}
        for lang in pc.unique(words.column("lang")).to_pylist():
            mine = words.filter(pc.equal(words.column("lang"), lang))
            of[lang] = (mine.column("word").combine_chunks().cast(pa.string()), mine.column("id").to_numpy().astype(np.uint32))
        last = k == passes - 1
        sent = spark.sparkContext.broadcast(of)
        rows = own.cut(rows.mapInArrow(_encoder(sent, k == 0, last), "ids array<int>" if last else "lang string, text string, ids array<int>"))
        sent.destroy()
    return rows


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order of rows of unsigned 32-bit numbers: one stable pass for each 16-bit digit (numpy sorts these by radix), last digit first."""
    order = np.arange(len(keys))
    for column in range(keys.shape[1] - 1, -1, -1):
        for shift in (0, 16):
            digit = (keys[:, column] >> np.uint32(shift)).astype(np.uint16)
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def _counted_runs(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each key of a sorted list once, with the sum of its counts."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return keys[at], np.diff(at, append=len(keys)) if counts is None else np.add.reduceat(counts, at)


def _packed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    width = 4 * keys.shape[1]
    data = _binary(keys.astype(">u4").view(np.uint8).reshape(-1), np.arange(len(keys) + 1, dtype=np.int64) * width, pa.binary())
    return pa.RecordBatch.from_arrays([data, pa.array(counts.astype(np.int64))], ["key", "f"])


def _unpacked(column: pa.Array, n: int) -> np.ndarray:
    width = 4 * n
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return raw[at : at + width * len(column)].view(">u4").reshape(-1, n).astype(np.uint32)


def _bits(keys: np.ndarray, bits: int) -> np.ndarray:
    """Each key's place in the bit table."""
    mixed = np.zeros(len(keys), np.uint64)
    for column in keys.T:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)


def bit_table(frequent: DataFrame, n: int, bits: int = FILTER_BITS) -> np.ndarray:
    """A table of 2^bits bits with those of the frequent n-grams set."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.unique(_bits(_unpacked(batch.column("key"), n), bits)).astype(np.int64)
                word, first = np.unique(at >> 5, return_index=True)
                value = np.bitwise_or.reduceat(np.int64(1) << (at & 31), first)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value)], ["word", "bits"])

    rows = frequent.select("key").mapInArrow(words, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = rows.toArrow()  # at most 2^(bits - 5) rows, whatever the input
    table = np.zeros(1 << max(bits - 5, 0), np.uint32)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return table


def _gram_counter(n: int, sent, bits: int):
    """Rows of ids to (key, f): the n-grams whose parts may be frequent, sorted and counted in each chunk."""

    def grams(ids: np.ndarray) -> np.ndarray:
        places = len(ids) - n + 1
        whole = np.ones(max(places, 0), bool)
        for k in range(n):
            whole &= ids[k : k + places] > 0
        at = np.flatnonzero(whole)
        keys = np.stack([ids[at + k] for k in range(n)], axis=1)
        for part in () if sent is None else (slice(0, -1), slice(1, None)):
            bit = _bits(keys[:, part], bits).astype(np.int64)
            keys = keys[(sent.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 > 0]
        return keys

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = grams(np.concatenate(held)) if held else np.zeros((0, n), np.uint32)
            if len(keys):
                yield _packed(*_counted_runs(keys[radix_order(keys)]))

        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("ids").slice(k, 1).flatten().to_numpy().view(np.uint32)
                held.append(ids)
                size += len(ids)
                if size >= CHUNK_IDS:
                    yield from flush()
                    held, size = [], 0
        yield from flush()

    return counted


def _run_lengths(n: int, least: int):
    """Sorted (key, f) to the keys whose sums reach ``least``; a run may go on in the next batch."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, counts = _unpacked(batch.column("key"), n), batch.column("f").to_numpy()
            if key is not None:
                keys, counts = np.concatenate([key, keys]), np.concatenate([[count], counts])
            keys, counts = _counted_runs(keys, counts)
            key, count = keys[-1:], counts[-1]
            often = counts[:-1] >= least
            if often.any():
                yield _packed(keys[:-1][often], counts[:-1][often])
        if key is not None and count >= least:
            yield _packed(key, np.array([count]))

    return summed


def frequent_grams(ids: DataFrame, n: int, shorter: DataFrame | None, least: int, own: Scratch, bits: int = FILTER_BITS) -> DataFrame:
    """(key, f) of the n-grams with at least ``least`` occurrences; ``shorter``: the frequent (n-1)-grams."""
    spark = ids.sparkSession
    sent = None if shorter is None else spark.sparkContext.broadcast(bit_table(shorter, n - 1, bits))
    counted = ids.mapInArrow(_gram_counter(n, sent, bits), "key binary, f bigint")
    # the ranges' bounds are sampled first, so counting runs twice; writing it out would cost more
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = counted.repartitionByRange(ranges, "key").sortWithinPartitions("key")
    out = own.cut(ordered.mapInArrow(_run_lengths(n, least), "key binary, f bigint"))
    if sent is not None:
        sent.destroy()
    return out


def _with(rows: DataFrame, key: str, table: DataFrame, few: bool) -> DataFrame:
    """The rows with the table's row of their key; single words, which many phrases share, are spread over salts where the table is shuffled."""
    table = table.withColumnRenamed("key", "_of")
    if few:
        return rows.join(F.broadcast(table), F.col(key) == F.col("_of")).drop("_of")
    single = lambda c: F.octet_length(c) == 4
    spread = table.withColumn("_salt", F.explode(F.when(single("_of"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    salt = F.when(single(key), F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0).cast("int")
    return rows.join(spread, (F.col(key) == F.col("_of")) & (salt == F.col("_salt"))).drop("_of", "_salt")


def _part(start: Column | int, words: Column | int) -> Column:
    start, words = (F.lit(x) if isinstance(x, int) else x for x in (start, words))
    return F.substring(F.col("phrase"), start * 4 + 1, words * 4)


def mine(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    contained: int = CONTAINED,
    top: int = TOP,
    block: int = BLOCK,
    bits: int = FILTER_BITS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words."""
    texts = docs.select(F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"), docs[text].cast("string").alias("text")).filter("text != ''")
    with Scratch(docs.sparkSession) as own:
        counts = texts.mapInArrow(_counted_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
        counts = own.cut(counts.filter((F.col("n") >= least) | F.col("word").isNull()))
        totals = counts.filter("word IS NULL").select(F.col("lang").alias("of"), F.col("n").alias("all"))
        words = ranked(counts.filter("word IS NOT NULL"), [F.col("n").desc(), F.col("lang"), F.col("word")], "id")
        words = own.cut(words.withColumn("id", F.col("id") + 1))
        ids = encoded(texts, words, own, block)

        singles = words.select(F.unhex(F.lpad(F.hex("id"), 8, "0")).alias("key"), "lang", "word", F.col("n").alias("f"))
        grams, known = [], singles.select("key", "f")
        for n in range(2, longest + 1):
            grams.append(frequent_grams(ids, n, grams[-1] if grams else None, least, own, bits))
            known = known.union(grams[-1])
        found = grams[0] if grams else known.limit(0)
        for more in grams[1:]:
            found = found.union(more)
        found = found.select(F.col("key").alias("phrase"), F.col("f").alias("a")).withColumn("size", F.expr("octet_length(phrase) div 4").cast("int"))

        # a phrase goes if one that contains it is nearly as frequent
        longer = found.filter("size > 2").withColumn("words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        longer = longer.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("words"))))
        longer = longer.groupBy(_part(F.col("start"), F.col("words")).alias("inner")).agg(F.max("a").alias("longer"))
        kept = found.join(longer, F.col("phrase") == F.col("inner"), "left").filter(f"longer IS NULL OR 100 * longer < {contained} * a").select("phrase", "a", "size")
        kept = own.cut(kept)

        few = known.limit(broadcast_rows + 1).count() <= broadcast_rows
        cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        cuts = cuts.withColumns({"first": _part(0, F.col("k")), "rest": _part(F.col("k"), F.col("size") - F.col("k"))})
        cuts = _with(cuts, "first", known.withColumnRenamed("f", "l"), few)
        cuts = _with(cuts, "rest", known.withColumnRenamed("f", "r"), few)
        score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
        scored = cuts.groupBy("phrase", "a", "size").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        scored = own.cut(scored.select("phrase", "a", "size", "cut.*"))

        few = words.limit(broadcast_rows + 1).count() <= broadcast_rows
        spelt = scored.select("phrase", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("at")).withColumn("one", _part(F.col("at"), 1))
        spelt = _with(spelt, "one", singles.select("key", "lang", "word"), few)
        spelt = spelt.groupBy("phrase", "lang").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        spelt = spelt.select(F.col("phrase").alias("spelt"), "lang", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("text"))
        named = scored.join(spelt, F.col("phrase") == F.col("spelt")).select("lang", F.col("text").alias("phrase"), "a", "l", "r", "score")
        order = [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
        first = ranked(named, order, "rank", within=("lang",)).filter(F.col("rank") < top)
        return cut(first.join(totals, F.col("lang") == F.col("of")).select("lang", (F.col("rank") + 1).alias("rank"), "phrase", "a", "l", "r", F.col("all").alias("n"), "score"))
