"""SimHash near-deduplication with pigeonhole blocks.

Fingerprints (64 bits: the majority over the hashes of all word shingles, repeats included) are
made where the documents are read and written to the shared folder; texts are not shuffled.
Distinct fingerprints are cut into five blocks.  Two that differ in at most two bits agree on at
least three blocks, so each of the ten ways to choose three blocks gives a key of some 38 bits,
and close pairs meet under one of them.  Only keys that several fingerprints share go on.

Within a shared key no pairs are made, however many fingerprints have it.  Two fingerprints differ
in at most two bits exactly if there is a value within one bit of both.  So each fingerprint is
listed under itself and under each value that one of its free bits, flipped, gives; what meets
under a value (never more than free bits + 1 fingerprints) is linked with the least of them, the
Hamming distance is verified, and components are found over these links.

For corpora, ``one_of_each`` also links texts whose whole shingle sets have a Jaccard similarity of 0.8
or more; MinHash keys find the candidates.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; a text of
fewer words than a shingle is one shingle; repeated rows are each listed; a null id is never a
component's id unless all its members' are null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossa.llm.common import Scratch, blank_words, cut, fresh, slices
from glossa.llm.components import components

WIDTHS = (13, 13, 13, 13, 12)
MAX_BITS = 2
#: MinHash functions, keys of a text, minima in each, and texts under a key of which all pairs are candidates.
#: By calculation a pair with a similarity of 0.8 shares no key with a chance below 1 in 1,000.
MINIMA, BANDS, ROWS, SMALL = 200, 100, 10, 9
#: A table of at most so many hashes is broadcast (some 20 MB in memory); a larger one is shuffled.
BROADCAST_ROWS = 500_000
_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The minima of each key: random sets, each minimum in as many of them.
_PICKED = np.sort(np.concatenate([np.random.default_rng(k).permutation(MINIMA) for k in range(BANDS * ROWS // MINIMA)]).reshape(BANDS, ROWS), axis=1)


def _blocks() -> list[int]:
    out, at = [], 0
    for width in WIDTHS:
        out.append(((1 << width) - 1) << at)
        at += width
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: The bits that stay fixed under each of the ten keys.
MASKS = tuple(sum(c) for c in combinations(_blocks(), len(WIDTHS) - MAX_BITS))


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle, repeats included; a text of fewer words is one shingle, a wordless one has none."""
    words = blank_words(text, lower=True)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    return np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in parts), dtype=np.uint64, count=max(1, len(words) - shingle + 1))


def _majority(hashes: np.ndarray) -> int:
    n, big = len(hashes), hashes.astype(">u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        counts += np.unpackbits(big[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64 (seed 42)."""
    return _majority(shingle_hashes(text, shingle))


def minhash_keys(hashes: np.ndarray) -> list[int]:
    """BANDS keys, each of the least values of ROWS hash functions over the shingles; none for a wordless text."""
    if not len(hashes):
        return []
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1 << 10):
        np.minimum(least, (_FACTORS[:, None] * hashes[None, at : at + (1 << 10)]).min(1), out=least)
    return [_signed(xxhash.xxh64_intdigest(band.tobytes(), k)) for k, band in enumerate(least[_PICKED])]


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, version: bool = False) -> DataFrame:
    """(id, print) of every row, the print as a signed 64-bit number; with ``version`` also the text's hash and its MinHash keys."""
    kind = docs.schema[doc_id].dataType.simpleString()
    body = docs[text].cast("string")
    more = [F.xxhash64(body).alias("version")] if version else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints, keys = [], []
            for x in batch.column(1).to_pylist():
                hashes = shingle_hashes(x, shingle)
                prints.append(_signed(_majority(hashes)))
                if version:
                    keys.append(minhash_keys(hashes))
            extra = {"version": batch.column(2), "keys": pa.array(keys, pa.list_(pa.int64()))} if version else {}
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "print": pa.array(prints, pa.int64()), **extra})

    return docs.select(docs[doc_id].alias("id"), body.alias("text"), *more).mapInArrow(run, f"id {kind}, print bigint" + ", version bigint, keys array<bigint>" * version)


def _similar(docs: DataFrame, pairs: DataFrame, *, text: str, shingle: int, similarity: float, own: Scratch) -> DataFrame:
    """The pairs (a, u, b, v), a and b being texts' hashes and u and v their prints, whose whole shingle sets are similar enough."""
    wanted = own.cut(pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [np.unique(shingle_hashes(x, shingle)).view(np.int64) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["version", "ids"])

    body = docs[text].cast("string")
    few = wanted.count() <= BROADCAST_ROWS
    found = docs.select(F.xxhash64(body).alias("version"), body.alias("text")).join(F.broadcast(wanted) if few else wanted, F.col("version") == F.col("w"), "left_semi")
    sets = own.cut(found.mapInArrow(run, "version bigint, ids array<bigint>").groupBy("version").agg(F.first("ids").alias("ids")))
    both = pairs.join(sets.withColumnsRenamed({"version": "a", "ids": "ia"}), "a").join(sets.withColumnsRenamed({"version": "b", "ids": "ib"}), "b")
    both = both.filter((F.size("ia") >= F.size("ib") * F.lit(similarity) - F.lit(1e-9)) & (F.size("ib") >= F.size("ia") * F.lit(similarity) - F.lit(1e-9)))
    common = F.size(F.array_intersect("ia", "ib"))
    return own.cut(both.filter(common >= (F.size("ia") + F.size("ib") - common) * F.lit(similarity) - F.lit(1e-9)).select("a", "u", "b", "v"))


def _flat(pairs: DataFrame) -> DataFrame:
    """Distinct (a, u, b, v) of pairs of structs x and y whose prints aren't close already."""
    apart = pairs.filter(F.bit_count(F.col("x.print").bitwiseXOR(F.col("y.print"))) > MAX_BITS)
    ordered = apart.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    return ordered.select(F.col("x.version").alias("a"), F.col("x.print").alias("u"), F.col("y.version").alias("b"), F.col("y.print").alias("v"))


def similar_links(docs: DataFrame, prints: DataFrame, *, text: str, shingle: int, similarity: float, small: int = SMALL) -> DataFrame:
    """Links (u, v) between the prints of texts with a Jaccard similarity of ``similarity`` or more over their shingles.

    Texts that share a MinHash key are candidates, and every candidate is verified on whole shingle
    sets.  Under a key of at most ``small`` texts all pairs are candidates.  Under a larger one every
    text is held against the least of them, which settles groups of near copies in as many pairs as
    there are texts; those that it doesn't settle are held against all texts of the key.  Keys are of
    many minima, so texts that aren't close rarely share one.
    """
    with Scratch(docs.sparkSession) as own:
        texts = prints.groupBy("version").agg(F.first("print").alias("print"), F.first("keys").alias("keys"))
        rows = own.cut(texts.select("version", "print", F.explode("keys").alias("key")))
        one = F.struct("version", "print")
        shared = own.cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("head")).filter("n > 1").withColumnRenamed("key", "k"))
        few = rows.join(shared.filter(F.col("n") <= small), F.col("key") == F.col("k"), "left_semi")
        order = W.partitionBy("key").orderBy("version")
        after = F.array(*[F.lead(one, k).over(order) for k in range(1, small)])
        close_by = few.select(one.alias("x"), after.alias("after")).select("x", F.explode("after").alias("y")).filter("y IS NOT NULL")
        many = own.cut(rows.join(shared.filter(F.col("n") > small), F.col("key") == F.col("k")).select("key", "version", "print", "head"))
        stars = many.select(one.alias("x"), F.col("head").alias("y")).filter("x.version <> y.version")
        links = _similar(docs, own.cut(_flat(close_by.union(stars))), text=text, shingle=shingle, similarity=similarity, own=own)
        if many.isEmpty():
            return cut(links.select("u", "v").distinct())

        apart = F.bit_count(F.col("print").bitwiseXOR(F.col("head.print"))) > MAX_BITS
        left = many.filter((F.col("version") != F.col("head.version")) & apart)
        known = links.select(F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q"))
        left = own.cut(left.join(known, (F.least("version", "head.version") == F.col("p")) & (F.greatest("version", "head.version") == F.col("q")), "left_anti").select("key", "version", "print"))
        probes = left.select(F.col("key").alias("k"), one.alias("x"))
        met = probes.join(many.select("key", one.alias("y")), F.col("k") == F.col("key")).filter("x.version <> y.version").select("x", "y")
        more = _similar(docs, own.cut(_flat(met)), text=text, shingle=shingle, similarity=similarity, own=own)
        return cut(links.union(more).select("u", "v").distinct())


def _flips(mask: int) -> Column:
    """The print itself and the print with each bit outside the mask flipped."""
    return F.array(F.col("print"), *[F.col("print").bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64) if not mask >> k & 1])


def close_links(prints: DataFrame, own: Scratch) -> DataFrame:
    """Links (u, v) whose components are those of all pairs within two bits; ``prints`` has distinct prints."""
    keys = F.array(*[F.struct(F.lit(k).alias("key"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("part")) for k, m in enumerate(MASKS)])
    rows = prints.select("print", F.inline(keys))
    shared = own.cut(rows.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("key").alias("k"), F.col("part").alias("p")))
    meet = rows.join(shared, (F.col("key") == F.col("k")) & (F.col("part") == F.col("p")), "left_semi")
    values = F.when(F.col("key") == 0, _flips(MASKS[0]))
    for k, mask in enumerate(MASKS[1:], 1):
        values = values.when(F.col("key") == k, _flips(mask))
    listed = meet.select("print", "key", F.explode(values).alias("value"))
    # a value has at most free bits + 1 prints within one bit, so the list is bounded
    groups = listed.groupBy("key", "value").agg(F.collect_list("print").alias("members")).filter(F.size("members") > 1)
    stars = groups.select(F.explode("members").alias("u"), F.array_min("members").alias("v")).filter("u != v")
    return stars.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS).distinct()


def _labelled(prints: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """The rows of ``prints`` (id, print and what else they have), with root, the component's print, and component_id; ``more`` are links besides the close ones."""
    with Scratch(prints.sparkSession) as own:
        nodes = own.cut(prints.groupBy("print").agg(F.min("id").alias("least")))
        links = close_links(nodes.select("print"), own)
        roots = components(links if more is None else links.select("u", "v").union(more), own)
        named = own.cut(nodes.join(roots, F.col("print") == F.col("node")).select("print", "least", "root"))
        whole = own.cut(named.groupBy(F.col("root").alias("top")).agg(F.min("least").alias("whole")))
        joined = own.cut(named.join(whole, F.col("root") == F.col("top")).select(F.col("print").alias("p"), "whole", "top"))
        labels = cut(nodes.join(joined, F.col("print") == F.col("p"), "left").select(F.col("print").alias("fp"), F.coalesce("top", "print").alias("root"), F.coalesce("whole", "least").alias("component_id")))
    return prints.join(labels, F.col("print") == F.col("fp")).drop("fp")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """Per document: id, print and component_id, the smallest id that links lead to."""
    found = _labelled(cut(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle)))
    return found.select(F.col("id").alias(doc_id), "print", "component_id")


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents, all columns as they are, with one of each component of close prints and similar texts: the one with the smallest id, null last, then the least text hash.

    Where rows repeat that id and text, one of them stays.
    """
    prints = cut(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle, version=True))
    found = _labelled(prints, similar_links(docs, prints, text=text, shingle=shingle, similarity=similarity))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "version")).alias("first")
    stays, version, row = (fresh(x, docs) for x in ("stays", "version", "row"))
    stay = cut(found.groupBy("root").agg(first).select(F.col("first.id").alias(stays), F.col("first.version").alias(version)))
    kept = docs.join(stay, docs[doc_id].eqNullSafe(stay[stays]) & (F.xxhash64(docs[text].cast("string")) == stay[version]), "left_semi")
    once = W.partitionBy(F.col(doc_id), F.xxhash64(F.col(text).cast("string"))).orderBy(doc_id)
    return kept.withColumn(row, F.row_number().over(once)).filter(F.col(row) == 1).drop(row).select(*docs.columns)
