"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

1. A narrow table has each document's source, size (words) and key: 60 bits of a digest of its id and
   text.  Sources take weights in turn, in the order of their names, and share ``share`` times the
   size of all documents by weight.  No target is above ``cap`` times its source's size: what is
   above is shared again by weight.  With sources in the order of cap to weight the capped ones come
   first, so running sums over that order give the level at which the rest share.
2. A source's target takes its documents whole times each, and a rest that is less than its size.
   The rest goes to the documents with the smallest keys: sizes are summed by source and bucket (the
   key's next 12 bits), and the running sum over at most 4,096 buckets of a source finds the one in
   which its budget ends.  Only documents in that bucket are looked at again, by the next 12 bits,
   until it holds one key; at most five times.  Several shares are found in the same passes, and
   as keys stay, a smaller share's mix lies within a larger one's.
3. Documents are filtered by their source's key limit where they are read; none is sorted or moved.

The rows of the boundary's key are taken if that brings the source nearer to its target (a tie
takes them), so a source misses it by half of that document at most.

Defined cases: a null text has size 0; a null source is a source of its own, last in the order; a
null id's key comes from the text alone; rows equal in id and text have one key and are taken
together; sources without words have target 0; of an empty table nothing is taken; a column named
like the result (``mix``) gives way to it, and all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossa.llm.common import Scratch, cut
from glossa.operators.scans import fresh, ranked, running

#: Sources take these in turn.
WEIGHTS = (5, 2, 1)
SHARES = (1.5,)
CAP = 2.0
SEED = "mix"
KEY_BITS, LEVEL_BITS = 60, 12
#: A table with a row for each source is broadcast up to so many; a longer one is shuffled, with its documents salted.
BROADCAST_ROWS, SALTS = 200_000, 16
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def key_of(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """60 bits, the same for the same id and text in every run."""
    whole = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def levels(sources: DataFrame, shares: tuple[float, ...], cap: float) -> list[tuple[float, float]]:
    """For each share what the sources below the cap get in all, and their weights, as numbers to divide.

    ``sources``: source, size, weight, no (a number of its own).
    """
    ratio = F.col("size") * F.lit(cap) / F.col("weight")
    sums = running(sources.withColumn("ratio", ratio), [F.col("ratio"), F.col("no")], {"sizes": F.col("size"), "weights": F.col("weight")})
    all_of = sources.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    if all_of.size is None:
        return [(0.0, 1.0) for _ in shares]
    left = [F.lit(share * all_of.size) - F.lit(cap) * (F.col("sizes") - F.col("size")) for share in shares]
    over = F.lit(float(all_of.weight)) - (F.col("weights") - F.col("weight"))
    # the first source that its part of what is left doesn't fill
    first = [F.min(F.when(F.col("ratio") >= x / over, F.struct("ratio", "no", x.alias("left"), over.alias("over")))) for x in left]
    found = sums.agg(*[f.alias(f"s{k}") for k, f in enumerate(first)]).first()
    if any(f is None for f in found):
        raise ValueError("a share has to be below the cap")
    return [(f["left"], f["over"]) for f in found]


def _few(rows: DataFrame, limit: int) -> bool:
    return rows.limit(limit + 1).count() <= limit


def _by_source(docs: DataFrame, source: str, key: str, table: DataFrame, of: str, broadcast_rows: int) -> DataFrame:
    """Each document with the row of the table that has its source in ``of``."""
    if _few(table, broadcast_rows):
        return docs.join(F.broadcast(table), F.col(source).eqNullSafe(F.col(of)))
    salt = fresh("salt", docs, table)
    spread = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return docs.join(spread, F.col(source).eqNullSafe(F.col(of)) & (F.pmod(F.col(key), F.lit(SALTS)) == F.col(salt)))


def limits(narrow: DataFrame, budgets: DataFrame, own: Scratch, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(source, part, key): the largest key to which each budget reaches, -1 if to none.

    ``narrow``: source, key, size; ``budgets``: source, part, budget.
    """
    shift = KEY_BITS - LEVEL_BITS
    seen = narrow.select("source", F.lit(0).cast("bigint").alias("prefix"), "key", "size")
    open_ = budgets.select("source", "part", "budget", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("before"))
    done = None
    while True:
        sums = seen.groupBy("source", "prefix", F.shiftright("key", shift).alias("bucket")).agg(F.sum("size").alias("n"), F.min("key").alias("least"), F.max("key").alias("most"))
        up_to = W.partitionBy("source", "prefix").orderBy("bucket")
        sums = sums.withColumn("sum", F.sum("n").over(up_to)).select(F.col("source").alias("s"), F.col("prefix").alias("p"), "bucket", "n", "sum", "least", "most")
        sums = own.cut(sums)
        ends = open_.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("prefix") == F.col("p")), "left")
        # the first bucket that the budget doesn't fill; where there is none, all is taken
        beyond = F.min(F.when(F.col("before") + F.col("sum") > F.col("budget"), F.struct("bucket", "n", "sum", "least", "most")))
        ends = own.cut(ends.groupBy("source", "part", "budget", "prefix", "before").agg(beyond.alias("end")))
        one = F.col("end").isNull() | (F.col("end.least") == F.col("end.most"))
        so_far = F.col("before") + F.col("end.sum") - F.col("end.n")
        takes = 2 * so_far + F.col("end.n") <= 2 * F.col("budget")
        key = F.when(F.col("end").isNull(), F.lit((1 << KEY_BITS) - 1)).when(takes, F.col("end.least")).otherwise(F.col("end.least") - 1)
        closed = ends.filter(one).select("source", "part", key.alias("key"))
        done = closed if done is None else done.union(closed)
        open_ = ends.filter(~one).select("source", "part", "budget", F.col("end.bucket").alias("prefix"), so_far.alias("before"))
        if open_.isEmpty():
            return cut(done)
        # a bucket has some 4,096th of a source's keys, so no bucket is hot
        bounds = own.cut(open_.select(F.col("source").alias("s"), F.col("prefix").alias("p")).distinct())
        bounds = F.broadcast(bounds) if _few(bounds, broadcast_rows) else bounds
        at = F.shiftright("key", shift)
        inside = narrow.join(bounds, F.col("source").eqNullSafe(F.col("s")) & (at == F.col("p")))
        seen = inside.select("source", F.col("p").alias("prefix"), "key", "size")
        shift -= LEVEL_BITS


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    shares: tuple[float, ...] = SHARES,
    cap: float = CAP,
    seed: str = SEED,
    out: str = "mix",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The documents with a struct ``out``: size, source_size, and for each share (share, target of the source, copies, taken)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == out.lower()])
    body = docs[text].cast("string")
    with Scratch(docs.sparkSession) as own:
        narrow = own.cut(docs.select(docs[source].alias("source"), key_of(docs[doc_id], body, seed).alias("key"), size_of(body).alias("size")))
        sources = own.cut(narrow.groupBy("source").agg(F.sum("size").alias("size")))
        sources = ranked(sources, [F.col("source").asc_nulls_last()], "no")
        weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int"))
        sources = own.cut(sources.withColumn("weight", weight))

        parts = []
        for share, (left, over) in zip(shares, levels(sources, shares, cap), strict=True):
            target = F.least(F.col("size") * F.lit(cap), F.col("weight") * F.lit(left) / F.lit(over))
            parts.append(F.struct(F.lit(share).alias("share"), target.alias("target")))
        targets = sources.select("source", "size", F.posexplode(F.array(*parts)).alias("part", "of")).select("source", "size", "part", "of.share", "of.target")
        whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0)).cast("int")
        targets = targets.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("size"))
        targets = own.cut(targets)
        ends = limits(narrow, targets.select("source", "part", "budget"), own, broadcast_rows)
        ends = ends.select(F.col("source").alias("s"), F.col("part").alias("p"), "key")
        targets = targets.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
        table = targets.groupBy("source", "size").agg(F.array_sort(F.collect_list(F.struct("part", "share", "target", "whole", "key"))).alias("parts"))
        table = cut(table.select(F.col("source").alias("of"), F.col("size").alias("source_size"), "parts"))

    names = {c: fresh(c, docs) for c in ("of", "source_size", "parts", "key", "size")}
    at = docs.withColumns({names["key"]: key_of(docs[doc_id], body, seed), names["size"]: size_of(body)})
    size, key = F.col(names["size"]), F.col(names["key"])
    joined = _by_source(at, source, names["key"], table.toDF(*[names[c] for c in table.columns]), names["of"], broadcast_rows)

    def taken(p: Column) -> Column:
        copies = p["whole"] + (key <= p["key"]).cast("int")
        return F.struct(p["share"].alias("share"), p["target"].alias("target"), copies.alias("copies"), (copies * size).cast("bigint").alias("taken"))

    result = F.struct(size.alias("size"), F.col(names["source_size"]).alias("source_size"), F.transform(names["parts"], taken).alias("mixes"))
    return joined.select(*[F.col(c) for c in docs.columns], result.alias(out))


def copies(mixed: DataFrame, share: int = 0, out: str = "mix") -> DataFrame:
    """The rows of a mix: each document as often as the mix takes it, with the documents' own columns."""
    n = F.get(F.col(out)["mixes"], F.lit(share))["copies"]
    again = fresh("again", mixed)
    rows = mixed.withColumn(again, F.explode(F.array_repeat(F.lit(True), n)))
    return rows.drop(again, out)
