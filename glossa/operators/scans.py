"""Scans over a total order, in any number of tasks.

A window without keys puts all rows into one task.  Here the rows are cut into ranges of the order,
each sorted by itself and written with its number and its rows' places in it; what a range needs
from those before it (how many rows they have, their sums, the last value that was not null) is one
row a range, so it is combined on its own and joined back.  A range is a task's share of the rows,
whatever the keys; rows that are equal in all of ``by`` stay in one range, so ``by`` should tell
rows apart.  No row crosses the network after the ranges are cut but within its own range.

Defined cases: an empty table stays empty; nulls stand where ``by`` puts them; null values count as
zero in sums and are passed over by ``filled``; other columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossa.sources.shared import stored

#: monotonically_increasing_id has the row's place in its partition in these low bits.
PLACE_BITS = 33


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_ranges(rows: DataFrame, by: list[Column], ranges: int | None = None) -> tuple[DataFrame, str, str]:
    """The rows in sorted ranges, with the number of the range and the row's place in it (from 0), and these columns' names."""
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, place = fresh("range", rows), fresh("place", rows)
    low = F.lit((1 << PLACE_BITS) - 1)
    cut = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
    return stored(cut.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(low)})), part, place


def _before(summaries: DataFrame, part: str, sums: list[str]) -> DataFrame:
    """Sums over all earlier ranges; one row for each range, so one task holds as many rows as there are ranges."""
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    return summaries.select(part, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in sums])


def _joined(rows: DataFrame, part: str, carried: DataFrame) -> DataFrame:
    """One row a range is as small as the list of tasks, so it is broadcast."""
    key = fresh("of", rows, carried)
    return rows.join(F.broadcast(carried.withColumnRenamed(part, key)), F.col(part) == F.col(key), "left").drop(key)


def ranked(rows: DataFrame, by: list[Column], name: str = "rank", ranges: int | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """The rows with their place in the order, from 0.

    With ``within``, which has to lead ``by``, places start again where its columns change; a value
    may have any share of the rows, as it takes as many ranges as its rows fill.
    """
    found, part, place = in_ranges(rows, by, ranges)
    offset = fresh("offset", found)
    counts = found.groupBy(part).agg(F.count(F.lit(1)).alias(offset))
    out = _joined(found, part, _before(counts, part, [offset]))
    rank = F.col(offset) + F.col(place)
    if not within:
        return out.withColumn(name, rank).drop(*{part, place, offset} - {name})
    at, first = fresh("at", out), fresh("first", out)
    out = out.withColumn(at, rank)
    firsts = out.groupBy(*within).agg(F.min(at).alias(first))
    keys = [fresh(f"key{k}", out, firsts) for k in range(len(within))]
    firsts = firsts.toDF(*keys, first)
    same = None
    for k, c in zip(keys, within, strict=True):
        one = F.col(c).eqNullSafe(F.col(k))
        same = one if same is None else same & one
    return out.join(firsts, same).withColumn(name, F.col(at) - F.col(first)).drop(*({part, place, offset, at, first, *keys} - {name}))


def running(rows: DataFrame, by: list[Column], sums: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """The rows with running sums over all rows up to and with each, by name."""
    found, part, place = in_ranges(rows.withColumns(sums), by, ranges)
    totals = {c: fresh(f"{c}_before", found) for c in sums}
    summaries = found.groupBy(part).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(t) for c, t in totals.items()])
    so_far = W.partitionBy(part).orderBy(place).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = _joined(found, part, _before(summaries, part, list(totals.values())))
    return out.withColumns({c: F.col(t) + F.coalesce(F.sum(c).over(so_far), F.lit(0)) for c, t in totals.items()}).drop(part, place, *totals.values())


def filled(rows: DataFrame, by: list[Column], values: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """The rows with, by name, each value's last one that is not null up to and with the row."""
    found, part, place = in_ranges(rows.withColumns(values), by, ranges)
    so_far = W.partitionBy(part).orderBy(place).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    lasts = {c: fresh(f"{c}_before", found) for c in values}
    summaries = found.groupBy(part).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(place))).alias(t) for c, t in lasts.items()])
    carried = summaries.select(part, *[F.last(t, ignorenulls=True).over(earlier).alias(t) for t in lasts.values()])
    out = _joined(found, part, carried)
    return out.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(t)) for c, t in lasts.items()}).drop(part, place, *lasts.values())
