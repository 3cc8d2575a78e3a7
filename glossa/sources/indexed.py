"""Stored tables that are looked up by key: bucketed and sorted by it, with Bloom filters on other columns.

Rows with one key are in one bucket, a file that is sorted by the key.  A lookup of many keys
(``found``) sends the keys to the buckets and reads the stored side where it lies, without moving
it; a lookup of one value (``rows_with``) reads one bucket if it is the key, and in any column only
those row groups whose statistics and Bloom filters allow it.  Files are written in row groups of
``ROW_GROUP`` bytes, which is what can be skipped.

A table is known by its folder: ``opened`` gives a session the table that another one wrote.

Defined cases: null keys are found by nothing; keys that occur more than once find their rows once;
an empty table is one without files and finds nothing; a key with very many rows makes its bucket as
large, which is read as a stream.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.operators.scans import fresh

ROW_GROUP = 8 << 20
BUCKETS = 64


@dataclass(frozen=True)
class Index:
    """A table's name in this session, its folder, key and number of buckets."""

    name: str
    path: str
    key: str
    buckets: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def written(rows: DataFrame, path: str, key: str, *, bloom: tuple[str, ...] = (), values: int = 1_000_000, buckets: int = BUCKETS, row_group: int = ROW_GROUP) -> Index:
    """The rows as an index below a new folder; ``values`` is how many different ones of a Bloom column a file may have."""
    name = f"glossa_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, key).write.format("parquet").option("path", path).option("parquet.block.size", row_group)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", values)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return Index(name, path, key, buckets)


def opened(spark: SparkSession, path: str, schema: str, key: str, buckets: int = BUCKETS) -> Index:
    """The index that lies in a folder."""
    name = f"glossa_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return Index(name, path, key, buckets)


def found(index: Index, keys: DataFrame, column: str, *, missing: bool = False) -> DataFrame:
    """The stored rows whose key is among ``keys`` (or is not); only the keys are moved."""
    stored = index.rows(keys.sparkSession)
    of = fresh("of", stored)
    wanted = keys.select(F.col(column).alias(of)).dropna().distinct()
    return stored.hint("merge").join(wanted, F.col(index.key) == F.col(of), "left_anti" if missing else "left_semi")


def rows_with(spark: SparkSession, index: Index, column: str, value: object) -> DataFrame:
    """The stored rows with one value in a column."""
    return index.rows(spark).filter(F.col(column) == F.lit(value))


def dropped(spark: SparkSession, index: Index) -> None:
    """The session forgets the table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {index.name}")
