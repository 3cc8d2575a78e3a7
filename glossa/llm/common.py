"""What the operators of this subpackage share: word splitting, Arrow row helpers, shared tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from glossa.sources.shared import shared_dir

#: Bytes of a letter-and-digit word: digits, letters and everything beyond ASCII; A-Z become a-z, the rest blanks.
_ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Rows of an Arrow batch that are held as Python objects at a time.
SLICE = 512
#: Spark's setting by which the shuffle files of a query are removed when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case, as UTF-8; null has none."""
    return text.encode().translate(_ALNUM).split() if text else []


def blank_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (``bytes.split`` cuts at exactly these); null has none."""
    if not text:
        return []
    raw = text.encode()
    return (raw.translate(_LOWER) if lower else raw).split()


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that only few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows written to the path and read again.  The write's own shuffle files go when it ends."""
    spark = df.sparkSession
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends there, and lost executors cost nothing."""
    return written(df, shared_dir(df.sparkSession))


class Scratch:
    """Intermediate tables in the shared folder, deleted together when the block ends.

    What a result still reads has to be written with ``cut`` instead.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def cut(self, df: DataFrame) -> DataFrame:
        self.paths.append(shared_dir(self.spark))
        return written(df, self.paths[-1])

    def clear(self, keep: int = 0) -> None:
        """Deletes all tables but the last ``keep``."""
        conf = self.spark._jsc.hadoopConfiguration()
        gone, self.paths = self.paths[: len(self.paths) - keep], self.paths[len(self.paths) - keep :]
        for path in gone:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)

    def __exit__(self, *_: object) -> None:
        self.clear()


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
