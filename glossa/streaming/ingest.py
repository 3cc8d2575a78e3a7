"""Incremental ingestion with Structured Streaming: new page files update the latest versions.

Each micro-batch is appended to the version table; the latest flags follow from sequence numbers,
so batches that arrive late or again give the same table as one batch read would.  Within a batch
rows are deduplicated by sequence number against the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glossa.operators.versions import with_superseded


def ingest(spark: SparkSession, source: str, schema: str, table: str, checkpoint: str, *, seq: str = "ingest_seq", files_per_batch: int = 100) -> StreamingQuery:
    """Appends new Parquet files below ``source`` to the Parquet table ``table``, each sequence number once."""

    def append(batch: DataFrame, number: int) -> None:
        rows = batch.dropDuplicates([seq]).withColumn("_batch", F.lit(number))
        # a batch that runs again after a failure replaces what it wrote before
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(table)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str, *, seq: str = "ingest_seq", **columns: str) -> DataFrame:
    """The version table with its latest flags, as a batch over the same rows would give them."""
    rows = spark.read.parquet(table).drop("_batch").dropDuplicates([seq])
    return with_superseded(rows, seq=seq, **columns)


def windowed_counts(events: DataFrame, *, time: str = "ts", key: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by key and window, on a stream or a table; state of windows older than the watermark is dropped."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
