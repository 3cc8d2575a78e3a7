"""The corpus pipeline: from raw documents to piece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the
shared folder and read again as the next stage's documents.  All stages but the last return the
columns of ``documents``; the last returns one row of ids for each document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm import decontaminate, linededup, pieces, quality, simhash
from glossa.llm.common import Scratch, cut, table

#: Units in an encoding worker's table: its executor's memory also holds what the earlier stages left of the JVM's heap.
UNITS = 50_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier one go; n_chars follows the text."""
    out = linededup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints over five-word shingles) the document with the smallest id stays."""
    return simhash.one_of_each(docs, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document that is left; the N best segmentations are searched, and all have to give the text back."""
    return pieces.encode(docs, pieces.Pieces.load(), remembered=UNITS).select("doc_id", "n_pieces", "n_unknown", "ids", "ids_sha256", "round_trip")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

#: SQL has neither the forest nor the piece search; tests/llm/test_pipeline.py holds every stage, and run(), against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between two stages is deleted when the later one is written."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark) as own:
        for _, stage in STAGES[:-1]:
            docs = own.cut(stage(spark, docs, sf_dir))
            own.clear(keep=1)
        return cut(STAGES[-1][1](spark, docs, sf_dir))
