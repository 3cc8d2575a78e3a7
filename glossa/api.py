"""The library's two commands: search for a keyword, and extract text from a corpus."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions import text
from glossa.operators import filters
from glossa.sources import readers, writers


def search(docs: DataFrame, keyword: str) -> DataFrame:
    """Documents that have a keyword, exactly as written."""
    return filters.with_keyword(docs, keyword)


def extract(docs: DataFrame, units: str, *, types: str | None = None, max_files: int = 0, max_per_file: int = 0, include_title: bool = False, include_authors: bool = False, order: str = "path") -> DataFrame:
    """(filename, content_type, text) of each document, at most ``max_files`` of them in order."""
    found = filters.of_types(docs, types)
    if max_files:
        found = found.orderBy(order).limit(max_files)
    missing = F.raise_error(F.concat(F.lit("no tokens in "), F.coalesce("filename", F.lit("a document"))))
    content = F.when(F.col(units).isNull(), missing.cast(found.schema[units].dataType)).otherwise(F.col(units)) if units == "tokens" else F.col(units)
    body = text.rendered(units, content, title=F.col("title") if include_title else None, authors=F.col("authors") if include_authors else None, limit=max_per_file)
    return found.select(text.with_suffix(F.col("filename"), ".txt").alias("filename"), "content_type", body.alias("text"))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="glossa")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("search", "extract"):
        one = commands.add_parser(name)
        one.add_argument("what", help="a keyword, or paragraphs, sentences or tokens")
        one.add_argument("source")
        one.add_argument("target")
        one.add_argument("--types")
        if name == "extract":
            one.add_argument("--max-files", type=int, default=0)
            one.add_argument("--max-per-file", type=int, default=0)
            one.add_argument("--include-title", action="store_true")
            one.add_argument("--include-authors", action="store_true")
            one.add_argument("--lines", action="store_true", help="names and texts as JSON lines instead of a file for each document")
    given = parser.parse_args(arguments)
    docs = readers.documents(SparkSession.builder.getOrCreate(), given.source)
    if given.command == "search":
        writers.paths(search(filters.of_types(docs, given.types), given.what), given.target)
    else:
        out = extract(docs, given.what, types=given.types, max_files=given.max_files, max_per_file=given.max_per_file, include_title=given.include_title, include_authors=given.include_authors)
        if given.lines:
            out.write.partitionBy("content_type").json(given.target)
        else:
            writers.per_document(out, given.target, folders=("content_type",))


if __name__ == "__main__":
    main()
