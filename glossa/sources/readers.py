"""Readers: corpora of JSON documents, inventories, sitemaps, archives' listings and annotated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossa.functions import dates, text
from glossa.sources.schemas import DOCUMENT, DOMAIN, FILEMAP, PAGE


def documents(spark: SparkSession, path: str | list[str], *, articles_only: bool = False) -> DataFrame:
    """All ``*.json`` below a folder, one document each, with ``path`` (and ``_corrupt_record`` for unreadable ones).

    ``articles_only`` goes by the folder's name, not by the document's content type.
    """
    found = spark.read.schema(f"{DOCUMENT}, _corrupt_record STRING").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    found = found.withColumn("path", F.col("_metadata.file_path"))
    return found.filter(text.path_part(F.col("path"), 2) == "article") if articles_only else found


#: Paths of a list that are read one by one; a longer list is held against a whole folder.
LISTED = 10_000


def listed_documents(spark: SparkSession, listing: str, root: str | None = None, *, most: int = LISTED) -> DataFrame:
    """Documents whose paths a text file lists, one a line, wherever they are; of a list longer than ``most`` those below ``root``."""
    wanted = spark.read.text(listing).select(F.trim("value").alias("wanted")).filter("wanted != ''").distinct()
    names = [r.wanted for r in wanted.limit(most + 1).collect()]
    if len(names) <= most:
        return documents(spark, names) if names else documents(spark, listing).limit(0)
    if root is None:
        raise ValueError("a list this long needs a root folder")
    found = documents(spark, root).withColumn("_name", F.regexp_replace("path", "^file:/+", "/"))
    return found.join(wanted, F.col("_name") == F.col("wanted"), "left_semi").drop("_name")


def filemap(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILEMAP).option("sep", "\t").option("header", True).csv(path)


def domains(spark: SparkSession, path: str) -> DataFrame:
    """Sites by region; blank regions take the last one above, rows without a language are left out.

    The file is a hand-written list of some tens of rows, so its order is kept in one task.
    """
    from glossa.operators.ordered import filled_down

    rows = spark.read.schema(DOMAIN).option("sep", "\t").option("header", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    numbered = rows.withColumn("_line", F.monotonically_increasing_id())
    return filled_down(numbered, "region", "_line").filter(F.coalesce(F.trim("iso"), F.lit("")) != "").drop("_line")


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """Entries of sitemap files: URL, modification time, frequency, priority; entries without a URL are left out."""
    schema = "loc STRING, lastmod STRING, changefreq STRING, priority STRING"
    rows = spark.read.format("xml").schema(schema).option("rowTag", "url").option("ignoreNamespace", True).option("mode", "DROPMALFORMED").load(path)
    return rows.filter("loc IS NOT NULL").select(F.trim("loc").alias("url"), F.col("lastmod").alias("sitemap_last_modified"), "changefreq", "priority", F.col("_metadata.file_path").alias("path"))


def sitemap_index(spark: SparkSession, path: str) -> DataFrame:
    """Sitemaps that a fetched index names, without those of alternate languages."""
    rows = spark.read.format("xml").schema("loc STRING").option("rowTag", "sitemap").option("ignoreNamespace", True).load(path)
    return rows.select(F.trim("loc").alias("url")).filter("url IS NOT NULL AND NOT url LIKE '%Hreflang'")


def inventory_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page entries as JSON lines; an older name of the modification time is read too."""
    rows = spark.read.schema(f"{PAGE}, timestamp STRING").json(path)
    return rows.withColumn("sitemap_last_modified", dates.sitemap_timestamp(F.coalesce("timestamp", "sitemap_last_modified"))).drop("timestamp")


def archive_listing(spark: SparkSession, path: str) -> DataFrame:
    """An archive's listing: key, snapshot and URL, separated by blanks."""
    part = F.split("value", " ")
    return spark.read.text(path).select(F.get(part, F.lit(0)).alias("url_key"), F.get(part, F.lit(1)).try_cast("bigint").alias("snapshot"), F.get(part, F.lit(2)).alias("original_url"))


def article_lines(spark: SparkSession, path: str) -> DataFrame:
    """One article a line; the language is the first three letters of the file's name, the length counts the line's end."""
    rows = spark.read.option("lineSep", "\n").text(path).withColumn("file_name", F.col("_metadata.file_name"))
    return rows.select("file_name", F.substring("file_name", 1, 3).alias("language"), F.col("value").alias("article"), (F.length("value") + 1).alias("n_chars"))


def numbered_lines(spark: SparkSession, path: str, *, parts: bool = False) -> DataFrame:
    """(file_name, line_no, value): the lines of each file, numbered from 0; with ``parts`` the files, by name, are one file's parts.

    A file is read in splits by as many tasks as it needs.  Within a split lines come in order, so a
    first scan counts the lines of each split, the counts before each split are summed (a row for
    each split, not for each line), and the second scan adds its own count; no line is moved.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    rows = lines.select(meta["file_path"].alias("file"), meta["file_name"].alias("file_name"), meta["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    splits = rows.groupBy("file", "start").agg(F.min("at").alias("least"), F.count(F.lit(1)).alias("n"))
    window = W.orderBy("file", "start") if parts else W.partitionBy("file").orderBy("start")
    earlier = window.rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select(F.col("file").alias("f"), F.col("start").alias("s"), "least", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = rows.join(splits, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")))
    return numbered.select("file_name", (F.col("at") - F.col("least") + F.col("before")).alias("line_no"), "value")


def dump_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a wiki dump: title and text."""
    rows = spark.read.format("xml").schema("title STRING, revision STRUCT<text: STRING>").option("rowTag", "page").option("ignoreNamespace", True).load(path)
    return rows.select("title", F.col("revision.text").alias("text"))


def word_sentences(spark: SparkSession, path: str) -> DataFrame:
    """Sentences of an XML corpus with words inside sentence elements (every sentence, the last included)."""
    from glossa.operators.ordered import joined_tokens

    rows = spark.read.format("xml").schema("w ARRAY<STRING>").option("rowTag", "s").option("ignoreNamespace", True).load(path)
    return rows.filter("w IS NOT NULL").select(joined_tokens(F.col("w")).alias("sentence"))


def counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def stored_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sitemap_pages(spark: SparkSession, path: str, sitemaps: DataFrame | None = None) -> DataFrame:
    """Entries of sitemap files with their news and video tags; of entries of one language that share a URL the first counts.

    ``sitemaps`` names the files in order, with their languages (Filename, ISO); without it all files are one language.
    """
    schema = "loc STRING, lastmod STRING, changefreq STRING, priority STRING, news MAP<STRING, STRING>, video MAP<STRING, STRING>"
    rows = spark.read.format("xml").schema(schema).option("rowTag", "url").option("ignoreNamespace", True).option("mode", "DROPMALFORMED").load(path)
    rows = rows.filter("trim(loc) <> ''").select("*", F.col("_metadata.file_name").alias("filename"), F.monotonically_increasing_id().alias("_at"))
    if sitemaps is None:
        rows = rows.withColumns({"iso": F.lit(None).cast("string"), "_file": F.col("filename")})
    else:
        order = sitemaps.select(F.col("Filename").alias("filename"), F.col("ISO").alias("iso"), F.monotonically_increasing_id().alias("_file"))
        rows = rows.join(order, "filename")
    first = rows.withColumn("_n", F.row_number().over(W.partitionBy("iso", F.trim("loc")).orderBy("_file", "_at"))).filter("_n = 1")
    return first.select("iso", F.trim("loc").alias("url"), dates.sitemap_timestamp(F.col("lastmod")).alias("sitemap_last_modified"), "changefreq", "priority", *[F.map_filter(c, lambda tag, _: ~tag.startswith("_")).alias(c) for c in ("news", "video")], "filename")


def language_reports(spark: SparkSession, path: str, section: str = "iso_domain") -> DataFrame:
    """The language rows of all sites as one table, with the site as ``domain``."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path).withColumnRenamed(section, "domain")


def reinserted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Dumped pages read in again, their publication dates as times; a missing or odd date is an error."""
    rows = spark.read.schema(schema).json(path)
    return rows.withColumn("date_published", dates.inserted(F.col("date_published")))


def segmentation_data(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Sentences to train or test a segmenter on: from token lines (``ner``), annotated treebanks (``ud``) or XML words (``xml``)."""
    from glossa.operators import ordered

    if kind == "xml":
        return word_sentences(spark, path)
    lines = numbered_lines(spark, path)
    if kind == "ud":
        return ordered.annotated_texts(lines)
    if kind == "ner":
        tokens = lines.withColumn("value", F.get(F.split(F.trim("value"), r"\s+"), F.lit(0)))
        return ordered.grouped_sentences(tokens).select("sentence")
    raise ValueError(f"unknown kind {kind}")
