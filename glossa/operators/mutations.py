"""Maintenance of stored documents, each as a new DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions import text


def set_where(rows: DataFrame, condition: Column, **values: object) -> DataFrame:
    """Columns set on the rows that meet a condition."""
    for name, value in values.items():
        new = value if isinstance(value, Column) else F.lit(value)
        rows = rows.withColumn(name, F.when(condition, new).otherwise(F.col(name)))
    return rows


def set_nested(rows: DataFrame, condition: Column, column: str, path: str, value: object) -> DataFrame:
    """A field inside a struct set on the rows that meet a condition."""
    return rows.withColumn(column, F.when(condition, F.col(column).withField(path, F.lit(value))).otherwise(F.col(column)))


def renamed(rows: DataFrame, old: str, new: str) -> DataFrame:
    return rows.withColumnRenamed(old, new)


def removed(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.drop(*columns)


def flagged_latest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("latest", F.lit(True))


def reparsed_utag(rows: DataFrame, *, html: str = "original_html") -> DataFrame:
    """Page metadata read again for documents that have no content type."""
    found = text.utag_map(F.col(html))
    missing = F.col("content_type").isNull()
    again = F.when(missing, found).otherwise(F.col("utag_data"))
    return rows.withColumn("utag_data", again).withColumn("content_type", F.coalesce("content_type", F.try_element_at("utag_data", F.lit("content_type"))))


def without_languages(rows: DataFrame, codes: list[str], column: str = "iso") -> DataFrame:
    return rows.filter(~F.col(column).isin(codes))


def by_canonical(rows: DataFrame, link: str) -> DataFrame:
    return rows.filter(F.col("canonical_link") == link)


def by_canonicals(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of many links; ``links`` has them in ``canonical_link``."""
    return rows.join(links.select("canonical_link"), "canonical_link", "left_semi")


def rederived(rows: DataFrame, *, html: str = "original_html") -> DataFrame:
    """Authors, linked data and dates read again from the page; rows without a page stay as they are.

    A date of either kind that can't be read is null; one odd page doesn't end the job.
    """
    page = F.coalesce(F.col(html), F.lit(""))
    linked = text.ld_json(page)
    author = F.regexp_extract_all(page, F.lit(r'(?is)<meta\b(?=[^>]*\bname="Author")[^>]*\bcontent="([^"]*)"'), F.lit(1))
    published = F.try_to_timestamp(F.get_json_object(linked, "$.datePublished"))
    modified = F.try_to_timestamp(F.get_json_object(linked, "$.dateModified"), F.lit("yyyy-MM-dd HH:mm:ss'Z'"))
    return set_where(rows, page != "", date_published=published, date_modified=modified, authors=author, application_ld_json=linked)


def ids(rows: DataFrame, column: str = "_id") -> DataFrame:
    return rows.select(column)


def with_filename(rows: DataFrame, name: Column) -> DataFrame:
    """The documents under a new file name."""
    return rows.withColumn("filename", name)


def as_json(rows: DataFrame, name: str = "value") -> DataFrame:
    """Each row as a JSON object, times in ISO form, nulls written."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias(name))


def as_fields(rows: DataFrame, name: str = "value", sep: str = "\t") -> DataFrame:
    """Each row as one line of fields, nulls empty."""
    return rows.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]).alias(name))


def keys(rows: DataFrame) -> list[str]:
    return rows.columns
