"""Date and time functions as Column expressions; unreadable values are null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCHIVE = "yyyyMMddHHmm"


def sitemap_timestamp(x: Column) -> Column:
    """ISO timestamps of sitemaps: over-long fractions are cut, ``None`` is null."""
    cut = F.when(F.length(x) >= 27, F.concat(F.substring(x, 1, 26), F.lit("Z"))).otherwise(x)
    return F.when(x.isNotNull() & (x != "None"), F.try_to_timestamp(cut))


def utag_date(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
    """The publication date of page metadata as ISO text; an impossible day becomes the month's first.

    Parts must be padded as in ISO dates, as they are where the metadata is well formed.
    """
    full = F.coalesce(F.length(year) > 0, F.lit(False)) & (F.length(month) > 0) & (F.length(day) > 0)
    timed = F.coalesce((F.length(hour) > 0) & (F.length(minute) > 0), F.lit(False))
    date = F.concat_ws("-", year, month, day)
    read = F.when(timed, F.try_to_timestamp(F.concat(date, F.lit(" "), hour, F.lit(":"), minute), F.lit("yyyy-MM-dd HH:mm"))).otherwise(F.try_to_timestamp(date, F.lit("yyyy-MM-dd")))
    first = F.try_to_timestamp(F.concat_ws("-", year, month, F.lit("01")), F.lit("yyyy-MM-dd"))
    return F.when(full, iso_text(F.coalesce(read, first)))


def iso_text(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss")


def published(ld_date: Column, utag: Column) -> Column:
    """The linked data's date in either of its two spellings, or else the page metadata's."""
    return F.coalesce(F.try_to_timestamp(ld_date), F.try_to_timestamp(ld_date, F.lit("yyyy-MM-dd HH:mm:ss'Z'")), F.try_to_timestamp(utag))


def retrieved(x: Column) -> Column:
    """``05-Mar-2021 (10:20:30.123456)``."""
    return F.try_to_timestamp(x, F.lit("dd-MMM-yyyy '('HH:mm:ss.SSSSSS')'"))


def archive_time(x: Column) -> Column:
    """An archive's snapshot number; its seconds are dropped."""
    return F.try_to_timestamp(F.substring(x.cast("string"), 1, 12), F.lit(ARCHIVE))


def year_of(x: Column) -> Column:
    """The first four characters as a number."""
    return F.substring(x.cast("string"), 1, 4).try_cast("int")


def in_range_or_null(x: Column, start: str | None = None, end: str | None = None) -> Column:
    """Between two days at midnight, both included, or null; without bounds everything passes."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (x >= F.to_timestamp(F.lit(start)).cast("timestamp_ntz"))
    if end is not None:
        inside = inside & (x <= F.to_timestamp(F.lit(end)).cast("timestamp_ntz"))
    return (x.isNull() | inside) if start is not None or end is not None else F.lit(True)


def repaired(stamp: Column, text: Column) -> Column:
    """The timestamp, or the text read as one where there is none."""
    return F.coalesce(stamp, sitemap_timestamp(text))


def inserted(x: Column) -> Column:
    """A dump's publication date; null or any other spelling is an error, as it is when a dump is read in again."""
    good = x.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$")
    bad = F.raise_error(F.concat(F.lit("no publication date: "), F.coalesce(x, F.lit("null")))).cast("timestamp")
    return F.when(F.coalesce(good, F.lit(False)), F.to_timestamp(x, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(bad)
