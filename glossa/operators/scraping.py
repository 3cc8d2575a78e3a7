"""What is kept of a page when it is scraped, as one operator over raw pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions import dates, html, text


def page_metadata(pages: DataFrame, *, page: str = "html") -> DataFrame:
    """The pages with title, description, canonical_link, keywords, authors, has_ptags, utag_data, content_type, application_ld_json, date_published and date_modified.

    A page without content has nothing of these but empty lists; linked data gives the dates before
    the page's own metadata does.
    """
    found = html.with_metadata(pages, html=page)
    utag = text.utag_map(F.coalesce(F.col(page), F.lit("")))
    part = lambda name: F.coalesce(F.try_element_at(utag, F.lit(name)), F.lit(""))
    linked = text.ld_json(F.coalesce(F.col(page), F.lit("")))
    own = dates.utag_date(part("pub_year"), part("pub_month"), part("pub_day"), part("pub_hour"), part("pub_minute"))
    none = F.array().cast("array<string>")
    return found.select(
        *pages.columns,
        *[F.col(f"meta.{c}").alias(c) for c in ("title", "description", "canonical_link")],
        F.coalesce("meta.keywords", none).alias("keywords"),
        F.coalesce("meta.authors", none).alias("authors"),
        F.coalesce("meta.has_ptags", F.lit(False)).alias("has_ptags"),
        utag.alias("utag_data"),
        F.try_element_at(utag, F.lit("content_type")).alias("content_type"),
        linked.alias("application_ld_json"),
        dates.published(F.get_json_object(linked, "$.datePublished"), own).alias("date_published"),
        F.try_to_timestamp(F.get_json_object(linked, "$.dateModified"), F.lit("yyyy-MM-dd HH:mm:ss'Z'")).alias("date_modified"),
    )
