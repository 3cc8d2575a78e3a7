"""Which documents and paragraphs pass, and where they go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions import dates, lid, text

CONTENT_TYPES = ("article", "audio", "photo", "video")
# Routes and names that no release has.
UNRELEASED = ("404 error", "eng-filtered-paragraphs", "lang_id_filtered", "poll", "index", "quiz", "other", "publication_date_too_early", "empty_output")
REQUIRED = ("url", "iso", "language", "success", "latest", "has_ptags", "time_retrieved", "original_html")


def ready(pages: DataFrame, iso: str, *, content_type: str | None = None, start: str | None = None, end: str | None = None, limit: int = 0) -> DataFrame:
    """What a release is made from: successful latest pages with paragraphs.

    The limit applies before agencies are filtered out, so fewer rows may come out.
    """
    found = pages.filter((F.col("iso") == iso) & F.col("success") & F.col("has_ptags") & F.col("latest"))
    if content_type is not None:
        found = found.filter(F.col("content_type") == content_type)
    if start or end:
        found = found.filter(dates.in_range_or_null(F.col("date_published").cast("timestamp_ntz"), start, end))
    found = found.limit(limit) if limit else found
    byline = F.try_element_at("utag_data", F.lit("byline"))
    title = F.try_element_at("utag_data", F.lit("page_title"))
    return found.filter(text.author_allowed(byline, F.col("authors"), F.size("utag_data")) & text.title_allowed(title))


def without_english(docs: DataFrame, *, paragraphs: str = "paragraphs", iso: str = "site_language", detect=lid.detect) -> DataFrame:
    """The documents with English paragraphs of other-language sites moved to ``removed`` (number, probability, proportion, paragraph)."""
    judged = F.transform(paragraphs, lambda p, k: F.struct(k.alias("par_num"), p.alias("paragraph"), detect(p).alias("predictions")))

    def english(x: Column) -> Column:
        return F.coalesce(lid.english_paragraph(F.col(iso), x["predictions"]), F.lit(False))

    def row(x: Column) -> Column:
        eng = F.try_element_at(x["predictions"], F.lit("eng"))
        return F.struct(x["par_num"].alias("par_num"), eng["probability"].alias("probability"), eng["proportion"].alias("proportion"), x["paragraph"].alias("paragraph"))

    def parted(found: Column) -> Column:
        kept = F.transform(F.filter(found, lambda x: ~english(x)), lambda x: x["paragraph"])
        return F.struct(kept.alias("kept"), F.transform(F.filter(found, english), row).alias("removed"))

    # a generator of one row: the parts below are taken from it, not computed again
    both = docs.select("*", F.explode_outer(F.array(text.let(judged, parted))).alias("_parted"))
    return both.withColumn("removed", F.col("_parted.removed")).withColumn(paragraphs, F.col("_parted.kept")).drop("_parted")


def long_enough(tokens: Column | None, n_chars: Column, *, least_tokens: int = 10, least_chars: int = 20) -> Column:
    """Long enough to keep: by tokens where there are any, by characters where not."""
    by_chars = n_chars > least_chars
    if tokens is None:
        return by_chars
    first = F.get(tokens, F.lit(0))
    one = F.size(tokens) == 1
    short = one & ((F.size(first) == 0) | ((F.size(first) == 1) & (F.size(F.get(first, F.lit(0))) < least_tokens)))
    return F.when(F.coalesce(F.size(tokens), F.lit(0)) > 0, ~short).otherwise(by_chars)


def route(published: Column, predicted: Column, iso: Column, single: Column, keep: Column, content_type: Column) -> Column:
    """Where a document goes; the first rule that holds counts."""
    foreign = text.let(predicted, lambda p: ((p == "eng") & (iso != "eng")) | (p == "mul"))
    doubtful = foreign | ((iso == "eng") & ~single.eqNullSafe(F.lit("eng")))
    return F.when(dates.year_of(published) < 2000, "publication_date_too_early").when(doubtful, "lang_id_filtered").when(keep, F.coalesce(content_type, F.lit("other"))).otherwise("empty_output")


def of_types(docs: DataFrame, types: str | None, column: str = "content_type") -> DataFrame:
    """Documents of the named types; unknown names are errors; no names mean all."""
    if not types:
        return docs
    names = types.split(",")
    if unknown := [n for n in names if n not in CONTENT_TYPES]:
        raise ValueError(f"unknown content types {unknown}, known are {list(CONTENT_TYPES)}")
    return docs.filter(F.col(column).isin(names))


def with_keyword(docs: DataFrame, keyword: str, column: str = "keywords") -> DataFrame:
    return docs.filter(F.array_contains(column, keyword))


def released(docs: DataFrame, *, column: str = "route", names: DataFrame | None = None, filename: str = "filename") -> DataFrame:
    """What a release has: no filtered routes, no files that are left out by name."""
    found = docs.filter(~F.col(column).isin(*UNRELEASED))
    return found.join(names, filename, "left_anti") if names is not None else found


def of_languages(rows: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, column: str = "iso") -> DataFrame:
    if include:
        rows = rows.filter(F.col(column).isin(include))
    return rows.filter(~F.col(column).isin(exclude)) if exclude else rows


def useful_urls(listing: DataFrame, column: str = "url_key") -> tuple[DataFrame, DataFrame]:
    """Pages, and everything else."""
    page = F.coalesce(F.col(column).endswith(".html"), F.lit(False))
    return listing.filter(page), listing.filter(~page)


def corpus_files(files: DataFrame, name: str = "name", section: str = "section") -> DataFrame:
    """Without archives, lists of empty documents, and sections that sum up others."""
    return files.filter(~F.col(name).endswith(".tgz") & ~F.col(name).startswith("empty_output") & ~F.col(section).startswith("all"))


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """For each rule the number of rows that break it (a null verdict breaks it)."""
    counts = rows.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n_broken")


def required_rules(columns: tuple[str, ...] = REQUIRED) -> dict[str, Column]:
    return {f"{c}_present": F.col(c).isNotNull() for c in columns}


def categories(*columns: str) -> Column:
    """The pages of a site that there are."""
    return F.array_compact(F.array(*columns))


def of_section(docs: DataFrame, section: str | None = None, keyword: str | None = None, *, column: str = "section", keywords: str = "keywords", route: str | None = None) -> DataFrame:
    """Documents of a section or with a keyword, without those that language identification took out."""
    if section is not None:
        docs = docs.filter(F.col(column) == section)
    if keyword is not None:
        docs = with_keyword(docs, keyword, keywords)
    return docs.filter(F.col(route) != "lang_id_filtered") if route else docs


def type_rules(**types: str) -> dict[str, Column]:
    """Rules that fields, read as text, have the types that are asked for; a missing value breaks none."""
    return {f"{name}_{kind}": F.col(name).isNull() | F.col(name).cast("string").try_cast(kind).isNotNull() for name, kind in types.items()}
