"""Writers: routed releases, dumps, plaintext, lists and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions import text
from glossa.operators import filters, stats
from glossa.sources.named import write_named
from glossa.sources.schemas import DROPPED_IF_EMPTY


def document_json(docs: DataFrame) -> Column:
    """A document as JSON text: nulls are written, five fields vanish where they are empty."""
    fields = []
    for f in docs.schema.fields:
        value = F.to_json(F.struct(F.col(f.name)), {"ignoreNullFields": "false"})
        part = F.substr(value, F.lit(2), F.length(value) - 2)  # without the braces
        if f.name in DROPPED_IF_EMPTY:
            kind = f.dataType.typeName()
            empty = F.col(f.name).isNull() | ((F.size(f.name) == 0) if kind == "array" else (F.col(f.name) == 0) if kind in ("long", "integer") else (F.col(f.name) == ""))
            part = F.when(~empty, part)
        fields.append(part)
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def routed(docs: DataFrame, path: str, *, section: str = "iso_domain", route: str = "route") -> None:
    """Documents as JSON lines by section and route."""
    columns = [c for c in docs.columns if c not in (section, route)]
    body = document_json(docs.select(*columns))
    docs.select(section, route, body.alias("value")).write.partitionBy(section, route).text(path)


def empty_list(docs: DataFrame, path: str, *, url: str = "url", route: str = "route") -> None:
    """URLs of documents that had nothing to keep."""
    docs.filter(F.col(route) == "empty_output").select(F.col(url).alias("value")).write.mode("append").text(path)


def removed_paragraphs(docs: DataFrame, path: str, *, filename: str = "filename", removed: str = "removed") -> None:
    """What language filtering took out: number, probability, proportion, text on one line."""
    rows = docs.select(filename, F.inline(removed))
    flat = F.translate("paragraph", "\t\n", "  ")
    rows.select(filename, "par_num", "probability", "proportion", flat.alias("paragraph")).write.option("sep", "\t").csv(path)


def dump(pages: DataFrame, path: str, *, iso: str = "iso") -> None:
    """Raw pages as JSON by language."""
    pages.write.partitionBy(iso).option("ignoreNullFields", "false").json(path)


def plaintext(docs: DataFrame, path: str, units: str, *, title: bool = False, authors: bool = False, limit: int = 0) -> None:
    """Documents as text by content type."""
    body = text.rendered(units, F.col(units), title=F.col("title") if title else None, authors=F.col("authors") if authors else None, limit=limit)
    docs.select("content_type", body.alias("value")).write.partitionBy("content_type").text(path)


def plaintext_pair(docs: DataFrame, path: str, *, section: str | None = None, keyword: str | None = None) -> None:
    """Titles and paragraphs, and tokenised sentences one a line, in two folders; of a section or keyword if one is named."""
    docs = filters.of_section(docs, section, keyword)
    raw = F.array_join(F.concat(F.array("title"), "paragraphs"), "\n\n")
    sentences = F.array_join(F.transform("tokens", lambda p: F.array_join(F.transform(p, lambda s: F.array_join(s, " ")), "\n")), "\n\n")
    docs.select(raw.alias("value")).write.text(f"{path}/raw_paragraphs")
    docs.filter("tokens IS NOT NULL").select(sentences.alias("value")).write.text(f"{path}/tokenized_sentences")


def paths(docs: DataFrame, path: str, column: str = "path") -> None:
    docs.select(F.col(column).alias("value")).write.text(path)


def table(rows: DataFrame, path: str, sep: str = "\t") -> None:
    rows.write.option("sep", sep).option("header", True).csv(path)


def named_once(rows: DataFrame, column: str) -> DataFrame:
    """The rows; names that occur twice are an error when they are written."""
    doubled = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bad = doubled.limit(5).collect()
    if bad:
        raise ValueError(f"names that occur twice: {[r[0] for r in bad]}")
    return rows


def json_lines(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, times in ISO form."""
    rows.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)


def by_section(rows: DataFrame, path: str, section: str = "iso_domain") -> None:
    rows.write.mode("append").partitionBy(section).option("header", True).csv(path)


def vocabulary(tokens: DataFrame, path: str, column: str = "token") -> None:
    tokens.select(F.col(column).alias("value")).distinct().write.text(path)


def per_document(rows: DataFrame, path: str, *, name: str = "filename", body: str = "text", folders: tuple[str, ...] = ()) -> None:
    """Each text in a file of its own name, below folders by the other columns."""
    write_named(rows, path, F.concat_ws("/", *folders, name), F.col(body))


def named_release(docs: DataFrame, path: str, *, section: str = "iso_domain", route: str = "route", content_type: str = "content_type", filename: str = "filename", url: str = "url") -> None:
    """Each document as ``section/route/filename.json``; the URLs of those without content as lines of ``section/type/empty_output.txt``."""
    body = document_json(docs.drop(section, route))
    write_named(docs.filter(F.col(route) != "empty_output"), path, F.concat_ws("/", section, route, F.concat(filename, F.lit(".json"))), body)
    empty = docs.filter(F.col(route) == "empty_output")
    folder = F.concat_ws("/", section, F.coalesce(content_type, F.lit("other")), F.lit("empty_output.txt"))
    write_named(empty, path, folder, F.concat(url, F.lit("\n")), order=[F.col(url)])


def named_dump(pages: DataFrame, path: str, *, iso: str = "iso", key: str = "_id") -> None:
    """Each page's row as ``iso/key.json``, nulls written, the key last."""
    rest = [c for c in pages.columns if c != key]
    body = F.to_json(F.struct(*rest, F.col(key).cast("string").alias(key)), {"ignoreNullFields": "false"})
    write_named(pages, path, F.concat_ws("/", iso, F.concat(F.col(key).cast("string"), F.lit(".json"))), body)


def named_plaintext(docs: DataFrame, path: str, *, folder: str = "content_type", filename: str = "filename", section: str | None = None, keyword: str | None = None) -> None:
    """``raw_paragraphs`` and ``tokenized_sentences`` with a file for each document below its folder; each begins with the title, and filtered documents are left out."""
    docs = filters.of_section(docs.filter(F.col(folder) != "lang_id_filtered"), section, keyword)
    name = F.concat_ws("/", F.col(folder), text.html_to_txt(F.col(filename)))
    title = F.coalesce("title", F.lit(""))
    raw = F.array_join(F.concat(F.array(title), "paragraphs"), "\n\n")
    sentences = F.array_join(F.transform("tokens", lambda p: F.array_join(F.transform(p, lambda s: F.array_join(s, " ")), "\n")), "\n\n")
    write_named(docs, f"{path}/raw_paragraphs", name, F.coalesce(raw, title))
    write_named(docs, f"{path}/tokenized_sentences", name, F.concat(title, F.lit("\n\n"), F.coalesce(sentences, F.lit(""))))


def sentences(rows: DataFrame, path: str, *, sentences: str = "sentences", lines: bool = True) -> None:
    """Documents' sentences one a line, or each document on one line."""
    flat = F.flatten(F.col(sentences))
    out = rows.select(F.explode(flat).alias("value")) if lines else rows.select(F.array_join(flat, " ").alias("value"))
    out.write.text(path)


def html_report(rows: DataFrame, path: str, by: str) -> None:
    """A table in HTML for each value of a column, in a file of that name; rows stream to it in the order of their cells."""
    columns = [c for c in rows.columns if c != by]

    def escaped(c: str) -> Column:
        x = F.coalesce(F.col(c).cast("string"), F.lit(""))
        for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            x = F.replace(x, F.lit(old), F.lit(new))
        return F.concat(F.lit("<td>"), x, F.lit("</td>"))

    row = F.concat(F.lit("<tr>"), *map(escaped, columns), F.lit("</tr>"))
    head = "<table><tr>" + "".join(f"<th>{c}</th>" for c in columns) + "</tr>"
    ends = F.array(F.struct(F.lit(0).alias("at"), F.lit(head).alias("text")), F.struct(F.lit(2).alias("at"), F.lit("</table>").alias("text")))
    around = rows.select(F.col(by).alias("by")).distinct().select("by", F.inline(ends))
    parts = rows.select(F.col(by).alias("by"), F.lit(1).alias("at"), row.alias("text")).union(around)
    write_named(parts, path, F.concat(F.col("by").cast("string"), F.lit(".html")), F.col("text"), order=[F.col("at"), F.col("text")])


def archives(docs: DataFrame, path: str, section: str = "iso_domain") -> None:
    """A release by site, compressed."""
    docs.write.partitionBy(section).option("compression", "gzip").json(path)


def url_tables(urls: DataFrame, path: str, *, language: str = "iso", site: str = "host", url: str = "url") -> None:
    """The URLs, and their counts by language and by site."""
    table(urls.select(language, site, url), f"{path}/urls")
    table(stats.url_counts(urls, language, url), f"{path}/by_language")
    table(stats.url_counts(urls, site, url), f"{path}/by_site")


def release(docs: DataFrame, path: str, *, names: DataFrame | None = None, section: str = "iso_domain") -> None:
    """What a release has, by site and compressed."""
    archives(filters.released(docs, names=names), path, section)


def gunzipped(lines: DataFrame, path: str, name: Column, value: str = "value") -> None:
    """Lines of compressed files, as Spark reads them, in files without the extension; a name that does not end in .gz is an error.

    A compressed file is read by one task in order, so its lines follow each other.  Of a name all
    trailing letters and dots of the extension go, not only the extension.
    """
    bad = F.raise_error(F.concat(F.lit("not a compressed file: "), name)).cast("string")
    plain = F.when(name.endswith(".gz"), F.regexp_replace(name, "[.gz]+$", "")).otherwise(bad)
    write_named(lines, path, plain, F.concat(F.col(value), F.lit("\n")))
