"""Text, URL and file-name functions as Column expressions.

They stay inside generated code and follow Python's string semantics where those differ from
Spark's (Unicode white space, character-set strips, percent decoding, capitalisation).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType, StructType

from glossa.functions import json5

# Beginnings of paragraphs that are interface text or placeholders, not article text.
BOILERPLATE = (
    "No media source currently available",
    "Already have an account?",
    "Log in",
    "Sign up",
    "Not a registered user?",
    "The code has been copied to your clipboard",
    "The URL has been copied to your clipboard",
    "Embed",
    "0:",
    "share",
    "Telegram Banner",
    "ዝርዝሩን ከተያያዘው የድምጽ ፋይል ያድምጡ፡፡",
    "ອ່ານຂ່າວນີ້ຕື່ມເປັນພາສາອັງກິດ",
    "ምሉእ ትሕዝቶ ኣብዚ ምስማዕ ይክኣል::",
    "Дивіться також:",
    '"Amerika Ovozi" -',
    "Avec Reuters",
    "Avec AFP",
    "Clique aqui para ouvir",
    "- Clique aqui para ouvir",
    "- Clique para ouvir",
    "-Clique para ouvir",
    "Clique na barra sobre este texto",
    "<!-- IMAGE -->",
)
# The shorter list that decides whether a scraped page has paragraphs.
SCRAPE_BOILERPLATE = BOILERPLATE[:5]
# Agencies whose texts may not be released.
BYLINES = ("AP", "Associated Press", "AFP", "Agence France-Presse", "Reuters")
TITLE_STARTS = ("AP ", "AFP ")
# Spellings of the image marker that occur inside paragraphs.
IMAGE_MARKS = ("<!-- IMAGE -->", "<!--IMAGE -->", "<!-- IMAGE-->", "<-- IMAGE -->", "!--IMAGE-LEFT-->", "<!--IMAGE--", "<!--IMAGE-LEFT-->", "<!--IMAGE-->")
# Characters that stand for blanks but aren't white space.
SPACE_CHARS = "\u1361\u200b\u2408\u2420\u303f\ufeff"
#: Python's white space, as a character class of Java's patterns.
WHITE = r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def with_field(schema: StructType, ddl: str) -> StructType:
    """The schema with more fields."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    The optimiser copies a column's expression to each of its uses; a lambda's variable it can't.
    """
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def literal(text: str) -> str:
    """A pattern that matches the text."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", text)


def any_of(texts: tuple[str, ...]) -> str:
    return "|".join(map(literal, texts))


def strip(x: Column) -> Column:
    """Python's ``str.strip``: Spark's trim takes blanks only."""
    return F.regexp_replace(x, f"^{WHITE}+|{WHITE}+$", "")


def collapse(x: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(x, f"{WHITE}+", " "))


def is_text(paragraph: Column, starts: tuple[str, ...] = BOILERPLATE) -> Column:
    """Not empty and no boilerplate; the paragraph itself is not rewritten."""
    flat = collapse(paragraph)
    return (flat != "") & ~flat.rlike(f"^(?:{any_of(starts)})")


def is_scraped_text(paragraph: Column) -> Column:
    """The weaker rule of scraping time, which does not collapse inner white space."""
    flat = strip(paragraph)
    return (flat != "") & ~flat.rlike(f"^(?:{any_of(SCRAPE_BOILERPLATE)})")


def text_paragraphs(paragraphs: Column) -> Column:
    return F.filter(paragraphs, lambda p: is_text(p))


def without_image_marks(x: Column) -> Column:
    return F.regexp_replace(x, any_of(IMAGE_MARKS), "")


def without_space_chars(x: Column) -> Column:
    return F.regexp_replace(x, f"[{SPACE_CHARS}]", "")


def strip_space_chars(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACE_CHARS))


def author_allowed(byline: Column, authors: Column, utag_size: Column, bad: tuple[str, ...] = BYLINES) -> Column:
    """No agency name inside the byline or an author; without page metadata everything passes."""
    pattern = any_of(bad)
    named = F.coalesce(byline.rlike(pattern), F.lit(False)) | F.coalesce(F.exists(authors, lambda a: F.coalesce(a.rlike(pattern), F.lit(False))), F.lit(False))
    return (F.coalesce(utag_size, F.lit(0)) <= 0) | ~named


def title_allowed(title: Column, starts: tuple[str, ...] = TITLE_STARTS) -> Column:
    hit = F.lit(False)
    for s in starts:
        hit = hit | F.coalesce(title.startswith(s), F.lit(False))
    return ~hit


def capitalize(x: Column) -> Column:
    """The first letter in upper case, the rest in lower case (``initcap`` does so word by word)."""
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 2147483647)))


def unquote(url: Column) -> Column:
    """Percent decoding that leaves + and malformed escapes alone."""
    plain = F.regexp_replace(F.replace(url, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(plain), url)


def _each_replaced(x: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for old, new in pairs:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def url_parts(url: Column) -> Column:
    """struct<domain, filename> of an article URL; null where the URL has no single site part."""
    plain = _each_replaced(unquote(url), ((".net/", ".com/"), (".gov/", ".com/"), (".org/", ".com/")))
    parts = F.split(plain, r"\.com/")
    domain = _each_replaced(F.get(parts, F.lit(0)), (("www.", ""), ("https://", ""), ("http://", ""), (".", "_")))
    filename = F.btrim(F.replace(F.get(parts, F.lit(1)), F.lit("/"), F.lit("_")), F.lit(".html"))
    return F.when(F.size(parts) == 2, F.struct(domain.alias("domain"), filename.alias("filename")))


def sanitize_url(url: Column) -> Column:
    """A URL as a file name."""
    marked = F.translate(url, "?,=", "___")
    return F.regexp_replace(_each_replaced(marked, (("https://www.", ""), ("http://www.", ""), ("https://", ""), ("/", "_"))), f"{WHITE}+", "_")


def domain_outpath(news_url: Column) -> Column:
    """A site's URL as the name of its output."""
    return F.concat(F.rtrim(_each_replaced(news_url, (("http://", ""), ("www.", ""), ("www1.", ""), ("/", "_"))), F.lit("_")), F.lit(".json"))


def with_suffix(name: Column, suffix: str) -> Column:
    """The name with its last suffix replaced."""
    return F.concat(F.regexp_replace(name, r"(?<=.)\.[^./]*$", ""), F.lit(suffix))


def html_to_txt(name: Column) -> Column:
    return F.concat(F.replace(name, F.lit(".html"), F.lit("")), F.lit(".txt"))


def iso_of_section(section: Column) -> Column:
    """The part before the first underscore; null where there is none."""
    return F.when(F.instr(section, "_") > 0, F.split_part(section, F.lit("_"), F.lit(1)))


def path_part(path: Column, from_end: int) -> Column:
    """A part of a path, counted from the end: 1 is the file."""
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


@arrow_udf(StringType())
def _decoded(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unescape(t) for t in texts.to_pylist()], pa.string())


@arrow_udf(StringType())
def _decoded_whole(texts: pa.Array) -> pa.Array:
    """Only references with their semicolon."""
    one = lambda m: unescape(m[0]) if m[1][0] == "#" or f"{m[1]};" in html5 else m[0]
    return pa.array([None if t is None else re.sub(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", one, t) for t in texts.to_pylist()], pa.string())


def title_of(html: Column, iso: Column | None = None, *, terminated: bool = False) -> Column:
    """The text of ``<title>``, its character references decoded, or the empty string; one site's suffix is stripped as a set of characters.

    Pages that end references anyhow (``&amp`` for ``&amp;``) are decoded as browsers do, unless only ``terminated`` ones count.
    """
    decoded = _decoded_whole if terminated else _decoded
    title = decoded(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    if iso is None:
        return title
    return F.when(iso == "kor", F.btrim(title, F.lit("| Voice of America - Korean"))).otherwise(title)


def authors_of(stored: Column, meta: Column, byline: Column, ld_authors: Column) -> Column:
    """The first source that names authors: the stored ones, the page's, the byline, the linked data's."""

    def named(x: Column) -> Column:
        return F.when(F.coalesce(F.length(x), F.lit(0)) > 0, F.transform(F.split(x, ","), strip))

    return F.coalesce(F.when(F.size(stored) > 0, stored), named(meta), named(byline), ld_authors)


def utag_json(html: Column) -> Column:
    """The object assigned to ``utag_data`` on one line of a script, as JSON; null where it isn't JSON5."""
    found = F.regexp_extract(html, r"var utag_data\s*=\s*(\{(?:(?!</script).)*\})", 1)
    return json5.lenient(F.when(found != "", found))


def utag_map(html: Column) -> Column:
    """``utag_data`` as a map (nested values as JSON); an object that can't be read is empty."""
    return F.coalesce(F.from_json(utag_json(html), "map<string,string>"), F.create_map().cast("map<string,string>"))


def ld_json(html: Column) -> Column:
    """The first non-empty linked-data script."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    return F.get(F.filter(F.transform(scripts, strip), lambda s: s != ""), F.lit(0))


def rendered(units: str, paragraphs: Column, *, title: Column | None = None, authors: Column | None = None, limit: int = 0) -> Column:
    """A document as text: title and authors, a blank line, then its units with a blank line after each paragraph.

    ``units`` is paragraphs (array<string>), sentences (array<array<string>>) or tokens (one level
    deeper).  A limit counts paragraphs, or else sentences; where it ends the text inside, no blank
    line follows a sentence, as none does in reading order.
    """
    if units not in ("paragraphs", "sentences", "tokens"):
        raise ValueError(f"unknown unit {units}")
    if units == "tokens" and title is not None:
        raise ValueError("a title has no tokens")
    head = F.lit("")
    if title is not None:
        head = F.concat(head, F.when(F.coalesce(F.length(title), F.lit(0)) > 0, F.concat(title, F.lit("\n"))).otherwise(""))
    if authors is not None:
        head = F.concat(head, F.when(F.coalesce(F.size(authors), F.lit(0)) > 0, F.concat(F.array_join(authors, "\n"), F.lit("\n"))).otherwise(""))
    if title is not None or authors is not None:
        head = F.when(head != "", F.concat(head, F.lit("\n"))).otherwise("")
    if units == "paragraphs":
        kept = F.slice(paragraphs, 1, limit) if limit else paragraphs
        return F.concat(head, F.array_join(F.transform(kept, lambda p: F.concat(p, F.lit("\n\n"))), ""))
    sentences = F.transform(paragraphs, lambda p: F.transform(p, lambda s: F.array_join(s, " "))) if units == "tokens" else paragraphs
    lines = F.flatten(F.transform(sentences, lambda p: F.concat(F.transform(p, lambda s: F.struct(F.lit(1).alias("n"), F.concat(s, F.lit("\n")).alias("text"))), F.array(F.struct(F.lit(0).alias("n"), F.lit("\n").alias("text"))))))
    if limit:
        start = F.struct(F.lit(0).alias("n"), F.lit("").alias("text"))
        done = F.aggregate(lines, start, lambda a, x: F.when(a["n"] >= limit, a).otherwise(F.struct((a["n"] + x["n"]).alias("n"), F.concat(a["text"], x["text"]).alias("text"))))
        return F.concat(head, done["text"])
    return F.concat(head, F.array_join(F.transform(lines, lambda x: x["text"]), ""))


def shortened(name: Column, most: int = 100) -> Column:
    """The last characters of a name that is too long for a file."""
    return F.when(F.length(name) > most, F.right(name, F.lit(most))).otherwise(name)


def linked_data(html: Column) -> Column:
    """The first linked-data script as a variant; one that isn't JSON5 is an error."""
    return json5.variant(ld_json(html))
