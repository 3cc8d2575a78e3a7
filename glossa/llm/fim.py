"""Fill-in-middle transformation by lookaround splitting.

A unit grammar says which characters units are made of.  It is translated to one regular expression
of zero width that matches at every boundary of two units, by the classes of the characters before
and behind it; Spark's ``split`` at it keeps every piece, so the pieces joined give the text back.
A digest of the document's id cuts the units into prefix, middle and suffix and picks the order in
which the output has them, behind marks.  All of it is column expressions: nothing is shuffled, and
a document needs memory in proportion to its own text.

Defined cases: a null text counts as empty; an empty text has no unit (split alone would give one
empty piece); a null id is digested as the empty string; a text that holds one of the marks stays
plain, since its output could not be taken apart; repeated rows give equal outputs; a column named
like the result (``fim``) gives way to it, and all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.operators.scans import fresh

#: Unit grammars: classes of characters that together hold every character once, and how each makes
#: units.  ``run``: characters that follow each other are one unit; ``single``: each is a unit;
#: ``end``: it belongs to the unit before it, and ends it.
CODE = (("A-Za-z", "run"), ("^A-Za-z", "single"))
CHARACTERS = ((r"\x00-\x{10FFFF}", "single"),)
WORDS = ((r"\x20\x09-\x0D", "run"), (r"^\x20\x09-\x0D", "run"))
LINES = ((r"^\n", "run"), (r"\n", "end"))
SEED = "1:"
#: Of 100 documents, so many stay plain, and of 100 others so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")


def boundary(grammar: tuple[tuple[str, str], ...]) -> str:
    """A pattern of zero width that matches between two characters where one unit ends and the next begins.

    A unit goes on behind a character of a run if the next is of the same class, or ends the unit.
    """
    ends = "".join(f"[{c}]" for c, kind in grammar if kind == "end")
    sides = []
    for chars, kind in grammar:
        stays = f"[{chars}]" if kind == "run" else ""
        stays = "" if kind == "end" else stays + ends
        sides.append(f"(?<=[{chars}])" + (f"(?![{stays}])" if stays else "") + "(?=.)")
    return "(?s)(?:" + "|".join(sides) + ")"


def units(text: Column, grammar: tuple[tuple[str, str], ...] = CODE) -> Column:
    """The units of a text, in order; none of an empty one, null of null."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, boundary(grammar), -1))


def _digest_number(hexadecimal: Column, k: int) -> Column:
    return F.conv(F.substring(hexadecimal, 8 * k + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    grammar: tuple[tuple[str, str], ...] = CODE,
    seed: str = SEED,
    plain: int = PLAIN,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = MARKS,
    out: str = "fim",
) -> DataFrame:
    """The documents with a struct ``out``: n, form, prefix_chars, middle_chars (code points; null if plain), output."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == out.lower()])
    own = {c: fresh(c, docs) for c in ("body", "pieces", "digest", "n", "low", "high", "form", "prefix", "middle", "suffix")}
    at = {c: F.col(name) for c, name in own.items()}
    p, s, m = (F.lit(x) for x in marks)

    rows = docs.withColumn(own["body"], F.coalesce(docs[text].cast("string"), F.lit("")))
    rows = rows.withColumns({own["pieces"]: units(at["body"], grammar), own["digest"]: F.sha2(F.concat(F.lit(seed), F.coalesce(docs[doc_id].cast("string"), F.lit(""))), 256)})
    rows = rows.withColumn(own["n"], F.size(at["pieces"]).cast("bigint"))
    cuts = [_digest_number(at["digest"], k) % (at["n"] + 1) for k in (0, 1)]
    marked = F.contains(at["body"], p) | F.contains(at["body"], s) | F.contains(at["body"], m)
    stays = (at["n"] == 0) | marked | (_digest_number(at["digest"], 2) % 100 >= 100 - plain)
    form = F.when(stays, "plain").when(_digest_number(at["digest"], 3) % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.withColumns({own["low"]: F.least(*cuts).cast("int"), own["high"]: F.greatest(*cuts).cast("int"), own["form"]: form})

    def joined(first: Column, count: Column) -> Column:
        return F.when(at["form"] != "plain", F.array_join(F.slice(at["pieces"], first + 1, count), ""))

    parts = {"prefix": joined(F.lit(0), at["low"]), "middle": joined(at["low"], at["high"] - at["low"]), "suffix": joined(at["high"], at["n"].cast("int") - at["high"])}
    rows = rows.withColumns({own[c]: x for c, x in parts.items()})
    psm = F.concat(p, at["prefix"], s, at["suffix"], m, at["middle"])
    spm = F.concat(s, at["suffix"], p, at["prefix"], m, at["middle"])
    output = F.when(at["form"] == "plain", at["body"]).when(at["form"] == "psm", psm).otherwise(spm)
    result = F.struct(
        at["n"].alias("n"),
        at["form"].alias("form"),
        F.length(at["prefix"]).cast("bigint").alias("prefix_chars"),
        F.length(at["middle"]).cast("bigint").alias("middle_chars"),
        output.alias("output"),
    )
    return rows.select(*[F.col(c) for c in docs.columns], result.alias(out))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text, rebuilt from output and form alone.

    No text in another form than plain holds a mark, and a mark neither overlaps itself nor another,
    so the first place of each mark is the one that was set.
    """
    p, s, m = marks

    def between(start: str, stop: str) -> Column:
        begin = F.locate(start, output) + len(start)
        return F.substring(output, begin, F.locate(stop, output) - begin)

    middle = F.substring(output, F.locate(m, output) + len(m), F.length(output))
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
