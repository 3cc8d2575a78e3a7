"""Operators over ordered lines: fill-down, and grouping of tokens into sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.operators import scans
from glossa.operators.scans import fresh

# Marks that are glued to the token before them.
MARKS = (".", ",", "!", "?", ":", ";")
GEEZ_MARKS = ("፠", "፡", "።", "፣", "፤", "፥", "፦", "፧", "፨")


def filled_down(rows: DataFrame, column: str, order: str, keys: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """Blank values take the last value before them, within keys if there are any.

    A scan over ranges of the order: neither the table nor one key has to fit into a task.
    """
    value, of, last = fresh("value", rows), fresh("keys", rows), fresh("last", rows)
    given = F.when(F.trim(F.col(column)) != "", F.struct(F.struct(*(keys or [F.lit(0)])).alias(of), F.col(column).alias(value)))
    out = scans.filled(rows, [F.col(c) for c in (*keys, order)], {last: given}, ranges)
    same = F.col(f"{last}.{of}").eqNullSafe(F.struct(*(keys or [F.lit(0)])))
    return out.withColumn(column, F.when(same, F.col(f"{last}.{value}"))).drop(last)


def joined_tokens(tokens: Column, marks: tuple[str, ...] = MARKS) -> Column:
    """Tokens as a sentence: a blank before each token but a mark."""
    return F.ltrim(F.aggregate(tokens, F.lit(""), lambda out, t: F.concat(out, F.when(t.isin(*marks), t).otherwise(F.concat(F.lit(" "), t)))))


def grouped_sentences(lines: DataFrame, *, file: str = "file_name", order: str = "line_no", value: str = "value", boundary: Column | None = None, keep_last: bool = True, marks: tuple[str, ...] = MARKS, ranges: int | None = None) -> DataFrame:
    """(file, island, sentence): tokens up to a blank line (or another boundary); the last ones without a boundary if asked for.

    Islands are numbered by a running sum over ranges of files and lines, so a file may fill many tasks.
    """
    blank, all_so_far, least, most = (fresh(c, lines) for c in ("blank", "sum", "least", "most"))
    flagged = lines.withColumn(blank, F.coalesce(F.trim(value) == "" if boundary is None else boundary, F.lit(False)).cast("int"))
    summed = scans.running(flagged, [F.col(file), F.col(order)], {all_so_far: F.col(blank)}, ranges)
    of = fresh("of", summed)
    ends = summed.groupBy(F.col(file).alias(of)).agg(F.min(F.col(all_so_far) - F.col(blank)).alias(least), F.max(all_so_far).alias(most))
    numbered = summed.filter(F.col(blank) == 0).join(ends, F.col(file).eqNullSafe(F.col(of))).withColumn("island", F.col(all_so_far) - F.col(least))
    if not keep_last:
        numbered = numbered.filter(F.col(all_so_far) < F.col(most))
    tokens = numbered.groupBy(file, "island").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(value).alias("token")))).alias("tokens"))
    return tokens.select(file, "island", joined_tokens(F.transform("tokens", lambda t: t["token"]), marks).alias("sentence"))


def annotated_texts(lines: DataFrame, value: str = "value") -> DataFrame:
    """The texts of lines that give them."""
    mark = "# text = "
    return lines.filter(F.col(value).startswith(mark)).select(F.substring(value, len(mark) + 1, 2147483647).alias("sentence"))
