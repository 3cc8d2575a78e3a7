"""Sentence boundaries learned from the corpus, without rules by language.

A full stop ends a sentence unless it belongs to an abbreviation, an initial or a number; which words
are abbreviations, which start sentences and which follow each other whatever stands between is
counted in the corpus itself (Kiss and Strunk, Unsupervised Multilingual Sentence Boundary
Detection, 2006).  All of it is grouped counting by language and word type:

- abbreviations: Dunning's log-likelihood ratio that the type is nearly always followed by a full
  stop, times e^-length, the number of full stops, and length^-(occurrences without one);
- sentence starters: the ratio that the type stands behind sure ends more often than by chance;
- collocations: the same for pairs around a full stop;
- spelling: whether a type occurs in lower case, and with a capital inside sentences.

Texts are cut where they lie, in Arrow batches that emit each distinct token of many texts once, with
what stands before it in three classes, so patterns run over distinct tokens and not over places.
Only places with a mark leave a text: they are joined with the counts (a table that is broadcast up
to ``BROADCAST_ROWS``, else shuffled), and a document gathers the places of its own boundaries.

Defined cases: null and blank texts have no sentence; white space between words becomes one blank;
a null language is one language; documents that are equal in key and text are one document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.operators.scans import fresh
from glossa.sources.shared import stored

# Thresholds of the published method for abbreviations, collocations and sentence starters.
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
#: How sure a full stop behind an abbreviation is taken to be, in its ratio.
NEARLY_ALWAYS = 0.99
BROADCAST_ROWS = 200_000
NUMBER = "##"
_OUTER = r"^[\"'(\[{«“‘„]+|[\"')\]}»”’]+$"
#: What a token is for the next one: no end, a sure end, a full stop that may belong to a short word or a number.
NONE, SURE, DOUBTFUL = 0, 1, 2
#: Different tokens and pairs that a task counts before it emits them; tokens whose class it remembers.
HELD = 200_000
#: Where ``$`` of Spark's patterns matches within a token.
_LAST = r"(?=[\x85\u2028\u2029]?\Z)"
_OUTER_HERE = re.compile(_OUTER.replace("$", _LAST))
_END, _DIGITS, _MARKS = re.compile(rf"[!?…]{_LAST}|\.\.{_LAST}"), re.compile(rf"[0-9][0-9.,:/-]*{_LAST}"), re.compile(rf"[.!?…]+{_LAST}")


@dataclass
class Statistics:
    """``words``: counts and ratios by (lang, type); ``pairs``: collocations (lang, first, second, ratio)."""

    words: DataFrame
    pairs: DataFrame


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def _described(rows: DataFrame, token: str, prefix: str) -> DataFrame:
    """What a token shows: its type, its end, whether it begins with a capital or a small letter."""
    bare = F.regexp_replace(F.col(token), _OUTER, "")
    lower = F.lower(bare)
    mark = F.when(lower.rlike(r"[!?…]$|\.\.$"), "end").when(lower.endswith("."), "stop").otherwise("none")
    kind = F.when(lower.rlike(r"^[^\p{L}]*\d[\d.,:/-]*$"), F.lit(NUMBER)).otherwise(F.regexp_replace(lower, r"[.!?…]+$", ""))
    return rows.withColumns({f"{prefix}mark": mark, f"{prefix}type": kind, f"{prefix}capital": bare.rlike(r"^\p{Lu}"), f"{prefix}small": bare.rlike(r"^\p{Ll}")})


def _class(token: str) -> int:
    """NONE, SURE or DOUBTFUL, by the same patterns as ``_described``."""
    lower = _OUTER_HERE.sub("", token).lower()
    if _END.search(lower):
        return SURE
    if not lower.endswith("."):
        return NONE
    number = _DIGITS.search(lower) and not any(map(str.isalpha, lower))
    return DOUBTFUL if number or len(_MARKS.sub("", lower)) <= 3 else SURE


class _Classes(dict):
    """The classes of the tokens that a task has met."""

    def __missing__(self, token: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        found = self[token] = _class(token.decode("utf-8", "replace"))
        return found


def _marked(words: list[bytes], classes: _Classes) -> tuple[bytes, list[int]]:
    """Each word's class, and the places of those that aren't NONE and have a word behind them."""
    found = bytes(map(classes.__getitem__, words))
    return found, np.flatnonzero(np.frombuffer(found[:-1], np.uint8)).tolist()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, token, next, n, sure, doubtful): a token's number, and of these how many stand behind a sure and a doubtful end; or, with ``next``, a pair's number."""
    classes = _Classes()
    held: dict[str, tuple[Counter, Counter, Counter]] = {}

    def emitted() -> Iterator[pa.RecordBatch]:
        for lang, (every, sure, pairs) in held.items():
            doubtful: Counter = Counter()
            for (_, after), n in pairs.items():
                doubtful[after] += n
            tokens, firsts, none = list(every), [a for a, _ in pairs], [0] * len(pairs)
            columns = [
                pa.repeat(lang, len(tokens) + len(pairs)),
                pa.array(tokens + firsts, pa.binary()),
                pa.array([None] * len(tokens) + [b for _, b in pairs], pa.binary()),
                pa.array([*every.values(), *pairs.values()], pa.int64()),
                pa.array([sure[t] for t in tokens] + none, pa.int64()),
                pa.array([doubtful[t] for t in tokens] + none, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "token", "next", "n", "sure", "doubtful"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = text.as_py().split()  # bytes are cut at ASCII white space, as by Spark's \s
            every, sure, pairs = held.setdefault(lang, (Counter(), Counter(), Counter()))
            every.update(words)
            found, at = _marked(words, classes)
            sure.update([words[k + 1] for k in at if found[k] == SURE])
            pairs.update([(words[k], words[k + 1]) for k in at if found[k] == DOUBTFUL])
            if sum(len(e) + len(p) for e, _, p in held.values()) >= HELD:
                yield from emitted()
    yield from emitted()


def _stops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lang, at, token, next) of the places with a mark and a token behind them."""
    classes = _Classes()
    for batch in batches:
        rows, places, tokens, after = [], [], [], []
        for row, text in enumerate(batch.column(2)):
            words = text.as_py().split()
            _, at = _marked(words, classes)
            rows += [row] * len(at)
            places += at
            tokens += [words[k] for k in at]
            after += [words[k + 1] for k in at]
        of = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(places, pa.int32()), pa.array(tokens, pa.binary()), pa.array(after, pa.binary())], ["id", "lang", "at", "token", "next"])


def _texts(docs: DataFrame, lang: str, text: str, *more: Column) -> DataFrame:
    return docs.select(*more, F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def _as_strings(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("string") for c in ("token", "next")})


def _log(x: Column) -> Column:
    return F.log(F.greatest(x, F.lit(1e-12)))


def ratio(ab: Column, a: Column, b: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of two events: b together with a (ab of a times) and in all (b of n times)."""

    def likelihood(k: Column, of: Column, p: Column) -> Column:
        return k * _log(p) + (of - k) * _log(1 - p)

    p, with_a, without = b / n, ab / a, F.coalesce((b - ab) / F.nullif(n - a, F.lit(0)), F.lit(0.0))
    return -2 * (likelihood(ab, a, p) + likelihood(b - ab, n - a, p) - likelihood(ab, a, with_a) - likelihood(b - ab, n - a, without))


def _abbreviation_score(kind: Column, stops: Column, plain: Column, all_stops: Column, n: Column) -> Column:
    p, a = all_stops / n, stops + plain
    null = stops * _log(p) + plain * _log(1 - p)
    alternative = stops * F.log(F.lit(NEARLY_ALWAYS)) + plain * F.log(F.lit(1 - NEARLY_ALWAYS))
    inner = F.length(kind) - F.length(F.replace(kind, F.lit("."), F.lit("")))
    length = F.length(kind) - inner
    score = -2 * (null - alternative) * F.exp(-length) * (inner + 1) * F.pow(length.cast("double"), -plain)
    return F.when((stops > 0) & (a > 0) & kind.rlike(r"\p{L}"), score)


def _met(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return stored(_as_strings(_texts(docs, lang, text).mapInArrow(_counted, "lang string, token binary, next binary, n bigint, sure bigint, doubtful bigint")))


def learn_words(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``words`` of ``learn`` alone."""
    return _words(_met(docs, lang, text))


def _words(met: DataFrame) -> DataFrame:
    rows = _described(met.filter("next IS NULL"), "token", "")
    total = lambda n, of: F.sum(F.when(of, n).otherwise(0))
    counted = rows.groupBy("lang", "type").agg(
        total(F.col("n"), F.col("mark") == "stop").alias("stops"),
        total(F.col("n"), F.col("mark") != "stop").alias("plain"),
        total(F.col("n"), F.col("small")).alias("small"),
        total(F.col("n") - F.col("sure") - F.col("doubtful"), F.col("capital")).alias("inside"),
        F.sum("sure").alias("starts"),
    )
    counted = stored(counted)
    sums = counted.groupBy(F.col("lang").alias("l")).agg(F.sum("stops").alias("all_stops"), F.sum(F.col("stops") + F.col("plain")).alias("n"), F.sum("starts").alias("all_starts"))
    words = counted.join(sums, F.col("lang") == F.col("l")).drop("l")
    a = F.col("stops") + F.col("plain")
    more = (F.col("starts") > 0) & (F.col("starts") / a > F.col("all_starts") / F.col("n"))
    words = words.withColumns(
        {
            "score": _abbreviation_score(F.col("type"), F.col("stops"), F.col("plain"), F.col("all_stops"), F.col("n")),
            "starter": F.when(more & F.col("type").rlike(r"^\p{L}"), ratio(F.col("starts"), a, F.col("all_starts"), F.col("n"))),
        }
    )
    return words


def learn(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Statistics:
    """What the corpus tells about its word types."""
    met = _met(docs, lang, text)
    words = stored(_words(met))

    # pairs around a full stop whose first word is short enough to be an abbreviation, or a number
    joined = _described(_described(met.filter("next IS NOT NULL"), "token", ""), "next", "n_").filter("n_type != ''")
    pairs = joined.groupBy("lang", "type", "n_type").agg(F.sum("n").alias("ab")).filter("ab > 1")
    first = words.select(F.col("lang").alias("l1"), F.col("type").alias("first"), F.col("stops").alias("a"), F.col("n"))
    second = words.select(F.col("lang").alias("l2"), F.col("type").alias("second"), (F.col("stops") + F.col("plain")).alias("b"))
    pairs = pairs.join(first, (F.col("lang") == F.col("l1")) & (F.col("type") == F.col("first"))).join(second, (F.col("lang") == F.col("l2")) & (F.col("n_type") == F.col("second")))
    both = F.when(F.col("ab") / F.col("a") > F.col("b") / F.col("n"), ratio(F.col("ab"), F.col("a"), F.col("b"), F.col("n")))
    return Statistics(words, stored(pairs.select("lang", "first", "second", both.alias("ratio")).filter(F.col("ratio") > COLLOCATION)))


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def boundaries(docs: DataFrame, statistics: Statistics, *, key: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, at): the places of the tokens that end a sentence; the last token of a text is none."""
    rows = _texts(docs, lang, text, F.col(key).alias("id")).mapInArrow(_stops, f"id {docs.schema[key].dataType.simpleString()}, lang string, at int, token binary, next binary")
    rows = _described(_described(_as_strings(rows), "token", ""), "next", "n_")
    doubtful = (F.col("score") >= ABBREVIATION) | (F.col("type") == NUMBER) | F.col("type").rlike(r"^\p{L}$")
    first = statistics.words.filter(doubtful).select(F.col("lang").alias("l1"), F.col("type").alias("first"), (F.col("score") >= ABBREVIATION).alias("short"))
    starts = F.coalesce(F.col("starter") >= STARTER, F.lit(False))
    second = statistics.words.filter(starts | ((F.col("small") > 0) & (F.col("inside") == 0))).select(F.col("lang").alias("l2"), F.col("type").alias("second"), starts.alias("starts"))
    pairs = statistics.pairs.select(F.col("lang").alias("l3"), F.col("first").alias("f"), F.col("second").alias("s"))
    found = rows.join(_few(first), (F.col("lang") == F.col("l1")) & (F.col("type") == F.col("first")), "left")
    found = found.join(_few(second), (F.col("lang") == F.col("l2")) & (F.col("n_type") == F.col("second")), "left")
    found = found.join(_few(pairs), (F.col("lang") == F.col("l3")) & (F.col("type") == F.col("f")) & (F.col("n_type") == F.col("s")), "left")
    together = F.col("f").isNotNull()
    starter = F.col("n_capital") & F.coalesce("starts", F.lit(False))
    begins = F.col("n_capital") & F.col("second").isNotNull()  # a starter, or a word that has a capital only where sentences begin
    ends = (
        F.when(F.col("mark") == "end", ~F.col("n_small"))
        .when(F.col("first").isNull(), True)
        .when(together | F.col("n_small"), False)
        .when(F.col("type").rlike(r"^\p{L}$"), starter)
        .when(F.col("short"), begins)
        .otherwise(True)
    )
    return found.filter(ends).select(F.col("id").alias(key), "at")


def with_sentences(docs: DataFrame, statistics: Statistics, *, key: str, text: str = "text", lang: str = "lang", out: str = "sentences") -> DataFrame:
    """The documents with ``out``: their sentences in order."""
    found = boundaries(docs, statistics, key=key, text=text, lang=lang)
    of, ends = fresh("of", docs), fresh("ends", docs)
    gathered = found.groupBy(F.col(key).alias(of)).agg(F.array_sort(F.collect_set("at")).alias(ends))
    rows = docs.drop(out).join(gathered, F.col(key).eqNullSafe(F.col(of)), "left")
    words, stops = fresh("words", rows), fresh("stops", rows)
    # generators of one row: what a lambda refers to is computed once a text, not once a sentence
    rows = rows.withColumn(words, F.explode(F.array(tokens(F.col(text)))))
    rows = rows.withColumn(stops, F.explode(F.array(F.array_append(F.coalesce(ends, F.array().cast("array<int>")), F.size(words) - 1))))
    cut = F.transform(stops, lambda at, k: F.array_join(F.slice(words, F.when(k == 0, 1).otherwise(F.get(stops, k - 1) + 2), at - F.when(k == 0, -1).otherwise(F.get(stops, k - 1))), " "))
    return rows.withColumn(out, F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(cut)).drop(of, ends, words, stops)
