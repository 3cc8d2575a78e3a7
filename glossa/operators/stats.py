"""Counts, means, pivots, histograms and top lists over a corpus.

Everything is one grouped aggregation (Spark sums partially before the shuffle) or a window over
its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossa.sources.shared import stored

#: Rows of a table that is broadcast.
FEW = 200_000
#: Languages and counts that reports leave out.
HIDDEN, LEAST = ("bam",), 10


def counted(rows: DataFrame, *keys: str, name: str = "n_docs") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def reported(counts: DataFrame, value: str, *, key: str = "language", least: float = LEAST) -> DataFrame:
    """Rows for a report: without hidden languages and small values, with the logarithm."""
    return counts.filter(~F.col(key).isin(*HIDDEN) & (F.col(value) >= least)).withColumn(f"log_{value}", F.round(F.log10(value), 6))


def measured(rows: DataFrame, key: str, **values: Column) -> DataFrame:
    """Sum and mean of each value by key, nulls counting as zero."""
    out = []
    for name, value in values.items():
        x = F.coalesce(value, F.lit(0))
        out += [F.sum(x).alias(f"total_{name}"), F.round(F.avg(x), 6).alias(f"mean_{name}")]
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_docs"), *out)


def pivoted(rows: DataFrame, row: str, column: str, values: list[str] | None = None, total: str = "Total") -> DataFrame:
    """Counts by two keys as a table with a row of totals; absent pairs are zero."""
    grouped = rows.groupBy(row)
    table = (grouped.pivot(column, values) if values else grouped.pivot(column)).count().fillna(0)
    names = [c for c in table.columns if c != row]
    sums = table.agg(*[F.sum(c).alias(c) for c in names]).select(F.lit(total).alias(row), *names)
    return table.unionByName(sums)


def unpivoted(table: DataFrame, row: str, name: str, value: str) -> DataFrame:
    """A table as long rows with the logarithm of each count that isn't zero."""
    names = [c for c in table.columns if c != row]
    long = table.unpivot([row], names, name, value)
    return long.withColumn(f"log_{value}", F.when(F.col(value) > 0, F.round(F.log10(value), 6)))


def per_year(rows: DataFrame, *, key: str, year: Column, least: int = LEAST) -> DataFrame:
    """Documents by year over the languages that have enough of them."""
    counts = rows.select(F.col(key).alias("_key"), year.alias("year")).dropna().groupBy("_key", "year").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.withColumn("_all", F.sum("n").over(W.partitionBy("_key")))
    return whole.filter(~F.col("_key").isin(*HIDDEN) & (F.col("_all") >= least)).groupBy("year").agg(F.sum("n").alias("n_docs"))


def top(rows: DataFrame, order: list[Column], k: int, keys: list[str] | None = None) -> DataFrame:
    """The first k rows, of each key if keys are given."""
    if not keys:
        return rows.orderBy(*order).limit(k)
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def longest(rows: DataFrame, value: str, k: int, key: str) -> DataFrame:
    """The k longest distinct texts of each key, with their length ``n`` and rank.

    Lengths and hashes give the length that a text needs (hashes that meet only lower it), so that
    few texts are shuffled; the table of these lengths has one row for each key, and is broadcast if
    it has at most FEW rows.
    """
    n = F.length(value).alias("n")
    heads = top(rows.select(key, n, F.xxhash64(value).alias("_h")).distinct(), [F.desc("n")], k, [key])
    least = heads.groupBy(F.col(key).alias("_k")).agg(F.min("n").alias("_least"))
    least = stored(least)
    least = F.broadcast(least) if least.limit(FEW + 1).count() <= FEW else least
    found = rows.select(key, value, n).join(least, F.col(key).eqNullSafe(F.col("_k"))).filter("n >= _least").select(key, value, "n").distinct()
    return top(found, [F.desc("n"), F.desc(value)], k, [key])


def frequency(rows: DataFrame, value: Column, name: str, k: int = 0) -> DataFrame:
    """How often each value occurs, most frequent first with ties in the order of values."""
    counts = rows.select(value.alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc(name)]
    return top(counts, order, k) if k else counts.orderBy(*order)


def exploded_frequency(rows: DataFrame, values: Column, name: str) -> DataFrame:
    return counted(rows.select(F.explode(values).alias(name)), name, name="n")


def segmentation(docs: DataFrame, key: str, n_paragraphs: str, n_sentences: str) -> DataFrame:
    """Mean paragraphs by sentence (documents without sentences count as zero), segmented and unsegmented documents."""
    rate = F.when(F.col(n_sentences) > 0, F.col(n_paragraphs) / F.col(n_sentences))
    mean = F.sum(F.coalesce(rate, F.lit(0.0))) / F.count(F.lit(1))
    return docs.groupBy(key).agg(F.round(mean, 6).alias("mean_rate"), F.count_if(rate < 1).alias("n_segmented"), F.count_if(rate >= 1).alias("n_unsegmented"))


def sentence_end(sentence: Column) -> Column:
    """The last piece of the last five characters."""
    return F.element_at(F.split(F.right(sentence, F.lit(5)), r"\s+"), -1)


def last_char(paragraph: Column) -> Column:
    """The last character; null for a blank paragraph."""
    flat = F.rtrim(paragraph)
    return F.when(flat != "", F.right(flat, F.lit(1)))


def code_point(char: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(F.ascii(char))))


def url_counts(urls: DataFrame, key: str, url: str) -> DataFrame:
    """URLs of each key, and how many of them repeat another."""
    return urls.groupBy(key).agg(F.count(url).alias("n_urls"), (F.count(url) - F.countDistinct(url)).alias("n_duplicates"))


def conditional_counts(rows: DataFrame, key: str, **conditions: Column) -> DataFrame:
    """One pass over all conditions; null verdicts don't count."""
    return rows.groupBy(key).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def lonely(rows: DataFrame, value: str, condition: Column, by: str) -> DataFrame:
    """Values that occur once, on a row that meets the condition, counted by another column."""
    one = rows.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.max(condition).alias("_met"), F.max(by).alias(by))
    return one.filter((F.col("n") == 1) & F.col("_met")).groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def listed_by_date(rows: DataFrame, date: Column, value: str, sep: str = "\t") -> DataFrame:
    """Values of each date, sorted and joined; rows without a date are left out."""
    return rows.select(date.alias("date"), F.col(value).alias("_v")).filter("date IS NOT NULL").groupBy("date").agg(F.array_join(F.array_sort(F.collect_list(F.col("_v").cast("string"))), sep).alias("listed"))


def document_sizes(paragraphs: str = "paragraphs", sentences: str = "sentences", tokens: str = "tokens") -> list[Column]:
    """What a document counts of itself: paragraphs, characters in them, tokens and sentences (null where there are none)."""
    chars = F.aggregate(paragraphs, F.lit(0).cast("long"), lambda n, p: n + F.length(p))
    held = F.coalesce(F.size(tokens), F.lit(0)) > 0
    words = F.aggregate(F.flatten(tokens), F.lit(0).cast("long"), lambda n, s: n + F.size(s))
    n_sentences = F.aggregate(sentences, F.lit(0).cast("long"), lambda n, p: n + F.size(p))
    return [
        F.size(paragraphs).cast("long").alias("n_paragraphs"),
        chars.alias("n_chars"),
        F.when(held, words).alias("n_tokens"),
        F.when(F.coalesce(F.size(sentences), F.lit(0)) > 0, n_sentences).alias("n_sentences"),
    ]


def joint_counts(docs: DataFrame, *, key: str = "site_language", sentences: str = "sentences", tokens: str = "tokens", corrupt: str = "_corrupt_record", error: str = "ERROR_None") -> DataFrame:
    """Documents, sentences and tokens by language, in order; unreadable documents are a language of their own.

    Each paragraph's list counts as one sentence, and its lists of tokens as the lists of a sentence.
    """
    bad = F.col(corrupt).isNotNull()
    n_sentences = F.when(bad, 0).otherwise(F.coalesce(F.size(sentences), F.lit(0)))
    n_tokens = F.when(bad, 0).otherwise(F.coalesce(F.aggregate(F.flatten(tokens), F.lit(0).cast("long"), lambda n, s: n + F.size(s)), F.lit(0)))
    rows = docs.select(F.when(bad, error).otherwise(F.col(key)).alias("Language"), n_sentences.alias("s"), n_tokens.alias("t"))
    counts = rows.groupBy("Language").agg(F.count(F.lit(1)).alias("Document"), F.sum("s").cast("long").alias("Sentence"), F.sum("t").cast("long").alias("Token"))
    return counts.orderBy("Language")


def with_errors(rows: DataFrame, corrupt: Column, **names: str) -> DataFrame:
    """Columns of unreadable rows set to names of their own, so that a pivot counts them."""
    return rows.withColumns({c: F.when(corrupt, F.lit(name)).otherwise(F.col(c)) for c, name in names.items()})


def crossed(rows: DataFrame, row: str, column: str) -> DataFrame:
    """Counts by two keys as a table, rows and columns in order, absent pairs zero."""
    table = rows.groupBy(row).pivot(column).count().fillna(0)
    return table.select(row, *sorted(c for c in table.columns if c != row)).orderBy(row)


def united_counts(left: DataFrame, right: DataFrame, key: str, value: str = "n") -> DataFrame:
    """Two tables of counts as one; a key that one of them lacks counts zero there."""
    return left.select(key, value).unionByName(right.select(key, value)).groupBy(key).agg(F.sum(value).alias(value))


def ranked(counts: DataFrame, value: str, *, name: str | None = None) -> DataFrame:
    """A table of counts for a chart: largest first."""
    out = counts.withColumnRenamed(value, name) if name else counts
    return out.orderBy(F.desc(name or value), *[c for c in out.columns if c != (name or value)])


def latex(rows: DataFrame, most: int = 10_000) -> str:
    """A small table for a paper; a larger one than ``most`` rows is an error."""
    held = rows.limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} rows")
    spelt = lambda x: f"{x:,d}" if isinstance(x, int) and not isinstance(x, bool) else "" if x is None else str(x)
    escaped = lambda x: spelt(x).replace("_", r"\_").replace("&", r"\&").replace("%", r"\%")
    lines = [" & ".join(map(escaped, r)) + r" \\" for r in (rows.columns, *held)]
    return "\n".join([rf"\begin{{tabular}}{{{'l' * len(rows.columns)}}}", lines[0], r"\hline", *lines[1:], r"\end{tabular}"])
