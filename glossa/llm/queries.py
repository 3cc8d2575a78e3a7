"""The queries of this subpackage: thin digests of its operators over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm import decontaminate as dc
from glossa.llm import fim
from glossa.llm import licenses as li
from glossa.llm import linededup as ld
from glossa.llm import maintext as mt
from glossa.llm import mixing as mx
from glossa.llm import oracles, phrases, pii
from glossa.llm import pieces as pc
from glossa.llm import quality as ql
from glossa.llm import secrets as sc
from glossa.llm import simhash as sh
from glossa.llm import warc
from glossa.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dc.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]))
    longest = F.array_min(F.transform("matches", lambda m: F.struct((-m["n_words"]).alias("n"), m["doc_word"].alias("at"), m["item_id"].alias("item"))))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        (-longest["n"]).cast("long").alias("longest_words"),
        longest["at"].cast("long").alias("longest_at"),
        longest["item"].alias("longest_item"),
    )


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = mt.extract(pages, mt.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ql.judge(docs, ql.fit(docs, table(spark, sf_dir, "labels")))


def _spelt(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _base_digest(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    base = df.withColumn("base", F.filter("spans", lambda s: s["kind"].isin(*kinds)))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return base.select("doc_id", *map(count, kinds), F.sha2(_spelt("base"), 256).alias("base_sha256"), _spelt("spans").alias("spans"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pc.encode(table(spark, sf_dir, "documents"), pc.Pieces.load(), with_ids=False)
    return found.select(
        "doc_id",
        "n_pieces",
        "n_unknown",
        F.round(F.get("scores", F.lit(0)), 6).alias("score"),
        F.round(F.get("scores", F.lit(0)) - F.get("scores", F.lit(1)), 6).alias("margin"),
        "ids_sha256",
        F.get("others_sha256", F.lit(0)).alias("second_sha256"),
        "round_trip",
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sh.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = li.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.transform("places", lambda p: p["label"])
    both = F.concat(base, F.transform("finds", lambda f: f["label"]))
    best = F.aggregate("finds", F.lit(0.0), lambda m, f: F.greatest(m, f["containment"]))

    def spelt(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["word"])).alias("last_word"),
        spelt(base).alias("base_labels"),
        spelt(both).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base_digest(pii.find_personal_data(table(spark, sf_dir, "documents")), pii.KINDS[:4])


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base_digest(sc.find_secrets(table(spark, sf_dir, "documents")), sc.KINDS[:3])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ld.dedup_lines(docs, counts=("n_lines", "n_removed"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mx.mix(table(spark, sf_dir, "documents"))
    first = F.get("mix.mixes", F.lit(0))
    return found.select("doc_id", "mix.size", "mix.source_size", first["target"].alias("target"), first["taken"].alias("taken"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_main_text": op2_main_text,
        "op3_quality_rules": op3_quality_rules,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_simhash": op5_simhash,
        "op6_license_scan": op6_license_scan,
        "op7_warc_revisits": op7_warc_revisits,
        "op8_personal_data": op8_personal_data,
        "op9_secret_scan": op9_secret_scan,
        "op10_line_dedup": op10_line_dedup,
        "op11_source_mix": op11_source_mix,
        "op12_collocations": op12_collocations,
        "op13_fill_in_middle": op13_fill_in_middle,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
