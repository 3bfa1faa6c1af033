"""The registered queries of the operators, over whole tables with production settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.llm import (
    centroid_clusters,
    importance,
    jaccard_join,
    language_id,
    minhash,
    mixing,
    pii,
    pivot_search,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    toxicity,
    warc,
)
from docpipe.llm.common import table, written


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encoded(table(spark, sf_dir, "documents"), sentencepiece_codec.load())


def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    candidates = pii.found(docs)
    spans = pii.spans(candidates, pii.fit(candidates))
    counts = [
        F.size(F.filter("base", lambda s: s["k"] == i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)
    ]
    return spans.select(
        F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans")
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = quality_rules.ledger(docs).select(F.col("row.doc_id").alias("doc_id"), "m", "fail_bits")
    entries = written(measured, "rule-ledger")  # every rule ran once; what follows reads bits
    alone = {r.rule: r.n_only_this_rule for r in quality_rules.ablations(entries).collect()}  # a row per rule
    back = F.coalesce(*[F.when(F.col("sole_rule") == rule, F.lit(n)) for rule, n in sorted(alone.items())], F.lit(0)).cast("long")
    judged = quality_rules.verdicts(quality_rules.apply_policy(entries))
    return judged.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        "base_failed", "kept", "fail_bits", *[c for c in judged.columns if c.startswith("kept_")], "sole_rule",
        back.alias("kept_without_rule"),
    )


def op4_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identified(docs, language_id.fit(docs))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classified(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.classified(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # words are counted once, and no text is shuffled
    mix = mixing.mixed(written(mixing.sized(docs, F.struct("doc_id")), "mix-documents"))
    return mix.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", F.get("due", F.lit(0)).alias("first_due")
    ).sort("first_due", "doc_id")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters.clustered(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.drawn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_pii_weak_supervision, op3_quality_rules, op4_pivot_search, op5_language_id,
        op6_warc, op7_toxicity, op8_quality_classifier, op9_mixing, op10_minhash,
        op11_centroid_clusters, op12_jaccard_join, op13_importance_resampling,
    )
}
