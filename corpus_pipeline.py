"""From raw documents to token ids: rules, near duplicates, personal data, mixing, encoding.

Each stage is written as Parquet and read again as the next one's documents, so a lost executor
or a stopped run repeats one stage at most. An empty table passes all stages; further columns, whatever their names, are kept up to the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docpipe import session
from docpipe.llm import minhash, mixing, pii, quality_rules, sentencepiece_codec
from docpipe.llm.common import table, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the current policy go; null and empty texts have too few words. Repeated rows are judged each."""
    session.configure(spark)
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that with the smallest id; rows without an id all stay."""
    session.configure(spark)
    return minhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; no document goes, and null texts stay null."""
    session.configure(spark)
    return pii.redacted(docs, pii.fit(pii.found(docs)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their targets: documents go or come up to three times, in training order. Texts without words go."""
    session.configure(spark)
    return mixing.curriculum(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it; null texts have none."""
    session.configure(spark)
    return sentencepiece_codec.encoded(docs, sentencepiece_codec.load())


STAGES = [
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix),
    ("token ids", encode),
]

# Signatures, the fitted span classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
