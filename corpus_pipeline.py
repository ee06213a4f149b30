"""A corpus pipeline of five stages. Each takes (spark, docs, sf_dir) and is written as Parquet and read again for the next.

All stages but the last return the columns of their input, whatever their names. In each, an empty table gives an empty table, repeated rows are judged
alike, and ids may be null or repeated; the text cases are named below."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, quality_rules, sentencepiece, simhash, toxicity
from millrace.llm.common import scratch, table
from millrace.llm.queries import TOKENIZERS


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. Null, empty and letter-less texts score lowest and stay; texts are scored whole, however long."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of fewer than 20 words, of mostly repeated windows or with a probability of being good below one half go; so do null and empty texts."""
    return quality_rules.keep_good(docs)


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the smallest id stays (nulls last; then by text); null and word-less texts are one class."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark passage go; null and empty texts contain none."""
    return decontaminate.keep_unleaked(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (binary, four bytes each), n_ids and whether decoding gives back the text; null and empty texts have no ids."""
    return sentencepiece.encoded_and_checked(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("quality_rules", good_quality),
    ("simhash_near_dedup", near_deduplicated),
    ("benchmark_decontamination", decontaminated),
    ("sentencepiece", encoded),
]

#: No SQL can express the fitted stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; what each keeps is written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
