"""The training-data operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, licenses, lm, merkle, nbsvm, periodic, pii, quality_rules, sentencepiece, simhash, token_files, toxicity, url_filter
from millrace.llm.common import scratch, table

#: Folder of the public tokenizers' files on every machine; a parameter of the operators.
TOKENIZERS = "/opt/tokenizers"
END_ID = 2


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), cautious=True)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op8_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 and whether decoding gives back the text."""
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    return sentencepiece.encoded_and_checked(table(spark, sf_dir, "documents"), model).select("doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), "round_trip")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch(spark, "tokens")
    token_files.write_ids(docs, folder, token_files.tokenizer_encode(public_tokenizers.path("byte_bpe_50k.json"), special=True), END_ID)
    back = token_files.read_ids(spark, folder, docs.schema["doc_id"].dataType)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.find(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    first = (op1_url_filter, op2_quality_rules, op3_license_scan, op4_lm_score, op5_decontaminate, op6_toxicity, op7_simhash, op8_nbsvm, op9_sentencepiece, op10_token_files)
    return {f.__name__: f for f in (*first, op11_pii, op12_merkle_manifest, op13_periodic_runs)}


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": licenses.oracle_sql()}
