"""The queries of this subpackage: ``QUERIES`` and, where SQL can express them, ``ORACLES``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, periods, pii, secrets, topk, warc
from .combos import similar_documents
from .mixing import mix_documents
from .neardup import near_duplicates
from .pieces import encode_documents
from .quality import judge_quality
from .repeats import remove_repeats
from .whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive_records(warc.response_records(table(spark, sf_dir, "pages")))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.history_report(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op9_pii_semi_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), shingle=5, percent=80)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_report(periods.with_periodic_tail(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (op1_warc_derivatives, op2_source_mixing, op3_secret_scans, op4_substring_dedup, op5_exact_topk, op6_quality_rules, op7_chat_formatting, op8_sentencepiece, op9_pii_semi_crf, op10_minhash_near_dedup, op11_embedding_whitening, op12_ngram_jaccard_join, op13_periodic_runs)
}
ORACLES = {"op1_warc_derivatives": warc.derivative_sql(), "op3_secret_scans": secrets.report_sql(), "op5_exact_topk": topk.TOP_SQL, "op7_chat_formatting": chat.CHAT_SQL}
