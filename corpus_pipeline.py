"""The corpus pipeline: quality rules, near-dedup, secret scans, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns they were given, so a stage's result can be written and read
as the next one's documents. Decisions are made and carried out row by row:
rows with a null doc_id and repeated rows have their own, as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.mixing import repeat_taken
from quillspark.llm.neardup import keep_one
from quillspark.llm.pieces import encode_documents
from quillspark.llm.quality import keep_good
from quillspark.llm.secrets import redact_documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, similarity 0.8 or more."""
    return keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return redact_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it: not at all, once or twice."""
    return repeat_taken(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their number and digests."""
    return encode_documents(docs, keep_ids=True).drop("decoded")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", dedup_stage),
    ("secret_scans", secrets_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", encode_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
