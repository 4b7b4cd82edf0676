"""The data factory: records, templates, noise, tags, splits, files; and its command line."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.generate import generate_records
from ..operators.labels import exact_split, label_list
from ..operators.noise import add_noise, add_noise_tokens
from ..operators.template import render_any
from ..operators.tokens import bio_samples


def build_dataset(spark: SparkSession, doc_type: str, bodies: list[str], fields: list[str], n: int, noise: float = 0.1, test_share: float = 0.1, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(samples with row_id, text, tokens, ner_tags, split; labels with id, label)."""
    records = render_any(generate_records(spark, doc_type, n, seed), bodies, fields, F.col("row_id")).select("row_id", "template_idx", "text", "entities")
    noisy = add_noise_tokens(add_noise(records, "row_id", noise, seed), "row_id", noise, seed)
    split = exact_split(bio_samples(noisy), "row_id", [("train", 1 - test_share), ("test", test_share)], seed)
    return split, label_list(split.select(F.explode_outer("ner_tags").alias("label")))


def main(argv: list[str] | None = None) -> None:
    from ..session import build_session
    from ..sources import files

    p = argparse.ArgumentParser(description="Write a labelled synthetic data set.")
    p.add_argument("--doc", required=True)
    p.add_argument("--templates", required=True, help="folder with one folder of template_*.txt and schema.yaml per type")
    p.add_argument("--output", required=True)
    p.add_argument("--size", type=int, default=50_000)
    p.add_argument("--noise_level", type=float, default=0.1)
    p.add_argument("--test_split", type=float, default=0.1)
    p.add_argument("--seed", type=int, default=42)
    a = p.parse_args(argv)
    spark = build_session("quillspark-dataset")
    bodies = [r.body for r in files.templates(spark, a.templates).where(F.col("doc_type") == a.doc).orderBy("template_idx").collect()]
    fields = [r.field for r in files.schema_fields(spark, f"{a.templates}/{a.doc}/schema.yaml").orderBy("ord").collect()]
    samples, labels = build_dataset(spark, a.doc, bodies, fields, a.size, a.noise_level, a.test_split, a.seed)
    files.write_bio(samples.select("tokens", "ner_tags", "split"), labels, a.output)


if __name__ == "__main__":
    main()
