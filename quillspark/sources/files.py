"""Sources and sinks: registries, schemas, templates, BIO sets, annotations, run logs, rules, models' files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import read_json_array

BIO = "tokens array<string>, ner_tags array<string>"
ANNOTATIONS = "text string, entities array<struct<start:int,end:int,label:string>>"
#: What a saved model needs to be used, and what a repository should not hold.
INFERENCE_FILES = ("config.json", "model.safetensors", "pytorch_model.bin", "tokenizer.json", "tokenizer_config.json", "vocab.txt", "bpe.codes", "special_tokens_map.json", "added_tokens.json", "label_map.json", "README.md", ".gitattributes")
JUNK = ("checkpoint-", "optimizer.pt", "scheduler.pt", "trainer_state.json", "training_args.bin", "runs/", "logs/")


def _yaml(path: str):
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def document_registry(spark: SparkSession, path: str) -> DataFrame:
    """doc_type, name, templates, schema, generator rows of a registry file (small, read on the driver)."""
    doc = _yaml(path)
    doc = doc.get("documents", doc)
    rows = [(k, v.get("name"), v.get("templates"), v.get("schema"), v.get("generator")) for k, v in doc.items()]
    return spark.createDataFrame(rows, "doc_type string, name string, templates string, schema string, generator string")


def schema_fields(spark: SparkSession, path: str) -> DataFrame:
    """doc_type, ord, field, ftype of a schema file."""
    doc = _yaml(path)
    rows = [(doc.get("doc_type"), i, e["name"], e.get("type")) for i, e in enumerate(doc.get("entities", []))]
    return spark.createDataFrame(rows, "doc_type string, ord int, field string, ftype string")


def templates(spark: SparkSession, root: str) -> DataFrame:
    """doc_type, template_idx, body of root/<doc_type>/template_*.txt in order of path."""
    from pyspark.sql import Window

    rows = spark.read.text(f"{root}/*/template_*.txt", wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    rows = rows.select(F.regexp_extract("path", r"([^/]+)/template_[^/]*\.txt$", 1).alias("doc_type"), F.col("value").alias("body"), "path")
    if rows.isEmpty():
        raise FileNotFoundError(f"no template_*.txt below {root}")
    return rows.select("doc_type", (F.row_number().over(Window.partitionBy("doc_type").orderBy("path")) - 1).cast("long").alias("template_idx"), "body")


def bio_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """tokens, ner_tags, split of train.json and test.json."""
    read = lambda split: read_json_array(spark, f"{folder}/{split}.json", BIO).select("tokens", "ner_tags", F.lit(split).alias("split"))
    return read("train").unionByName(read("test"))


def label_map(spark: SparkSession, path: str) -> DataFrame:
    """id, label of a labels.json (its id keys are strings)."""
    raw = spark.read.schema("labels array<string>, id2label map<string,string>").option("multiLine", True).json(path)
    return raw.select(F.explode("id2label").alias("id", "label")).select(F.col("id").cast("long").alias("id"), "label")


def annotations(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, ANNOTATIONS).select("text", "entities")


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The largest eval_f1 of each trainer state."""
    raw = spark.read.schema("log_history array<struct<eval_f1:double,epoch:double>>").option("multiLine", True).json(path)
    return raw.select(F.col("_metadata.file_path").alias("run"), F.array_max(F.transform("log_history", lambda x: x["eval_f1"])).alias("best_f1"))


def coerce(config: dict, kinds: dict[str, type]) -> dict:
    """Known keys cast; a value that does not cast stays as it is."""
    out = dict(config)
    for key, kind in kinds.items():
        if key in out:
            try:
                out[key] = kind(out[key])
            except (TypeError, ValueError):
                pass
    return out


def train_config(path: str, default: str, kinds: dict[str, type] | None = None) -> dict:
    """A document type's settings, or the default ones where it has no file."""
    import os

    return coerce(_yaml(path if os.path.exists(path) else default), kinds or {})


def write_records(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_bio(samples: DataFrame, labels: DataFrame, path: str) -> None:
    """samples by split, and the label table beside them."""
    samples.write.mode("overwrite").partitionBy("split").json(f"{path}/samples")
    labels.write.mode("overwrite").json(f"{path}/labels")


def write_detector(rules: DataFrame, index: DataFrame, path: str) -> None:
    rules.write.mode("overwrite").parquet(f"{path}/rules")
    index.write.mode("overwrite").parquet(f"{path}/index")


def read_detector(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/rules"), spark.read.parquet(f"{path}/index")


def model_files(listing: DataFrame, column: str = "path") -> DataFrame:
    """Only the files that inference needs."""
    return listing.where(F.substring_index(column, "/", -1).isin(*INFERENCE_FILES))


def junk_files(listing: DataFrame, column: str = "path") -> DataFrame:
    return listing.where(F.exists(F.array(*map(F.lit, JUNK)), lambda p: F.contains(column, p)))


def stale_types(here: DataFrame, there: DataFrame) -> DataFrame:
    """Document types of a mirror that its source has no more."""
    return here.select("doc_type").join(there.select("doc_type"), "doc_type", "left_anti")


def card(template: str, **values: object) -> str:
    """A card's text: known $names filled in, others left."""
    from string import Template

    return Template(template).safe_substitute({k: str(v) for k, v in values.items()})
