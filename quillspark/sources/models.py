"""The label maps beside saved models: one folder per document type with config.json and, perhaps, label_map.json."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAPS = "id2label map<string,string>, label2id map<string,bigint>"
FILES = ("config.json", "label_map.json")


def write_label_files(rows: DataFrame, root: str) -> None:
    """Files from rows (doc_type, file, value): folders doc_type=x/file=y, which ``model_label_maps`` reads too."""
    rows.select("doc_type", "file", "value").write.mode("overwrite").partitionBy("doc_type", "file").text(root)


def model_label_maps(spark: SparkSession, root: str) -> DataFrame:
    """doc_type, id2label, label2id of every model below ``root``.

    Each map of label_map.json that is there replaces the model's own whole; label2id is
    otherwise the inverse of the model's own id2label, whatever label_map.json says of ids.
    Of labels with several ids the largest id is the inverse. Ids that are no numbers are
    left out. A file that is not JSON counts as one without maps; other files are not read.
    """
    names = ",".join([*FILES, *(f"file={f}" for f in FILES)])
    # wholetext: a record a file; only the named files are opened, whatever else a model's folder holds
    files = spark.read.option("recursiveFileLookup", True).text(f"{root}/*/{{{names}}}", wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    where = r"/(?:doc_type=)?([^/]+)/(?:file=)?(config|label_map)\.json(?:/[^/]*)?$"
    parsed = files.select(F.regexp_extract("path", where, 1).alias("doc_type"), F.regexp_extract("path", where, 2).alias("kind"), F.from_json("value", MAPS).alias("m"))
    of = lambda kind, field: F.first(F.when(F.col("kind") == kind, F.col(f"m.{field}")), ignorenulls=True)
    rows = parsed.groupBy("doc_type").agg(of("config", "id2label").alias("own"), of("label_map", "id2label").alias("ids"), of("label_map", "label2id").alias("labels"))
    numbered = lambda c: F.array_sort(F.filter(F.transform(F.map_entries(c), lambda x: F.struct(x["key"].try_cast("bigint").alias("id"), x["value"].alias("label"))), lambda x: x["id"].isNotNull() & x["label"].isNotNull()))
    own = numbered(F.col("own"))
    last = F.filter(own, lambda x: ~F.exists(own, lambda y: (y["label"] == x["label"]) & (y["id"] > x["id"])))
    inverse = F.map_from_entries(F.transform(last, lambda x: F.struct(x["label"], x["id"])))
    chosen = numbered(F.coalesce("ids", "own"))
    return rows.select("doc_type", F.map_from_entries(chosen).alias("id2label"), F.coalesce(F.col("labels"), inverse).alias("label2id"))


def label_rows(maps: DataFrame) -> DataFrame:
    """doc_type, id, label of id2label."""
    return maps.select("doc_type", F.explode("id2label").alias("id", "label"))
