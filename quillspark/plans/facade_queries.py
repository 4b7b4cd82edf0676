"""Registered queries of the facade: models' label maps, mappings in order of precedence, expected fields, records by type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.labeler import HashLabeler, label_sets
from ..sources import models
from ..sources.shared import shared_folder
from .catalogue import LABELS, RULES, table
from .facade import Extractor

EXPLICIT = [("de", 0, "NAME", "holder"), ("de", 1, "ADDRESS", "place"), ("de", 2, "NAME", "late")]
SCHEMAS = [("es", 0, "notes"), ("es", 1, "extra"), ("es", 2, "name"), ("es", 3, "notes"), ("cccd", 0, "name")]
SHIFT = 100


def _maps(spark: SparkSession, sf: str) -> DataFrame:
    """A model per language, written as files and read: its labels are those of its documents' tokens.

    The label_map.json of ``en`` has the B- labels as ids, that of ``fr`` moves label2id.
    """
    root = shared_folder(spark, "models")
    docs = table(spark, sf, "documents").where("lang IS NOT NULL")
    labels = docs.select(F.col("lang").alias("doc_type"), label_sets(F.col("text"), "doc_id", HashLabeler(LABELS)).alias("l")).select("doc_type", F.explode("l").alias("label")).distinct()
    own = labels.withColumn("id", F.row_number().over(Window.partitionBy("doc_type").orderBy("label")) - 1)
    listed = F.array_sort(F.collect_list(F.struct("id", "label")))
    rows = own.groupBy("doc_type").agg(listed.alias("own"))
    ids = lambda c: F.map_from_entries(F.transform(c, lambda x: F.struct(x["id"].cast("string").alias("id"), x["label"])))
    moved = F.map_from_entries(F.transform("own", lambda x: F.struct(x["label"], x["id"] + SHIFT)))
    config = F.to_json(F.struct(ids(F.col("own")).alias("id2label")))
    override = F.when(F.col("doc_type") == "en", F.to_json(F.struct(ids(F.filter("own", lambda x: F.startswith(x["label"], F.lit("B-")))).alias("id2label")))).when(F.col("doc_type") == "fr", F.to_json(F.struct(moved.alias("label2id"))))
    files = F.filter(F.array(F.struct(F.lit("config.json").alias("file"), config.alias("value")), F.struct(F.lit("label_map.json").alias("file"), override.alias("value"))), lambda x: x["value"].isNotNull())
    models.write_label_files(rows.select("doc_type", F.inline(files)), root)
    return models.model_label_maps(spark, root)


def model_label_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Both maps of every model, as rows."""
    maps = _maps(spark, sf)
    ids = models.label_rows(maps).select("doc_type", F.lit("id2label").alias("kind"), "id", "label")
    return ids.unionByName(maps.select("doc_type", F.lit("label2id").alias("kind"), F.explode("label2id").alias("label", "id")))


def _extractor(spark: SparkSession, sf: str) -> Extractor:
    explicit = spark.createDataFrame(EXPLICIT, "doc_type string, ord long, etype string, field string")
    schemas = spark.createDataFrame(SCHEMAS, "doc_type string, ord long, field string")
    return Extractor.load(spark, models.label_rows(_maps(spark, sf)), schemas, explicit, HashLabeler(LABELS))


def facade_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Every type's mapping: explicit, else of its model's labels, else built in."""
    return _extractor(spark, sf).mappings.select("doc_type", "etype", "field", "origin")


def facade_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Every type's expected fields: its schema's, else its mapping's."""
    return _extractor(spark, sf).fields.select("doc_type", "field")


def _text(record: Column, value) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(record)), lambda x: F.concat(x["key"], F.lit("="), value(x["value"]))), "|")


def extract_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's record by its language's model, with confidences."""
    rows = _extractor(spark, sf).extract_with_confidence(table(spark, sf, "documents"), "lang")
    shown = _text(F.col("record"), lambda v: F.concat(v["value"], F.lit("@"), F.round(v["confidence"] * 10000).cast("long").cast("string")))
    return rows.select("doc_id", "doc_type", shown.alias("record"))


def extract_detected_type(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's record by the type that detection finds."""
    rows = _extractor(spark, sf).extract_auto(table(spark, sf, "documents"), rules=RULES)
    return rows.select("doc_id", "doc_type", "confidence", "method", _text(F.col("record"), lambda v: v).alias("record"))


QUERIES = {f.__name__: f for f in (model_label_maps, facade_schema, facade_fields, extract_by_type, extract_detected_type)}
