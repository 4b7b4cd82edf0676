"""Documents of many types at once: every type's mapping and fields are rows of a table, and each document is mapped by its own type's."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text, let
from ..operators.clean import finished, first_of_any, is_valid
from ..operators.decode import decode_rows
from ..operators.detect import BUILT_IN_RULES, detect, keyword_score_array
from ..operators.labeler import RuleLabeler, TokenLabeler, entity_spans, first_spans
from ..operators.mapping import DEFAULT_MAPPINGS
from .extract import GENERAL_RULES, decided, labelled_tokens

#: Types are broadcast up to this many mapped types and fields together; beyond, they are joined by shuffle.
MOST_ENTRIES = 200_000


def label_mappings(maps: DataFrame) -> DataFrame:
    """doc_type, ord, etype, field from models' labels (doc_type, id, label).

    B- and I- labels count; the value suffix is not part of an entity's type; of several
    fields of a type the one with the smallest id stays (then the first in code-point order).
    """
    field = F.substr("label", F.lit(3))
    rows = maps.where(F.col("label").rlike("^[BI]-.")).select("doc_type", F.upper(F.replace(field, F.lit("_VALUE"), F.lit(""))).alias("etype"), F.struct(F.col("id").cast("long").alias("ord"), field.alias("field")).alias("f"))
    return rows.groupBy("doc_type", "etype").agg(F.min("f").alias("f")).select("doc_type", "f.ord", "etype", "f.field")


def default_mappings(spark: SparkSession) -> DataFrame:
    """doc_type, ord, etype, field of the mappings built in."""
    rows = [(t, i, e, f) for t, m in DEFAULT_MAPPINGS.items() for i, (e, f) in enumerate(m.items())]
    return spark.createDataFrame(rows, "doc_type string, ord long, etype string, field string")


def choose_mappings(**layers: DataFrame) -> DataFrame:
    """doc_type, ord, etype, field, origin: every type has the whole mapping of the first layer, in the order given, that knows it.

    Layers are rows (doc_type, ord, etype, field); rows without a type, an entity type or a field do not
    count. Of an entity type's several fields in a layer the one of smallest ord stays.
    """
    named = [d.select("doc_type", F.col("ord").cast("long").alias("ord"), "etype", "field", F.lit(i).alias("layer"), F.lit(name).alias("origin")) for i, (name, d) in enumerate(layers.items())]
    rows = reduce(DataFrame.unionByName, named).where("doc_type IS NOT NULL AND etype IS NOT NULL AND field IS NOT NULL")
    rows = rows.groupBy("doc_type", "etype", "layer", "origin").agg(F.min(F.struct("ord", "field")).alias("f"))
    first = F.min("layer").over(Window.partitionBy("doc_type"))
    return rows.withColumn("__first", first).where("layer = __first").select("doc_type", "f.ord", "etype", "f.field", "origin")


def expected_fields(mappings: DataFrame, schemas: DataFrame) -> DataFrame:
    """doc_type, ord, field: the names of a type's schema (doc_type, ord, field) if it has one, else the fields of its mapping."""
    each = lambda d: d.where("doc_type IS NOT NULL AND field IS NOT NULL").groupBy("doc_type", "field").agg(F.min(F.col("ord").cast("long")).alias("ord"))
    named = each(schemas)
    mapped = each(mappings).join(named.select("doc_type").distinct(), "doc_type", "left_anti")
    return named.unionByName(mapped).select("doc_type", "ord", "field")


def type_table(mappings: DataFrame, fields: DataFrame) -> DataFrame:
    """One row per type: doc_type, mapping (entity type to field), fields (in order)."""
    maps = mappings.groupBy("doc_type").agg(F.map_from_entries(F.collect_list(F.struct("etype", "field"))).alias("mapping"))
    listed = fields.groupBy("doc_type").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "field"))), lambda x: x["field"]).alias("fields"))
    return maps.join(listed, "doc_type", "full")


def typed_records(rows: DataFrame, types: DataFrame, *key: str, doc_type: str = "doc_type", entities: str = "entities", clean: bool = True, validate: bool = True, with_confidence: bool = False, firsts: bool = False) -> DataFrame:
    """key, doc_type, record: a map of every expected field of the document's type to its last entity's text, "" where it has none.

    Entities of types that the mapping does not know, and fields that are not expected, do
    not count. A type that ``types`` does not hold has an empty record, a document without a type a null one.
    With confidence a value is a struct (value, confidence), 0.0 where there is no entity.
    With ``firsts`` entities are those of ``first_spans``, which cleaning only finishes.
    Documents stay on their row; only a table of types above ``MOST_ENTRIES`` makes them move.
    """
    size = types.agg(F.sum(F.coalesce(F.size("mapping"), F.lit(0)) + F.coalesce(F.size("fields"), F.lit(0)))).first()[0] or 0
    known = types.select(F.col("doc_type").alias("__type"), F.col("mapping").alias("__mapping"), F.col("fields").alias("__fields"))
    docs = rows.select(*key, F.col(doc_type).alias("doc_type"), F.col(entities).alias("__e"))
    joined = docs.join(F.broadcast(known) if size <= MOST_ENTRIES else known, F.col("doc_type") == F.col("__type"), "left")
    field_of = lambda x: F.try_element_at(F.col("__mapping"), x["type"])
    own = F.filter("__e", lambda x: F.array_contains("__fields", field_of(x)))
    if firsts:
        own = F.transform(own, finished)
    elif clean:
        own = let(own, lambda e: F.transform(F.array_distinct(F.transform(e, lambda x: x["type"])), lambda t: first_of_any(t, F.filter(e, lambda x: x["type"] == t))))
    if validate:
        own = F.filter(own, lambda x: is_valid(x["type"], x["text"]))
    placed = F.transform(own, lambda x: F.struct(x["ord"].alias("ord"), field_of(x).alias("field"), x["text"].alias("text"), x["confidence"].alias("confidence")))

    def value(found: Column, f: Column) -> Column:
        last = F.array_max(F.filter(found, lambda x: x["field"] == f))
        text = F.coalesce(last["text"], F.lit(""))
        return F.struct(text.alias("value"), F.coalesce(last["confidence"], F.lit(0.0)).alias("confidence")) if with_confidence else text

    values = let(placed, lambda found: F.transform("__fields", lambda f: value(found, f)))
    kind = "struct<value:string,confidence:double>" if with_confidence else "string"
    empty = F.create_map().cast(f"map<string,{kind}>")
    record = F.when(F.col("__fields").isNotNull(), F.map_from_arrays("__fields", F.coalesce(values, F.transform("__fields", lambda f: value(F.array().cast("array<struct<ord:long,field:string,text:string,confidence:double>>"), f)))))
    return joined.select(*key, "doc_type", F.when(F.col("doc_type").isNotNull(), F.coalesce(record, empty)).alias("record"))


@dataclass(frozen=True)
class Extractor:
    """What is known of all types, and, after ``for_doc``, the type that is meant where none is named."""

    mappings: DataFrame
    fields: DataFrame
    labeler: TokenLabeler | None = None
    doc_type: str | None = None

    @classmethod
    def load(cls, spark: SparkSession, labels: DataFrame | None = None, schemas: DataFrame | None = None, explicit: DataFrame | None = None, labeler: TokenLabeler | None = None) -> Extractor:
        """From explicit mappings, models' labels (doc_type, id, label) and schemas; each may be missing."""
        none = spark.createDataFrame([], "doc_type string, ord long, etype string, field string")
        mappings = choose_mappings(explicit=none if explicit is None else explicit, labels=none if labels is None else label_mappings(labels), default=default_mappings(spark))
        return cls(mappings, expected_fields(mappings, none if schemas is None else schemas), labeler)

    def for_doc(self, doc_type: str) -> Extractor:
        return replace(self, doc_type=doc_type)

    def _named(self, doc_type: str | None) -> str:
        named = doc_type or self.doc_type
        if not named:
            raise ValueError("name a document type, or take an extractor for one")
        return named

    def get_schema(self, doc_type: str | None = None) -> DataFrame:
        """etype, field of one type."""
        return self.mappings.where(F.col("doc_type") == self._named(doc_type)).select("etype", "field")

    def get_fields(self, doc_type: str | None = None) -> DataFrame:
        """field: those of one type, in order of name."""
        return self.fields.where(F.col("doc_type") == self._named(doc_type)).select("field").orderBy("field")

    def extract_raw(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        return decode_rows(labelled_tokens(docs, key, text, self.labeler), key)

    def extract(self, docs: DataFrame, types: str | None = None, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), with_confidence: bool = False, validate: bool = True, clean: bool = True) -> DataFrame:
        """key, ``keep``, doc_type, record of every document, by the type in its column ``types`` or else the one meant."""
        named = (F.col(types) if types else F.lit(self._named(None))).cast("string")
        found = (first_spans if clean else entity_spans)(F.col(text), key, self.labeler or RuleLabeler(GENERAL_RULES))
        rows = docs.select(key, *keep, named.alias("doc_type"), found.alias("entities"))
        return typed_records(rows, type_table(self.mappings, self.fields), key, *keep, clean=clean, firsts=clean, validate=validate, with_confidence=with_confidence)

    def extract_with_confidence(self, docs: DataFrame, types: str | None = None, **options: object) -> DataFrame:
        return self.extract(docs, types, with_confidence=True, **options)

    def extract_auto(self, docs: DataFrame, key: str = "doc_id", text: str = "text", index: DataFrame | None = None, rules=BUILT_IN_RULES) -> DataFrame:
        """key, doc_type, record, confidence, method: mapped by the type that detection finds.

        Without an index all is a projection of the document's row; with one, keys must be distinct.
        """
        tidy = docs.select(key, clean_text(F.col(text)).alias(text))
        if index is None:
            found = decided(tidy.withColumn("__scores", keyword_score_array(F.col(text), rules)), "__scores").drop("__scores")
        else:
            found = tidy.join(detect(tidy, key, text, index, rules).select(key, "doc_type", "confidence", "method"), key)
        return self.extract(found, "doc_type", key, text, ("confidence", "method"))
