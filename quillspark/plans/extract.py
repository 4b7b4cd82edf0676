"""From raw texts to structured rows: the whole plan, one Python boundary for tokens or a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators.decode import decode_rows, decoded_spans
from ..operators.detect import BUILT_IN_RULES, THRESHOLD, detect, keyword_score_array
from ..operators.labeler import RuleLabeler, TokenLabeler
from ..operators.mapping import choose_mapping, map_entity_arrays
from ..operators.tokens import tokens_with_offsets

#: What the built-in labeler finds in any language.
GENERAL_RULES = [(r"^[^@\s]+@[^@\s]+\.[^@\s]+$", "email"), (r"^[0-9]{9,13}$", "id_number"), (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "date_of_birth"), (r"[0-9]", "number")]
GENERAL_MAPPING = {"EMAIL": "email", "ID_NUMBER": "id_number", "DATE_OF_BIRTH": "date_of_birth", "NUMBER": "number"}


def labelled_tokens(docs: DataFrame, key: str, text: str, labeler: TokenLabeler | None) -> DataFrame:
    """key, tokens: every document's labelled tokens as one array."""
    return docs.select(key, tokens_with_offsets(text).alias("__t")).select(key, (labeler or RuleLabeler(GENERAL_RULES)).label_array(F.col("__t"), key).alias("tokens"))


def extract_raw(docs: DataFrame, key: str = "doc_id", text: str = "text", labeler: TokenLabeler | None = None) -> DataFrame:
    """key, ord, type, text, start, end, label, confidence of every entity."""
    return decode_rows(labelled_tokens(docs, key, text, labeler), key)


def extract(docs: DataFrame, doc_type: str | None = None, key: str = "doc_id", text: str = "text", labeler: TokenLabeler | None = None, mapping: dict[str, str] | None = None, labels: list[str] | None = None, with_confidence: bool = False, validate: bool = True, clean: bool = True) -> DataFrame:
    """One row of fields per document; a document never leaves its row."""
    if doc_type is None and mapping is None and labels is None:
        raise ValueError("name a document type, a mapping or the labels of the model")
    own = choose_mapping(doc_type or "", mapping, labels)
    rows = labelled_tokens(docs, key, text, labeler).select(key, decoded_spans(F.col("tokens")).alias("entities"))
    return map_entity_arrays(rows, own, key, clean=clean, validate=validate, with_confidence=with_confidence)


def extract_auto(docs: DataFrame, key: str = "doc_id", text: str = "text", index: DataFrame | None = None, rules=BUILT_IN_RULES, labeler: TokenLabeler | None = None, mapping: dict[str, str] = GENERAL_MAPPING) -> DataFrame:
    """The detected type and the fields of every document. Without an index detection is by keywords."""
    tidy = docs.select(key, clean_text(F.col(text)).alias(text))
    if index is None:  # everything is a projection of the document's row
        both = tidy.select(key, tokens_with_offsets(text).alias("__t"), keyword_score_array(F.col(text), rules).alias("__scores"))
        rows = both.select(key, "__scores", decoded_spans((labeler or RuleLabeler(GENERAL_RULES)).label_array(F.col("__t"), key)).alias("entities"))
        fields = map_entity_arrays(rows, mapping, key, "__scores")
        return decided(fields, "__scores").drop("__scores")
    found = detect(tidy, key, text, index, rules).select(key, "doc_type", "confidence", "method")
    rows = labelled_tokens(tidy, key, text, labeler).select(key, decoded_spans(F.col("tokens")).alias("entities"))
    return map_entity_arrays(rows, mapping, key).join(found, key)


def decided(rows: DataFrame, scores: str) -> DataFrame:
    """doc_type, confidence, method added to rows that carry their keyword scores."""
    total = F.aggregate(scores, F.lit(0.0), lambda t, x: t + x["score"])
    best = F.array_min(F.transform(scores, lambda x: F.struct((-x["score"]).alias("neg"), x["ord"].alias("ord"), x["doc_type"].alias("doc_type"))))
    rows = rows.withColumn("__total", total).withColumn("__best", best)
    rows = rows.withColumn("confidence", F.when(F.col("__total") > 0, F.round(-F.col("__best.neg") / F.col("__total"), 4)).otherwise(0.0))
    sure = (F.col("__total") > 0) & (F.col("confidence") >= THRESHOLD)
    return rows.withColumn("doc_type", F.when(sure, F.col("__best.doc_type"))).withColumn("method", F.when(F.col("__total") > 0, "keyword").otherwise("none")).drop("__total", "__best")
