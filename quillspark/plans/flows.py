"""Registered queries that write and read again: array files, versions, partitions, streams, runs; and a trained tagger."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import display_name
from ..operators import detect, labels, metrics, registry, template, tokens
from ..operators.labeler import BatchLabeler, TaggerWeights
from ..operators.windows import CONTENT
from ..sources import arrays, files, versions
from ..sources.shared import shared_folder
from ..streaming.clean import run_available, sessions
from .catalogue import _lang_corpora, table
from .parts import _samples
from .predict import label_counts, served_counts
from .runs import run_types

TAGS = ("O", "B-name", "I-name")
BUCKETS = 101
TTL = 6 * 3600
SEPARATORS = [": ", " ", "\n", "/ ", ":\n"]
SPELLINGS = {"name": ["Name", "Full name", "Holder"], "segment": ["Segment", "Market"], "nation": ["Nation", "Country no."], "key": ["No.", "Key"]}
MERGED = [("segment", "nation", 0.45), ("name", "key", 0.4)]
PARTS = 3


def json_array_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as JSON arrays and read by byte ranges."""
    path = shared_folder(spark, "arrays")
    arrays.write_json_array(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), path)
    rows = arrays.read_json_array(spark, path, "doc_id long, text string, lang string, source string")
    return rows.select("doc_id", F.sha2("text", 256).alias("text"), "lang", "source")


def annotation_files(spark: SparkSession, sf: str) -> DataFrame:
    """Annotated texts written as JSON arrays, read, cut to known types and tagged: how many tokens each label gets."""
    path = shared_folder(spark, "annotations")
    arrays.write_json_array(_samples(spark, sf).select("text", "entities"), path)
    rows = tokens.bio_samples(tokens.known_annotations(files.annotations(spark, path), ["B-alpha", "I-alpha"]))
    return rows.select(F.explode("ner_tags").alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def _encode_all(tokens: pa.Array) -> pa.Array:
    """``_encode`` of every token at once: a list of ids each."""
    _, offsets, data = tokens.buffers()
    ends = np.frombuffer(offsets, np.int32, len(tokens) + 1, tokens.offset * 4) if len(tokens) else np.zeros(1, np.int32)
    points = np.frombuffer(data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes().decode().encode("utf-32-le") if ends[-1] > ends[0] else b"", np.uint32)
    lengths = np.asarray(pc.utf8_length(tokens), np.int64)
    sizes = -(-lengths // 3)
    at = np.concatenate(([0], np.cumsum(sizes)))
    place = np.repeat(np.cumsum(lengths) - lengths - 3 * at[:-1], sizes) + 3 * np.arange(at[-1])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array((points[place] % 101).astype(np.int32)))


def _first_letters(tokens: pa.Array) -> pa.Array:
    """The label of every token, by its first letter."""
    return pc.if_else(pc.match_substring_regex(tokens, "^[A-Z]"), "B-name", pc.if_else(pc.starts_with(tokens, "t"), "I-name", "O"))


def model_serving(spark: SparkSession, sf: str) -> DataFrame:
    """A tagger counted from labelled sub-words of all documents, then served over their windows and merged."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = TaggerWeights.fit(label_counts(docs, _encode_all, _first_letters), TAGS, BUCKETS)
    rows = served_counts(docs, _encode_all, BatchLabeler(model, CONTENT))
    counts = [F.col("counts")[i].alias(c) for i, c in enumerate(("n_o", "n_b", "n_i"))]
    return rows.select("doc_id", "n", *counts, *(F.round(c, 4).alias(c) for c in ("least_conf", "most_conf")))


def legacy_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled lines in drawn order with drawn separators, some merged, and the spans of labels and values."""
    value = {"name": "c_name", "segment": "c_mktsegment", "nation": "c_nationkey", "key": "c_custkey"}
    fields = {f: (F.col(value[f]), SPELLINGS[f]) for f in SPELLINGS}
    rows = template.build_lines(table(spark, sf, "customer"), "c_custkey", fields, SEPARATORS, MERGED)
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["role"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.select("c_custkey", "text", listed.alias("spans"))


def index_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Rules and an index of half the documents, then of all, kept as versions; the newest is loaded and checked."""
    root = shared_folder(spark, "detector")
    rules = detect.rules_frame(spark, detect.BUILT_IN_RULES)
    corpora = _lang_corpora(spark, sf)
    index_of = lambda rows: detect.tfidf_index(rows).select("doc_type", "term", F.round("weight", 4).alias("weight"), F.round("idf", 4).alias("idf"))
    whole = index_of(corpora).persist()  # the most frequent terms only: small, and written twice from one reading of the texts
    for index in (index_of(corpora.where(F.pmod(F.xxhash64("corpus"), F.lit(2)) == 0)), whole, whole):  # the last write changes nothing
        versions.commit_version(root, {"rules": rules, "index": index})
    whole.unpersist()
    origin, _, index = detect.load_detector(spark, stores=[f"{root}-missing", root])
    number = versions.newest(spark, root)
    return index.select("doc_type", "term", "weight", "idf", F.lit(number).cast("long").alias("version"), F.lit(origin).alias("origin"))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", F.col("user_id").cast("string").alias("doc_type"), "event_type")


def registry_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """For every event but views: its user's latest view, if it is fresh."""
    e = _events(spark, sf)
    entries = e.where("event_type = 'view'").select("doc_type", F.col("ts").alias("since"), F.col("event_id").alias("version"))
    asked = e.where("event_type <> 'view'").select("event_id", "doc_type", "ts")
    return registry.as_of(asked, entries, "doc_type", "ts", "since", TTL).select("event_id", F.col("entry.version").alias("entry"))


def registry_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The newest event of every type, exports that overlap included, as a registry's JSON."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("doc_type"), F.col("ts").alias("since"), F.col("event_id").alias("version"))
    newest = registry.refresh(e.unionByName(e.where("version % 3 = 0")))
    return registry.export(newest.select("doc_type", display_name(F.col("doc_type")).alias("name"), "version"), "me")


def _outcomes(spark: SparkSession, sf: str):
    """What a step gives for a nation: decided by its number and its customers."""
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.round(F.avg((F.col("c_acctbal") > 6500).cast("double")), 4).alias("share"))
    facts = table(spark, sf, "nation").select(F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))).alias("doc_type"), F.col("n_nationkey").alias("k")).join(c, F.col("k") == F.col("c_nationkey"), "left")

    def execute(due: DataFrame) -> DataFrame:
        k, step, attempt = F.col("k"), F.col("step"), F.col("attempt")
        ok = F.when(step == "generate", F.coalesce(F.col("n"), F.lit(0)) > 0).when(step == "train", (k % 5 != 0) | (attempt > 2)).when(step == "publish", (k % 7 != 0) | (attempt > 1)).otherwise(True)
        rows = due.join(facts, "doc_type")
        return rows.select("doc_type", ok.alias("ok"), F.when(step == "evaluate", F.coalesce("share", F.lit(0.0))).alias("value"), F.when(~ok, F.concat(step, F.lit(" failed"))).alias("error"))

    return facts, execute


def training_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A run over nations that is broken off after two rounds and started again over its ledger."""
    path = shared_folder(spark, "runs")
    facts, execute = _outcomes(spark, sf)
    run_types(facts, path, execute, rounds=2)
    return run_types(facts, path, execute)


def split_files(spark: SparkSession, sf: str) -> DataFrame:
    """A labelled split written by partition twice, one part of it once more; what is read back."""
    path = shared_folder(spark, "splits")
    docs = table(spark, sf, "documents").select("doc_id", "lang", tokens.token_count(F.col("text")).alias("n_tokens"))
    split = labels.exact_split(docs, "doc_id", [("train", 0.8), ("valid", 0.1), ("test", 0.1)])
    for rows in (split, split, split.where("split = 'test'")):
        versions.write_partitions(rows, path, "split")
    return spark.read.parquet(path).groupBy("split", "lang").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("n_tokens"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))


def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Events that arrive in three deliveries, each with the last hour of the one before again: closed sessions of every user."""
    root = shared_folder(spark, "stream")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(second), F.max(second)).first()
    if low is None:
        return spark.createDataFrame([], "user_id long, start timestamp_ntz, end timestamp_ntz, n long")
    size = (high - low) // PARTS + 1
    for i in range(PARTS):
        at = second - low
        events.where((at >= i * size - 3600) & (at < (i + 1) * size)).write.mode("append").parquet(f"{root}/arrived")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/arrived")
        run_available(sessions(stream), f"{root}/closed", f"{root}/progress")
    closed = spark.read.schema("user_id long, start timestamp, end timestamp, n long").parquet(f"{root}/closed")
    return closed.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


def _card(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    split = labels.exact_split(docs, "doc_id", [("train", 0.8), ("valid", 0.1), ("test", 0.1)])
    return metrics.card_rows(split, "split", "lang", "source")


def dataset_card_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _card(spark, sf)


def dataset_card_text(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.card_text(_card(spark, sf), "documents", "split", "lang", "source")


QUERIES = {
    f.__name__: f
    for f in (json_array_scan, annotation_files, model_serving, legacy_lines, index_versions, registry_as_of, registry_refresh, training_runs, split_files, stream_sessions, dataset_card_rows, dataset_card_text)
}
