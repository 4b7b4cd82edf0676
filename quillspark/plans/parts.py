"""More registered queries: the parts of the plans that the main catalogue only shows as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import clean, detect, labels, mapping, metrics, noise, registry, template, tokens, windows
from ..operators.labeler import IdLabeler
from ..sources import versions
from ..sources.shared import shared_folder
from .catalogue import LABELS, RULES, _templates, bio_decode, table
from .catalogue import _tagged as tagged_rows
from .located import located_passages
from .predict import predict

MODEL_FILES = ["config.json", "labels.json", "x/vocab.txt", "checkpoint-5/config.json", "logs/a", "rng_state.pth", "runs/b/c", "optimizer.pt", "model.safetensors", "tokenizer.json", "README.md"]
CARD = {"strong": ["Mind", " the best"], "weak": ["of", "ing"]}
NAME_LABELS = ["O", "B-name", "I-name"]


def mapping_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Both sets of default mappings, and the one that labels give, with how many entities of all documents each would map."""
    rows = [(s, t, e, f) for s, sets in (("sdk", mapping.DEFAULT_MAPPINGS), ("repo", mapping.REPO_MAPPINGS)) for t, m in sets.items() for e, f in m.items()]
    rows += [("labels", "x", e, f) for e, f in mapping.mapping_of_labels(LABELS).items()]
    known = spark.createDataFrame(rows, "variant string, doc_type string, etype string, field string")
    found = bio_decode(spark, sf).groupBy(F.col("type").alias("etype")).agg(F.count("*").alias("n"))
    return known.join(found, "etype", "left").select("variant", "doc_type", "etype", "field", F.coalesce("n", F.lit(0)).alias("n"))


def json_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """The earliest mapping: a JSON object of type to text, first valid entity of each."""
    return mapping.json_fields(clean.first_valid(bio_decode(spark, sf), "doc_id"), "doc_id")


def run_errors(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    status = metrics.run_status(k % 11 != 0, k % 7 != 0, F.when(k % 4 != 0, (k % 10) / 10.0), k % 5 != 0, k % 3 != 0, failed=k % 13 == 0)
    return o.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def label_maps(spark: SparkSession, sf: str) -> DataFrame:
    """label2id and id2label, as text."""
    listed = labels.label_maps(labels.label_list(tagged_rows(spark, sf, True)))
    text = lambda c, a, b: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda x: F.concat_ws("=", x["key"].cast("string"), x["value"].cast("string"))), ",")
    return listed.select(text("label2id", "key", "value").alias("label2id"), text("id2label", "key", "value").alias("id2label"))


def resplit_train_valid(spark: SparkSession, sf: str) -> DataFrame:
    return labels.front_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.8, 0.1)


def shuffled_order(spark: SparkSession, sf: str) -> DataFrame:
    """The smallest and largest document of each tenth of the shuffled order."""
    docs = labels.ranked(table(spark, sf, "documents").select("doc_id"), "doc_id")
    return docs.groupBy(F.floor((F.col("rank") - 1) / 10).alias("tenth")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    """ids and label ids per document: a token's place modulo 97 and 5."""
    docs = table(spark, sf, "documents").select("doc_id", F.sequence(F.lit(0), tokens.token_count(F.col("text")).cast("int")).alias("p"))
    places = F.slice("p", 1, F.size("p") - 1)
    return docs.select("doc_id", F.transform(places, lambda i: (i % 97 + 3).cast("int")).alias("ids"), F.transform(places, lambda i: (i % 5).cast("int")).alias("label_ids"))


def train_window_arrays(spark: SparkSession, sf: str) -> DataFrame:
    rows = windows.train_windows(_ids(spark, sf))
    sha = lambda c: F.sha2(F.array_join(F.col(c).cast("array<string>"), ","), 256).alias(c)
    return rows.select("doc_id", "win", sha("input_ids"), sha("attention_mask"), sha("labels"))


def truncated_arrays(spark: SparkSession, sf: str) -> DataFrame:
    rows = _ids(spark, sf).withColumn("cut", windows.truncated(F.col("ids"), 128))
    return rows.select("doc_id", F.size("cut").cast("long").alias("n"), F.sha2(F.array_join(F.col("cut").cast("array<string>"), ","), 256).alias("cut"))


def label_range(spark: SparkSession, sf: str) -> DataFrame:
    """How many label ids lie outside a vocabulary of four, and whether the check lets a larger one pass."""
    rows = windows.train_windows(_ids(spark, sf))
    return labels.bad_label_ids(rows, 4).crossJoin(labels.checked_label_ids(rows, 5).agg(F.count("*").alias("n_windows")))


def _encode(token: str) -> list[int]:
    return [ord(token[i]) % 101 for i in range(0, len(token), 3)]


def predict_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The whole model path: sub-words, windows, labels, merge, words, entities."""
    return predict(table(spark, sf, "documents").select("doc_id", "text"), _encode, IdLabeler(NAME_LABELS), "doc_id")


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    found = located_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"), every=True)
    spans = F.transform("spans", lambda s: F.struct(F.when(s["item_id"] % 3 == 0, "alpha").otherwise("beta").alias("label"), s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))
    return found.select("doc_id", "text", spans.alias("entities"))


def bio_samples(spark: SparkSession, sf: str) -> DataFrame:
    rows = tokens.missing_types(tokens.bio_samples(_samples(spark, sf)), ["alpha", "beta"])
    return rows.select("doc_id", F.size("tokens").cast("long").alias("n"), F.sha2(F.array_join("tokens", " "), 256).alias("tokens"), F.sha2(F.array_join("ner_tags", " "), 256).alias("ner_tags"), F.array_join(F.array_sort("missing"), ",").alias("missing"))


def known_annotations(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations of known types, and how many of unknown ones were left out."""
    rows = tokens.known_annotations(_samples(spark, sf), ["B-alpha", "I-alpha"])
    return rows.select("doc_id", F.size("entities").cast("long").alias("n_known"), F.col("n_unknown").cast("long").alias("n_unknown"))


def annotation_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations joined to tagging: how many tokens each known label gets."""
    rows = tokens.bio_samples(tokens.known_annotations(_samples(spark, sf), ["B-alpha", "I-alpha"]))
    return rows.select(F.explode("ner_tags").alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def example_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = metrics.example_sample(tokens.bio_samples(_samples(spark, sf)), "doc_id")
    return rows.select("doc_id", F.array_join("tokens", " ").alias("tokens"), F.array_join("ner_tags", " ").alias("ner_tags"))


def template_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Templates and the fields they show, per type."""
    return template.template_shape(_templates(spark, sf))


def template_choice(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    out = rows.withColumn("drawn", template.drawn_template(F.col("c_custkey"), 3)).withColumn("given", template.given_template(F.col("c_custkey"), 3))
    return out.select("c_custkey", "drawn", "given")


def line_noise(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", noise.line_noise(F.col("p_name"), F.col("p_partkey"), 0.3).alias("text"))


def _schemas(spark: SparkSession, sf: str) -> DataFrame:
    """A schema per region: its nations as fields, and one per segment with its nations' numbers."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    name = lambda c: F.lower(F.replace(c, F.lit(" "), F.lit("_")))
    regions = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(name(F.col("r_name")).alias("doc_type"), F.col("n_nationkey").cast("int").alias("ord"), name(F.col("n_name")).alias("field"))
    segments = table(spark, sf, "customer").select(name(F.col("c_mktsegment")).alias("doc_type"), F.col("c_nationkey").cast("int").alias("ord"), F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("field")).distinct()
    return regions.unionByName(segments)


def schema_rules(spark: SparkSession, sf: str) -> DataFrame:
    return detect.schema_rules(_schemas(spark, sf))


def rules_by_precedence(spark: SparkSession, sf: str) -> DataFrame:
    """What a detector is loaded from when templates, a written version, schemas or nothing is there, and its types."""
    root = shared_folder(spark, "rules")
    versions.commit_version(root, {"rules": detect.rules_frame(spark, RULES)})
    fields = _schemas(spark, sf)
    shown = _templates(spark, sf)
    named = shown.select("doc_type").distinct().select("doc_type", F.lit(0).alias("ord"), F.lit("full_name").alias("field"))
    given = {"templates": {"templates": (shown, named), "stores": [root], "schemas": fields}, "rules": {"stores": [f"{root}-none", root], "schemas": fields}, "schemas": {"stores": [f"{root}-none"], "schemas": fields}, "nothing": {}}
    rows = []
    for name, sources in given.items():
        origin, rules, index = detect.load_detector(spark, **sources)
        rows.append((name, origin, ",".join(sorted(rules)), index is not None))
    return spark.createDataFrame(rows, "given string, origin string, types string, has_index boolean")


def detect_explain(spark: SparkSession, sf: str) -> DataFrame:
    rows = detect.explain(table(spark, sf, "documents"), "doc_id", "text", RULES)
    return rows.select("doc_id", "doc_type", "kind", F.array_join("matched", "|").alias("matched"))


def detect_registered(spark: SparkSession, sf: str) -> DataFrame:
    rules = detect.register(RULES, "card", CARD["strong"], CARD["weak"])
    return detect.detect_by_keywords(table(spark, sf, "documents"), "doc_id", "text", rules).drop("scores")


def registry_register(spark: SparkSession, sf: str) -> DataFrame:
    """Models of nations, those of one region registered anew; what is available."""
    n = table(spark, sf, "nation").withColumn("doc_type", F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))))
    base = n.select("doc_type", (F.col("n_nationkey") % 2 == 0).alias("hub_verified"), F.when(F.col("n_nationkey") % 3 == 0, "local").otherwise("remote").alias("source"))
    again = n.where("n_regionkey = 1").select("doc_type", F.lit(True).alias("hub_verified"), F.lit("registered").alias("source"))
    return registry.available(registry.register(base, again))


def registry_lookup(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").withColumn("doc_type", F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))))
    return registry.model_info(n, "china").select("doc_type", "n_nationkey").unionByName(registry.doc_types(n).limit(1).select("doc_type", F.lit(None).cast("int").alias("n_nationkey")))


def hub_listing(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.concat(F.when(F.col("c_custkey") % 4 == 0, "me").otherwise("you"), F.lit("/"), F.when(F.col("c_custkey") % 3 == 0, "phobert-").otherwise("bert-"), F.lower(F.replace("c_mktsegment", F.lit(" "), F.lit("_"))), F.lit("-"), F.col("c_custkey").cast("string"), F.lit("-ner")).alias("repo_id"))
    return registry.published(c, "me")


def model_file_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Of a listing of every customer's model, one file of each: those that inference needs, and junk."""
    from ..sources import files

    name = F.element_at(F.array(*map(F.lit, MODEL_FILES)), (F.col("c_custkey") % len(MODEL_FILES) + 1).cast("int"))
    listing = table(spark, sf, "customer").select(F.concat(F.lit("m"), F.col("c_custkey").cast("string"), F.lit("/"), name).alias("path"))
    return files.model_files(listing).withColumn("kind", F.lit("kept")).unionByName(files.junk_files(listing).withColumn("kind", F.lit("junk")))


def stale_types(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources import files

    n, r = table(spark, sf, "nation"), table(spark, sf, "customer").select(F.lower("c_mktsegment").alias("doc_type"))
    return files.stale_types(r.distinct().unionByName(n.select(F.lower("n_name").alias("doc_type"))), n.where("n_regionkey < 3").select(F.lower("n_name").alias("doc_type")))


def legacy_f1(spark: SparkSession, sf: str) -> DataFrame:
    """The earlier report: overall scores only; its list per type stays empty."""
    from .catalogue import entity_f1

    return metrics.legacy_report(entity_f1(spark, sf))


def located_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Label and value spans found by search in built texts."""
    c = table(spark, sf, "customer")
    text = F.concat(F.lit("Name "), "c_name", F.lit(" Segment "), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit("none")), F.lit("."))
    spans = template.locate_spans(F.col("text"), {"name": "Name", "segment": "Segment", "other": "Other"}, {"name": F.col("c_name"), "segment": F.col("c_mktsegment"), "other": F.col("c_name")})
    rows = c.withColumn("text", text).select("c_custkey", F.inline(spans))
    return rows.select("c_custkey", "label", "role", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


QUERIES = {
    f.__name__: f
    for f in (
        mapping_defaults, json_mapping, run_errors, label_maps, resplit_train_valid, shuffled_order, train_window_arrays, truncated_arrays, label_range, predict_windows, bio_samples, known_annotations, annotation_samples, example_sample,
        template_shape, template_choice, line_noise, schema_rules, rules_by_precedence, detect_explain, detect_registered, registry_register, registry_lookup, hub_listing, model_file_lists, stale_types, legacy_f1, located_labels,
    )
}
