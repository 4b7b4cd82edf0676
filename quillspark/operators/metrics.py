"""Entity-level scores, field accuracy, gates and summaries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTS = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("tp", "n_pred", "n_gold"))]))


def chunks(tags: DataFrame, *key: str, label: str = "label") -> DataFrame:
    """key, type, start, end of the (type, start, end) chunks of BIO tags by the CoNLL rules."""
    each = Window.partitionBy(*key).orderBy("tok_idx")
    kind = F.when(F.col(label) != "O", F.substr(label, F.lit(3)))
    rows = tags.select(*key, "tok_idx", kind.alias("type"), F.col(label).startswith("B-").alias("b"))
    new = F.col("type").isNotNull() & (F.col("b") | ~F.col("type").eqNullSafe(F.lag("type").over(each)))
    rows = rows.withColumn("n", F.sum(new.cast("int")).over(each)).where("type IS NOT NULL")
    return rows.groupBy(*key, "n").agg(F.first("type").alias("type"), F.min("tok_idx").alias("start"), F.max("tok_idx").alias("end")).drop("n")


def entity_scores(gold: DataFrame, predicted: DataFrame, *key: str) -> DataFrame:
    """type, tp, n_pred, n_gold, precision, recall, f1 per type and over all (type null)."""
    on = [*key, "type", "start", "end"]
    both = chunks(gold, *key).withColumn("g", F.lit(1)).join(chunks(predicted, *key).withColumn("p", F.lit(1)), on, "full_outer")
    counts = both.groupBy("type").agg(F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count("p").alias("n_pred"), F.count("g").alias("n_gold"))
    return scored(counts)


def chunk_lists(labels: pa.Array, numbers: dict[str, int]) -> tuple[np.ndarray, ...]:
    """Document, number of the type, first and last place (counted over all documents) of the chunks of lists of tags."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(labels), 0), np.int64)
    coded = labels.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    kinds = np.array([*(-1 if x == "O" else numbers.setdefault(x[2:], len(numbers)) for x in names), -1])
    begins = np.array([*(x.startswith("B-") for x in names), False])
    code = np.asarray(pc.fill_null(coded.indices, len(names)), np.int64)
    kind, doc = kinds[code], np.repeat(np.arange(len(sizes)), sizes)
    before = np.concatenate(([-1], kind[:-1])) if len(kind) else kind
    other = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool)
    new = (kind >= 0) & (begins[code] | (kind != before) | other)
    first = np.flatnonzero(new)
    edges = np.append(np.flatnonzero(new | (kind < 0) | other), len(kind))
    return doc[first], kind[first], first, edges[np.searchsorted(edges, first, side="right")] - 1


def count_lists(gold: pa.Array, predicted: pa.Array) -> pa.Array:
    """(type, tp, n_pred, n_gold) of every document's two lists of tags of the same length."""
    numbers: dict[str, int] = {}
    (doc, kind, first, last), (doc2, kind2, first2, last2) = (chunk_lists(x, numbers) for x in (gold, predicted))
    width = max(len(numbers), 1)
    _, i, j = np.intersect1d(first, first2, assume_unique=True, return_indices=True)
    hit = i[(kind[i] == kind2[j]) & (last[i] == last2[j])]
    n_gold, n_pred, tp = (np.bincount(d * width + k, minlength=len(gold) * width) for d, k in ((doc, kind), (doc2, kind2), (doc[hit], kind[hit])))
    some = np.flatnonzero(n_gold + n_pred)
    rows = pa.StructArray.from_arrays([pa.array(list(numbers), pa.string()).take(pa.array(some % width)), *(pa.array(x[some].astype(np.int64)) for x in (tp, n_pred, n_gold))], names=["type", "tp", "n_pred", "n_gold"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(some, np.arange(len(gold) + 1) * width).astype(np.int32)), rows)


def scored(counts: DataFrame) -> DataFrame:
    """The scores of rows (type, tp, n_pred, n_gold), one for each type, and over all."""
    every = counts.agg(F.lit(None).cast("string").alias("type"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "n_pred", "n_gold")))
    rows = counts.unionByName(every)
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp = F.col("tp").cast("double")
    return rows.select("type", "tp", "n_pred", "n_gold", F.round(ratio(tp, F.col("n_pred")), 4).alias("precision"), F.round(ratio(tp, F.col("n_gold")), 4).alias("recall"), F.round(ratio(2 * tp, F.col("n_pred") + F.col("n_gold")), 4).alias("f1"))


def field_accuracy(rows: DataFrame, expected: str, actual: str, *key: str) -> DataFrame:
    """key, correct, total, accuracy: values equal but for case, over expected values that are not empty."""
    some = F.coalesce(F.col(expected), F.lit("")) != ""
    right = some & (F.lower(expected) == F.lower(F.coalesce(F.col(actual), F.lit(""))))
    out = rows.groupBy(*key).agg(F.count_if(right).alias("correct"), F.count_if(some).alias("total"))
    return out.withColumn("accuracy", F.round(F.col("correct") / F.greatest("total", F.lit(1)), 4))


def best_metric(logs: DataFrame, *key: str, metric: str = "eval_f1") -> DataFrame:
    """The largest value of a metric per run; null where no epoch has one."""
    return logs.groupBy(*key).agg(F.max(metric).alias("best"))


def run_status(generated: Column, trained: Column, f1: Column, has_token: Column, published: Column, least_f1: float = 0.2, failed: Column | None = None) -> Column:
    """Where a run stopped, or ``published``; ``error`` where it broke off in some other way (``failed``)."""
    return (
        F.when(F.lit(False) if failed is None else failed, "error").when(~generated, "generate_failed").when(~trained, "train_failed").when(F.coalesce(f1, F.lit(0.0)) < least_f1, "low_f1")
        .when(~has_token, "no_hf_token").when(~published, "publish_failed").otherwise("published")
    )


def legacy_report(scores: DataFrame) -> DataFrame:
    """precision, recall, f1 over all types of ``entity_scores``; by_type is empty, as keys by prefix find nothing there."""
    return scores.where("type IS NULL").select("precision", "recall", "f1", F.lit("").alias("by_type"))


def split_counts(rows: DataFrame, split: str = "split") -> DataFrame:
    return rows.groupBy(split).agg(F.count("*").alias("n"))


def label_kinds(labels: DataFrame, label: str = "label") -> DataFrame:
    """Beginning, Inside or Outside, and the field, of every label."""
    kind = F.when(F.col(label).startswith("B-"), "Begin").when(F.col(label).startswith("I-"), "Inside").otherwise("Outside")
    return labels.select(label, kind.alias("kind"), F.when(F.col(label) != "O", F.substr(label, F.lit(3))).alias("field"))


def example_sample(samples: DataFrame, order: str, n: int = 20) -> DataFrame:
    """The first n tokens and tags of the first sample with an entity, else of the first sample."""
    ranked = samples.select(F.struct((~F.exists("ner_tags", lambda t: t != "O")).cast("int").alias("none"), F.col(order).alias("ord")).alias("k"), F.struct(F.col(order), F.slice("tokens", 1, n).alias("tokens"), F.slice("ner_tags", 1, n).alias("ner_tags")).alias("s"))
    return ranked.agg(F.min_by("s", "k").alias("s")).where("s IS NOT NULL").select("s.*")


def run_summary(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count("*").alias("n"), F.round(F.max("f1"), 4).alias("best_f1"))


def card_rows(rows: DataFrame, *by: str) -> DataFrame:
    """level, the columns ``by`` (null where they are summed over), n: every single column's counts, those of the first with
    each other one, and the total, in one pass over the rows. Values that are null themselves stay apart by ``level``."""
    first, *others = by
    sets = [[], *([c] for c in by), *([first, c] for c in others)]
    level = F.concat_ws(",", *(F.when(F.grouping(c) == 0, F.lit(c)) for c in by))
    return rows.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in by)).agg(level.alias("level"), F.count("*").alias("n")).select("level", *by, "n")


def card_text(counts: DataFrame, title: str, *by: str) -> DataFrame:
    """The card's text, one row, from ``card_rows``: a line for the total and a table for every level, rows in order of value.

    Counts are few (one row per combination of values), however large the data set.
    """
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.when(F.array_contains(F.split("level", ","), c), cell(c)) for c in by), F.col("n").cast("string")), F.lit(" |"))
    tables = counts.groupBy("level").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("lines"), F.max("n").alias("n"))
    table = F.when(F.col("level") != "", F.concat(F.lit("## "), "level", F.lit("\n"), "lines"))
    body = F.array_join(F.array_sort(F.collect_list(table)), "\n")
    total = F.coalesce(F.max(F.when(F.col("level") == "", F.col("n"))), F.lit(0)).cast("string")
    return tables.agg(F.concat(F.lit(f"# {title}\n"), total, F.lit(" rows\n"), body).alias("card"))
