"""Overlapping windows over sub-words, and the merge of what they predict."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("conf", T.DoubleType())]))
WINDOWS = T.ArrayType(T.StructType([T.StructField("win", T.LongType()), T.StructField("start", T.LongType()), T.StructField("labels", T.ArrayType(T.StringType())), T.StructField("confs", T.ArrayType(T.DoubleType()))]))
CONTENT, INFER_STEP, TRAIN_STEP = 254, 128, 126
#: Up to so many labels are added up in a table of places by labels; beyond, places are sorted.
FEW_LABELS = 16


def window_count(n: Column, content: int, step: int) -> Column:
    more = F.greatest(F.ceil((n - content) / step), F.lit(0))
    return F.when(n > 0, 1 + more).otherwise(0).cast("long")


def window_spans(rows: DataFrame, n: str, content: int = CONTENT, step: int = INFER_STEP) -> DataFrame:
    """win, start, end per window of a row of n sub-words; rows without sub-words go."""
    count = window_count(F.col(n), content, step)
    out = rows.where(F.col(n) > 0).withColumn("win", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    return out.withColumn("start", F.col("win") * step).withColumn("end", F.least(F.col("win") * step + content, F.col(n)).cast("long"))


def window_arrays(ids: Column, content: int = CONTENT, step: int = INFER_STEP) -> Column:
    """The windows (win, start, ids) of a document's sub-words as an array on its row."""
    numbers = F.sequence(F.lit(0).cast("long"), window_count(F.size(ids), content, step) - 1)
    made = F.transform(numbers, lambda w: F.struct(w.alias("win"), (w * step).alias("start"), F.slice(ids, (w * step + 1).cast("int"), F.lit(content)).alias("ids")))
    return F.when(F.size(ids) > 0, made).otherwise(F.array().cast("array<struct<win:bigint,start:bigint,ids:array<int>>>"))


def window_bounds(counts: np.ndarray, content: int = CONTENT, step: int = INFER_STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``window_spans`` of whole documents: row, win, start and length of every window, in order, of rows of so many sub-words."""
    each = np.where(counts > 0, 1 + np.maximum(-((content - counts) // step), 0), 0)
    row = np.repeat(np.arange(len(counts)), each)
    win = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    return row, win, win * step, np.minimum(content, counts[row] - win * step)


def merge_lists(windows: pa.Array, n: pa.Array, names: list[str] | None = None) -> pa.Array:
    """``merge_overlaps`` and ``fill_gaps`` of whole documents: from every document's list of windows (win, start, labels, confs)
    the (label, conf) of its n places. With ``names`` labels are numbers of them. Nothing leaves the document's row."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(windows), 0), np.int64)
    counts = np.asarray(pc.fill_null(n, 0), np.int64)
    base = np.concatenate(([0], np.cumsum(counts)))
    flat = windows.flatten()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(flat.field("labels")), 0), np.int64)
    labels, conf = flat.field("labels").flatten(), np.asarray(flat.field("confs").flatten(), np.float64)
    if names is None:
        coded = labels.dictionary_encode()
        labels, names = coded.indices, coded.dictionary.to_pylist()
    names = [*names, "O"]
    code = np.asarray(pc.fill_null(labels, len(names) - 1), np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    label, score = merge_codes(counts, doc, *(np.asarray(flat.field(c), np.int64) for c in ("win", "start")), lengths, code, conf, len(names))
    rows = pa.StructArray.from_arrays([pa.array(names, pa.string()).take(pa.array(label)), pa.array(score)], names=["label", "conf"])
    return pa.ListArray.from_arrays(pa.array(base.astype(np.int32)), rows)


def merge_codes(counts: np.ndarray, doc: np.ndarray, win: np.ndarray, start: np.ndarray, lengths: np.ndarray, code: np.ndarray, conf: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Label and confidence of every place of documents of so many places; a place without any has the last of ``kinds`` labels and 0.0.

    Windows are given by document, number, first place and length; labels and confidences of their places follow one another.
    """
    base = np.concatenate(([0], np.cumsum(counts)))
    ordered = len(doc) < 2 or bool(((doc[1:] > doc[:-1]) | ((doc[1:] == doc[:-1]) & (win[1:] >= win[:-1]))).all())
    place = np.repeat(start - np.cumsum(lengths) + lengths, lengths) + np.arange(len(code))
    some = (place >= 0) & (place < np.repeat(counts[doc], lengths))
    place += np.repeat(base[doc], lengths)
    win = np.repeat(win, lengths)
    if not some.all():
        place, code, win, conf = place[some], code[some], win[some], conf[some]
    label = np.full(int(base[-1]), kinds - 1)
    if ordered and kinds <= FEW_LABELS:
        size = len(label)
        cell = code * size + place
        n = np.bincount(cell, minlength=size * kinds)
        mean = np.bincount(cell, conf, len(n)) / np.maximum(n, 1)
        mean[n == 0] = -np.inf
        early = np.zeros(len(n), np.int64)
        early[cell[::-1]] = win[::-1]  # of several windows the first stays
        top, first = np.full(size, -np.inf), np.zeros(size, np.int64)
        for k in range(kinds):
            own, since = mean[k * size : (k + 1) * size], early[k * size : (k + 1) * size]
            better = np.flatnonzero((own > top) | ((own == top) & (since < first)))
            label[better], top[better], first[better] = k, own[better], since[better]
        return label, np.where(top > -np.inf, top, 0.0)
    order = np.lexsort((win, code, place))
    place, code, win, conf = place[order], code[order], win[order], conf[order]
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (code[1:] != code[:-1]))) if len(place) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    mean = np.bincount(group, conf, len(first)) / np.maximum(np.bincount(group, minlength=len(first)), 1)
    place, code, win = place[first], code[first], win[first]
    order = np.lexsort((win, -mean, place))
    best = order[np.concatenate(([True], np.diff(place[order]) != 0))] if len(order) else order
    score = np.zeros(len(label))
    label[place[best]], score[place[best]] = code[best], mean[best]
    return label, score


def word_lists(places: pa.Array, sizes: pa.Array) -> pa.Array:
    """``words_from_subwords`` of whole documents: (label, conf) of every word of ``sizes`` sub-words; (O, 0.0) of a word without any."""
    upto, counts = (np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(x), 0), np.int64)))) for x in (sizes, places))
    size = np.asarray(sizes.flatten(), np.int64)
    ends = np.concatenate(([0], np.cumsum(size)))
    if (ends[upto] != counts).any():
        raise ValueError("the sub-words of a document's words are not as many as its places")
    flat = places.flatten()
    word = np.repeat(np.arange(len(size)), size)
    conf = np.bincount(word, np.asarray(flat.field("conf")), len(size)) / np.maximum(size, 1)
    label = pc.fill_null(flat.field("label").take(pa.array(ends[:-1], mask=size == 0)), "O")
    return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.StructArray.from_arrays([label, pa.array(conf)], names=["label", "conf"]))


def train_windows(rows: DataFrame, length: int = 256, overlap: int = 128, cls: int = 0, sep: int = 2, pad: int = 1) -> DataFrame:
    """input_ids, attention_mask, labels of fixed length from (ids, label_ids) arrays."""
    content = length - 2
    out = window_spans(rows.withColumn("__n", F.size("ids")), "__n", content, max(1, content - overlap))
    size = (F.col("end") - F.col("start")).cast("int")
    at = (F.col("start") + 1).cast("int")
    fill = F.lit(content) - size
    framed = lambda c, a, b, p: F.concat(F.array(F.lit(a)), F.slice(c, at, size), F.array(F.lit(b)), F.array_repeat(F.lit(p), fill))
    mask = F.concat(F.array_repeat(F.lit(1), size + 2), F.array_repeat(F.lit(0), fill)).cast("array<tinyint>")
    return out.withColumn("input_ids", framed("ids", cls, sep, pad)).withColumn("attention_mask", mask).withColumn("labels", framed("label_ids", -100, -100, -100)).drop("__n", "ids", "label_ids", "start", "end")


def truncated(ids: Column, length: int) -> Column:
    return F.slice(ids, 1, length)


def merge_overlaps(predictions: DataFrame, *key: str) -> DataFrame:
    """key, pos, label, conf from (key, pos, win, label, conf): the label of the highest mean confidence,
    of equal ones the one of the earliest window."""
    seen = predictions.groupBy(*key, "pos").agg(F.collect_list(F.struct("win", "label", "conf")).alias("s"))  # the few windows over a place

    def judged(label: Column) -> Column:
        own = F.filter("s", lambda x: x["label"].eqNullSafe(label))
        mean = F.aggregate(own, F.lit(0.0), lambda t, x: t + x["conf"]) / F.size(own)
        return F.struct(mean.alias("conf"), (-F.array_min(F.transform(own, lambda x: x["win"]))).alias("early"), label.alias("label"))

    best = F.array_max(F.transform(F.array_distinct(F.transform("s", lambda x: x["label"])), judged))
    return seen.select(*key, "pos", best.alias("b")).select(*key, "pos", "b.label", "b.conf")


def fill_gaps(merged: DataFrame, lengths: DataFrame, n: str, *key: str) -> DataFrame:
    """Positions no window covers become (O, 0.0)."""
    every = lengths.where(F.col(n) > 0).select(*key, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)).alias("pos"))
    # Spark takes the rows of ``every`` for as few as the documents they come from, and would broadcast them
    return every.join(merged.hint("merge"), [*key, "pos"], "left").select(*key, "pos", F.coalesce("label", F.lit("O")).alias("label"), F.coalesce("conf", F.lit(0.0)).alias("conf"))


def words_from_subwords(positions: DataFrame, *key: str, word: str = "word") -> DataFrame:
    """key, word, label, conf: the first sub-word's label, the mean confidence of all."""
    return positions.groupBy(*key, word).agg(F.min_by("label", "pos").alias("label"), F.avg("conf").alias("conf"))
