"""What labels tokens: any model behind one Arrow boundary, rules, or hashes for tests."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import place_draws
from ..functions.portions import MOST_BYTES, in_portions
from ..functions.text import uniform
from .clean import FIRSTS, MERGED, first_lists
from .decode import ENTITIES, decoded_spans, span_lists
from .tokens import TOKENS, token_lists, tokens_with_offsets
from .windows import CONTENT, WINDOWS

LABELLED = T.ArrayType(T.StructType([*TOKENS.elementType.fields, T.StructField("label", T.StringType()), T.StructField("conf", T.DoubleType())]))


class TokenLabeler(Protocol):
    """Adds ``label`` and ``conf`` to rows of (key, tok_idx, token, start, end), or to a document's array of (token, start, end)."""

    def label(self, tokens: DataFrame, key: str) -> DataFrame: ...

    def label_array(self, tokens: Column, key: str) -> Column: ...


def labelled(tokens: Column, label, conf) -> Column:
    """An array of (token, start, end) with label(x, i) and conf(x, i, label) added."""
    named = F.transform(tokens, lambda x, i: F.struct(x["token"].alias("token"), x["start"].alias("start"), x["end"].alias("end"), label(x, i).alias("label")))
    return F.transform(named, lambda x, i: F.struct(x["token"].alias("token"), x["start"].alias("start"), x["end"].alias("end"), x["label"].alias("label"), conf(x, i).alias("conf")))


def draws(heads: list[bytes], tails: list[bytes]) -> np.ndarray:
    """``uniform`` for every head with the tail beside it: the MD5 of both, its first four bytes as a number in [0, 1)."""
    return np.frombuffer(b"".join([md5(a + b).digest() for a, b in zip(heads, tails)]), ">u4")[::4] / 4294967296.0


def head_of(*parts: object) -> bytes:
    """The beginning of a key of ``uniform``, its nulls left out."""
    return b"".join(str(p).encode() + b"|" for p in parts if p is not None)


class HashLabeler:
    """Pseudo-labels from hashes, for plans and tests without a model."""

    def __init__(self, labels: list[str], seed: int = 42) -> None:
        self.labels, self.seed = labels, seed

    def label(self, tokens: DataFrame, key: str) -> DataFrame:
        u = uniform(self.seed, F.col(key), F.col("tok_idx"), "label")
        label = F.element_at(F.array(*map(F.lit, self.labels)), (F.floor(u * len(self.labels)) + 1).cast("int"))
        return tokens.withColumn("label", label).withColumn("conf", F.floor(uniform(self.seed, F.col(key), F.col("tok_idx"), "conf") * 64) / 64)

    def label_array(self, tokens: Column, key: str) -> Column:
        return in_portions(self.label_lists, LABELLED)(tokens, F.col(key).cast("string"))

    def label_lists(self, tokens: pa.Array, keys: pa.Array) -> pa.Array:
        """The same of every document's list at once."""
        sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0), np.int64)
        flat = tokens.flatten()
        heads = [head_of(self.seed, k) for k in keys.to_pylist()]
        at, share = (place_draws(heads, sizes, slot) for slot in (b"|label", b"|conf"))
        label = pa.array(self.labels, pa.string()).take(pa.array((at * len(self.labels)).astype(np.int64)))
        rows = pa.StructArray.from_arrays([*(flat.field(c) for c in ("token", "start", "end")), label, pa.array(np.floor(share * 64) / 64)], names=LABELLED.elementType.names)
        at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at, mask=np.append(np.asarray(tokens.is_null()), False)), rows)

    def label_sets(self, tokens: pa.Array, keys: pa.Array) -> pa.Array:
        """The distinct labels of every document's list."""
        sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0), np.int64)
        at = place_draws([head_of(self.seed, k) for k in keys.to_pylist()], sizes, b"|label")
        names = list(dict.fromkeys(self.labels))
        seen = np.zeros((len(sizes), len(names)), bool)
        seen[np.repeat(np.arange(len(sizes)), sizes), np.array([names.index(x) for x in self.labels])[(at * len(self.labels)).astype(np.int64)]] = True
        upto = np.concatenate(([0], np.cumsum(seen.sum(axis=1)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(upto), pa.array(names, pa.string()).take(pa.array(np.nonzero(seen)[1])))


def label_sets(text: Column, key: str, labeler: HashLabeler) -> Column:
    """The distinct labels of a text's tokens; tokens never leave the task's Python."""
    return in_portions(lambda t, k: labeler.label_sets(token_lists(t), k), T.ArrayType(T.StringType()))(text, F.col(key).cast("string"))


def entity_spans(text: Column, key: str, labeler: TokenLabeler, value_only: bool = False) -> Column:
    """A text's entities (see ``decoded_spans``). With a labeler of whole lists, tokens never leave the task's Python."""
    if not hasattr(labeler, "label_lists"):
        return decoded_spans(labeler.label_array(tokens_with_offsets(text), key), value_only)
    return in_portions(lambda t, k: span_lists(labeler.label_lists(token_lists(t), k), value_only), ENTITIES)(text, F.col(key).cast("string"))


def first_spans(text: Column, key: str, labeler: TokenLabeler) -> Column:
    """The first of a text's entities of each type (see ``first_lists``), found and trimmed before they leave the task's Python."""
    found = lambda labelled: first_lists(span_lists(labelled, every=MERGED))
    if not hasattr(labeler, "label_lists"):
        return in_portions(found, FIRSTS)(labeler.label_array(tokens_with_offsets(text), key))
    return in_portions(lambda t, k: found(labeler.label_lists(token_lists(t), k)), FIRSTS)(text, F.col(key).cast("string"))


class RuleLabeler:
    """(pattern, label) rules over single tokens; the first that matches wins, everything else is O."""

    def __init__(self, rules: list[tuple[str, str]]) -> None:
        self.rules = rules

    def label(self, tokens: DataFrame, key: str) -> DataFrame:
        label = None
        for pattern, name in self.rules:
            label = (F.when if label is None else label.when)(F.col("token").rlike(pattern), F.lit(f"B-{name}"))
        label = F.lit("O") if label is None else label.otherwise("O")
        return tokens.withColumn("label", label).withColumn("conf", F.when(F.col("label") == "O", 0.5).otherwise(1.0))

    def label_array(self, tokens: Column, key: str) -> Column:
        def named(x: Column, i: Column) -> Column:
            label = None
            for pattern, name in self.rules:
                label = (F.when if label is None else label.when)(x["token"].rlike(pattern), F.lit(f"B-{name}"))
            return F.lit("O") if label is None else label.otherwise("O")

        return labelled(tokens, named, lambda x, i: F.when(x["label"] == "O", 0.5).otherwise(1.0))


def window_lists(windows: pa.Array, labels: pa.Array, confs: pa.Array) -> pa.Array:
    """Windows (win, start, labels, confs) from windows (win, start, ids) and a label and confidence for every id."""
    flat = windows.flatten()
    upto = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(flat.field("ids")), 0), np.int64)))).astype(np.int32)
    each = pa.StructArray.from_arrays([flat.field("win"), flat.field("start"), *(pa.ListArray.from_arrays(pa.array(upto), x) for x in (labels, confs))], names=WINDOWS.elementType.names)
    at = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(windows), 0), np.int64)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), each)


class IdLabeler:
    """Labels and confidences that follow from the sub-word id alone, in the place of a model."""

    def __init__(self, labels: list[str]) -> None:
        self.labels = labels

    def label_windows(self, windows: DataFrame, *key: str) -> DataFrame:
        rows = windows.select(*key, "win", "start", F.posexplode("ids").alias("i", "id"))
        label = F.element_at(F.array(*map(F.lit, self.labels)), (F.col("id") % len(self.labels) + 1).cast("int"))
        return rows.select(*key, "win", (F.col("start") + F.col("i")).alias("pos"), label.alias("label"), (F.col("id") % 64 / 64.0).cast("double").alias("conf"))


    def label_window_lists(self, windows: Column) -> Column:
        """The same on the document's row: an array of (win, start, labels, confs) from one of (win, start, ids)."""

        def labelled(part: pa.Array) -> pa.Array:
            ids = np.asarray(part.flatten().field("ids").flatten(), np.int64)
            return window_lists(part, pa.array(self.labels, pa.string()).take(pa.array(ids % len(self.labels))), pa.array(ids % 64 / 64.0))

        return in_portions(labelled, WINDOWS, MOST_BYTES // CONTENT)(windows)


class ModelLabeler:
    """A model loaded once per Python worker: ``load()`` gives a function from lists of id windows to
    (labels, confidences) per position."""

    def __init__(self, load: Callable[[], Callable[[list[list[int]]], list[tuple[list[str], list[float]]]]]) -> None:
        self.load = load

    def label_windows(self, windows: DataFrame, *key: str) -> DataFrame:
        """key, win, pos, label, conf from (key, win, start, ids)."""
        load = self.load

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = load()
            for part in batches:
                done = model([list(x) for x in part["ids"]])
                part = part.assign(label=[x for x, _ in done], conf=[c for _, c in done], pos=[list(range(s, s + len(i))) for s, i in zip(part["start"], part["ids"])])
                yield part.explode(["label", "conf", "pos"]).dropna(subset=["label"])[[*key, "win", "pos", "label", "conf"]].astype({"pos": "int64", "conf": "float64"})

        types = dict(windows.dtypes)
        return windows.select(*key, "win", "start", "ids").mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in key), "win long, pos long, label string, conf double"]))


    def label_window_lists(self, windows: Column) -> Column:
        """The same on the document's row: an array of (win, start, labels, confs) from one of (win, start, ids)."""
        load, loaded = self.load, []

        def labelled(part: pa.Array) -> pa.Array:
            if not loaded:
                loaded.append(load())
            done = loaded[0](part.flatten().field("ids").to_pylist())
            return window_lists(part, pa.array([x for own, _ in done for x in own], pa.string()), pa.array([c for _, own in done for c in own], pa.float64()))

        return in_portions(labelled, WINDOWS, MOST_BYTES // CONTENT)(windows)


class TaggerWeights:
    """A linear tagger of sub-words: a score per (bucket of id, label), softmax over labels.

    ``fit`` takes them from labelled sub-words by counting (naive Bayes with one added
    to every count), so the table has ``buckets`` rows whatever the corpus.
    """

    def __init__(self, labels: list[str], scores: np.ndarray) -> None:
        self.labels, self.scores, self._best = labels, scores, None

    @classmethod
    def fit(cls, rows: DataFrame, labels: list[str], buckets: int) -> TaggerWeights:
        """From rows (id, label), or (id, label, n) that stand for n of them."""
        counts = np.zeros((buckets, len(labels)))
        place = {x: i for i, x in enumerate(labels)}
        found = rows.where(F.col("label").isin(*labels)).groupBy(F.pmod("id", F.lit(buckets)).alias("bucket"), "label").agg((F.sum("n") if "n" in rows.columns else F.count("*")).alias("n"))
        for r in found.collect():  # at most buckets times labels rows
            counts[r.bucket, place[r.label]] = r.n
        prior = np.log(counts.sum(axis=0) + 1)
        return cls(list(labels), np.log(counts + 1) - np.log(counts.sum(axis=0) + buckets) + prior)

    def predict(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best label's number and its probability for every id; a negative id (padding) has none."""
        if self._best is None:  # a bucket's answer is the same wherever it is met
            p = np.exp(self.scores - self.scores.max(axis=-1, keepdims=True))
            p /= p.sum(axis=-1, keepdims=True)
            self._best = p.argmax(axis=-1), p.max(axis=-1)
        bucket = np.maximum(ids, 0) % len(self.scores)
        return self._best[0][bucket], self._best[1][bucket]


class BatchLabeler:
    """A model behind ``predict_batch_udf``: built once in every Python worker, fed fixed-size batches of padded windows."""

    def __init__(self, model: TaggerWeights, length: int, batch_size: int = 64) -> None:
        self.model, self.length, self.batch_size = model, length, batch_size

    def label_windows(self, windows: DataFrame, *key: str) -> DataFrame:
        """key, win, pos, label, conf from (key, win, start, ids)."""
        rows = self.label_window_rows(windows, *key)
        each = rows.select(*key, "win", "start", F.posexplode(F.arrays_zip("labels", "confs")).alias("i", "o"))
        names = F.array(*map(F.lit, self.model.labels))
        return each.select(*key, "win", (F.col("start") + F.col("i")).alias("pos"), F.coalesce(F.get(names, F.col("o.labels")), F.lit("O")).alias("label"), F.col("o.confs").alias("conf"))

    def label_window_rows(self, windows: DataFrame, *key: str) -> DataFrame:
        """key, win, start, labels (their numbers), confs: a row stays a window."""
        model = self.model

        def make():
            def run(ids: np.ndarray) -> dict[str, np.ndarray]:
                best, p = model.predict(ids.astype(np.int64))
                return {"best": best.astype(np.int32), "conf": p}

            return run

        result = T.StructType([T.StructField("best", T.ArrayType(T.IntegerType())), T.StructField("conf", T.ArrayType(T.DoubleType()))])
        call = predict_batch_udf(make, return_type=result, batch_size=self.batch_size, input_tensor_shapes=[[self.length]])
        padded = F.concat("ids", F.array_repeat(F.lit(-1), self.length - F.size("ids")))
        rows = windows.withColumn("__out", call(padded))
        own = lambda c: F.slice(c, F.lit(1), F.size("ids"))
        return rows.select(*key, "win", "start", own("__out.best").alias("labels"), own("__out.conf").alias("confs"))

    def label_flat(self, ids: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Labels (their numbers) and confidences of the places of windows, one window after the other, inside a task's Python:
        ``ids`` of documents one after the other, of every window the first place among them and its length."""
        best, conf = np.zeros(int(lengths.sum()), np.int64), np.zeros(int(lengths.sum()))
        upto = np.concatenate(([0], np.cumsum(lengths)))
        for a in range(0, len(first), self.batch_size):
            b = min(a + self.batch_size, len(first))
            own = np.arange(self.length) < lengths[a:b, None]
            padded = np.full(own.shape, -1, np.int64)
            padded[own] = ids[(first[a:b, None] + np.arange(self.length))[own]]
            named, p = self.model.predict(padded)
            best[upto[a] : upto[b]], conf[upto[a] : upto[b]] = named[own], p[own]
        return best, conf
