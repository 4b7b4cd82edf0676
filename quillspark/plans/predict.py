"""A token-classification model over long documents: sub-words, windows, merge, words, entities."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.portions import MOST_BYTES, in_portions, portions, weights
from ..operators.decode import ENTITIES, span_lists
from ..operators.labeler import BatchLabeler, IdLabeler, ModelLabeler
from ..operators.tokens import TOKENS, token_lists
from ..operators.windows import CONTENT, INFER_STEP, merge_codes, merge_lists, window_arrays, window_bounds, word_lists

ENCODED = T.StructType([T.StructField("tokens", TOKENS), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("sizes", T.ArrayType(T.IntegerType()))])

SERVED = T.StructType([T.StructField("n", T.LongType()), T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("least_conf", T.DoubleType()), T.StructField("most_conf", T.DoubleType())])


def encode_subwords(docs: DataFrame, encode: Callable[[str], list[int]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, tokens, ids (flat sub-word ids), sizes (sub-words per token; 0 for a token without any)."""

    def encoded(texts: pa.Array) -> pa.Array:
        tokens = token_lists(texts)
        each = [list(encode(t)) for t in tokens.flatten().field("token").to_pylist()]
        sizes = np.array([len(x) for x in each], np.int32)
        at = np.concatenate(([0], np.cumsum(sizes)))[np.asarray(tokens.offsets)].astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(at), pa.array([i for x in each for i in x], pa.int32()))
        return pa.StructArray.from_arrays([tokens, ids, pa.ListArray.from_arrays(tokens.offsets, pa.array(sizes))], names=ENCODED.names)

    return docs.select(key, in_portions(encoded, ENCODED)(text).alias("__e")).select(key, "__e.tokens", "__e.ids", "__e.sizes")


def label_counts(docs: DataFrame, encode: Callable[[pa.Array], pa.Array], label: Callable[[pa.Array], pa.Array], text: str = "text") -> DataFrame:
    """id, label, n: how many sub-words of each id have each label, as parts to be added up.

    ``encode`` gives every token's list of ids, ``label`` its label. They are asked once for a
    token of a portion of texts; what leaves the task are the portion's distinct ids and labels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for at, n in portions(weights(texts)):
                tokens = pc.value_counts(token_lists(texts.slice(at, n)).flatten().field("token"))
                ids = encode(tokens.field("values"))
                of = pc.list_parent_indices(ids)
                rows = pa.table({"id": ids.flatten().cast(pa.int64()), "label": label(tokens.field("values")).take(of), "n": tokens.field("counts").take(of)})
                yield from rows.group_by(["id", "label"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["id", "label", "n"]).to_batches()

    return docs.select(text).mapInArrow(run, "id long, label string, n long")


def served_counts(docs: DataFrame, encode: Callable[[pa.Array], pa.Array], labeler: BatchLabeler, key: str = "doc_id", text: str = "text", content: int = CONTENT, step: int = INFER_STEP) -> DataFrame:
    """key, n, counts (places of each of the model's labels), least_conf, most_conf of every document with sub-words,
    labelled window by window and merged. A document never leaves its row, its sub-words and places never the task."""
    names = labeler.model.labels
    gap = names.index("O") if "O" in names else len(names)

    def counted(texts: pa.Array) -> pa.Array:
        tokens = token_lists(texts)
        ids = encode(tokens.flatten().field("token"))
        base = np.asarray(ids.offsets)[np.asarray(tokens.offsets)].astype(np.int64)
        counts = np.diff(base)
        row, win, start, lengths = window_bounds(counts, content, step)
        code, conf = labeler.label_flat(np.asarray(ids.values), base[row] + start, lengths)
        code, conf = merge_codes(counts, row, win, start, lengths, code, conf, len(names) + 1)
        code[code == len(names)] = gap  # places that no window covers
        each = np.bincount(np.repeat(np.arange(len(counts)), counts) * (len(names) + 1) + code, minlength=len(counts) * (len(names) + 1)).reshape(len(counts), -1)[:, : len(names)]
        some = np.flatnonzero(counts)
        least, most = np.zeros(len(counts)), np.zeros(len(counts))
        if len(some):
            least[some], most[some] = (f.reduceat(conf, base[some] - base[0]) for f in (np.minimum, np.maximum))
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * len(names)), pa.array(np.ascontiguousarray(each).ravel(), pa.int64()))
        return pa.StructArray.from_arrays([pa.array(counts), listed, pa.array(least), pa.array(most)], names=SERVED.names)

    return docs.select(key, in_portions(counted, SERVED, MOST_BYTES // 4)(text).alias("__s")).select(key, "__s.*").where("n > 0")


def predict(docs: DataFrame, encode: Callable[[str], list[int]], labeler: ModelLabeler | IdLabeler, key: str = "doc_id", text: str = "text", content: int = CONTENT, step: int = INFER_STEP) -> DataFrame:
    """key, ord, type, text, start, end, label, confidence of the entities a model finds.

    Windows overlap; a position takes the label of the highest mean confidence,
    a token its first sub-word's label and the mean confidence of all of them, a
    token without sub-words (O, 0.0). A document never leaves its row.
    """

    def found(tokens: pa.Array, sizes: pa.Array, n: pa.Array, windows: pa.Array) -> pa.Array:
        words = word_lists(merge_lists(windows, n), sizes).flatten()
        flat = tokens.flatten()
        rows = pa.StructArray.from_arrays([*(flat.field(c) for c in ("token", "start", "end")), words.field("label"), words.field("conf")], names=["token", "start", "end", "label", "conf"])
        return span_lists(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.asarray(tokens.value_lengths(), np.int64)))).astype(np.int32)), rows))

    rows = encode_subwords(docs, encode, key, text).select(key, "tokens", "sizes", F.size("ids").cast("long").alias("n"), window_arrays(F.col("ids"), content, step).alias("w"))
    labelled = rows.withColumn("w", labeler.label_window_lists(F.col("w")))
    return labelled.select(key, F.inline(in_portions(found, ENTITIES)("tokens", "sizes", "n", "w")))
