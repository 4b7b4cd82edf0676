"""From tags to entities."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.portions import in_portions

_FIELDS = {"ord": T.LongType(), "type": T.StringType(), "text": T.StringType(), "start": T.LongType(), "end": T.LongType(), "label": T.StringType(), "confidence": T.DoubleType()}
ENTITIES = T.ArrayType(T.StructType([T.StructField(name, kind) for name, kind in _FIELDS.items()]))


def rounded(x: np.ndarray, places: int = 4) -> np.ndarray:
    """Halves away from zero, of the decimal digits a number is written with, as Spark rounds."""
    scaled = x * 10.0**places
    out = np.rint(scaled) / 10.0**places
    for i in np.flatnonzero(np.isfinite(x) & (np.abs(np.abs(scaled - np.floor(scaled)) - 0.5) < 1e-6)):
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))
    return out


def entity_type(name: str) -> str:
    """The upper-case type of a tag's name, value suffix dropped."""
    return name.replace("_VALUE", "").upper()


def span_lists(tokens: pa.Array, value_only: bool = False, every: tuple[str, ...] | None = None) -> pa.Array:
    """The entities of every document's list of (token, start, end, label, conf); a null list stays null.

    With ``every`` only types that contain one of its parts keep all their entities, the others the first of a
    document: what ``clean.deduplicate`` takes. Their ``ord`` stays the one among all.

    All lists of a batch are walked at once: a label is read once for each batch, places
    that open or close are found by comparing neighbours.
    """
    sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0), np.int64)
    flat = tokens.flatten()
    coded = flat.field("label").dictionary_encode()
    names: list[str] = []
    types: dict[str, int] = {}
    # of every label: -2 passed over, -1 closes, else the number of its type; whether it always opens; the number of its name
    kinds, begins, named = [-2], [False], [0]
    for label in coded.dictionary.to_pylist():
        prefix, dash, name = label.partition("-")
        if label == "O" or not dash or (value_only and "_VALUE" not in label):
            kind = -1
        else:
            kind = types.setdefault(entity_type(name), len(types)) if prefix in ("B", "I") else -2
        kinds.append(kind)
        begins.append(prefix == "B")
        named.append(len(names))
        names.append(name)
    code = np.asarray(pc.fill_null(coded.indices, -1), np.int64) + 1  # a null label is passed over
    at = np.flatnonzero(np.array(kinds)[code] > -2)
    code = code[at]
    kind, doc = np.array(kinds)[code], np.repeat(np.arange(len(sizes)), sizes)[at]
    other = np.concatenate(([True], doc[1:] != doc[:-1])) if len(at) else np.zeros(0, bool)
    before = np.where(other, -1, np.concatenate(([-1], kind[:-1]))) if len(at) else kind
    opens = (kind >= 0) & (np.array(begins)[code] | (kind != before))
    edges = np.append(np.flatnonzero(opens | (kind < 0) | other), len(at))
    first = np.flatnonzero(opens)
    end = edges[np.searchsorted(edges, first, side="right")]
    owner = doc[first]
    number = np.arange(len(first)) - np.searchsorted(owner, owner) + 1
    if every is not None:
        all_of = np.array([any(p in t for p in every) for t in types], bool)[kind[first]] if len(first) else np.zeros(0, bool)
        once = np.zeros(len(first), bool)
        once[np.unique(owner * max(len(types), 1) + kind[first], return_index=True)[1]] = True
        stays = all_of | once
        first, end, owner, number = first[stays], end[stays], owner[stays], number[stays]
    n = end - first
    entity = np.repeat(np.arange(len(first)), n)
    member = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else first, n) + np.arange(int(n.sum()))
    rows = pa.array(at[member])
    conf = flat.field("conf").take(rows).cast(pa.float64())
    mean = np.bincount(entity, np.asarray(pc.fill_null(conf, 0.0)), len(first)) / np.maximum(n, 1)  # added in order
    unknown = np.bincount(entity, np.asarray(conf.is_null()), len(first)) > 0
    words = flat.field("token").take(rows).cast(pa.string())
    shown = np.asarray(words.is_valid())
    bounds = np.concatenate(([0], np.cumsum(np.bincount(entity, shown, len(first))))).astype(np.int32)
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), words.drop_null()), " ")
    head, last = pa.array(at[first]), pa.array(at[end - 1])
    counts = np.bincount(owner, minlength=len(sizes))
    upto = np.concatenate(([0], np.cumsum(counts)))
    fields = [
        pa.array(number, pa.int64()), pa.array(list(types), pa.string()).take(pa.array(kind[first])), text,
        flat.field("start").take(head).cast(pa.int64()), flat.field("end").take(last).cast(pa.int64()), pa.array([f"B-{x}" for x in names], pa.string()).take(pa.array(np.array(named)[code[first]])), pa.array(rounded(mean), mask=unknown),
    ]
    entities = pa.StructArray.from_arrays(fields, names=ENTITIES.elementType.names)
    return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32), mask=np.append(np.asarray(tokens.is_null()), False)), entities)


def decoded_spans(tokens: Column, value_only: bool = False) -> Column:
    """Entities (ord, type, text, start, end, label, confidence) of one document's array of
    (token, start, end, label, conf) in order.

    B- always opens, I- extends the same type and opens otherwise; O and tags
    without a dash close; tags with other prefixes are passed over. With
    ``value_only`` tags without the value suffix close too. An entity goes from a
    place that opens to the next that opens or closes, so a document costs in
    proportion to its tokens and never leaves its row.
    """
    return in_portions(lambda t: span_lists(t, value_only), ENTITIES)(tokens)


def decode_rows(docs: DataFrame, *key: str, tokens: str = "tokens", value_only: bool = False) -> DataFrame:
    """key, ord, type, text, start, end, label, confidence of documents with an array of labelled tokens: no shuffle."""
    return docs.select(*key, F.inline(decoded_spans(F.col(tokens), value_only)))


def decode_bio(tags: DataFrame, *key: str, value_only: bool = False) -> DataFrame:
    """The same from rows (key, tok_idx, token, start, end, label, conf), gathered by document once."""
    listed = F.array_sort(F.collect_list(F.struct("tok_idx", "token", "start", "end", "label", "conf")))
    return decode_rows(tags.groupBy(*key).agg(listed.alias("__tokens")), *key, tokens="__tokens", value_only=value_only)
