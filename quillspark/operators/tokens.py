"""Tokens with offsets, and entity spans as BIO tags.

A document's tokens stay in an array on its row until something needs rows, so
tokenising and tagging move nothing between machines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.portions import in_portions

TOKENS = T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
TAGGED = T.ArrayType(T.StructType([*TOKENS.elementType.fields, T.StructField("tag", T.StringType())]))


def token_lists(texts: pa.Array) -> pa.Array:
    """The tokens of all texts at once, cut from the bytes of the string column; a null text has none.

    A separator is one byte and never part of another character's; code points
    are counted by the bytes that begin one.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    inside = np.concatenate((~((raw == 32) | (raw == 10)), [False]))
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True  # a token never goes on into the next text
    before = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~before | edge))
    end = np.flatnonzero(before & (~inside | edge))
    points = np.concatenate(([0], np.cumsum(raw & 0xC0 != 0x80)))
    first = np.searchsorted(start, at)
    base = np.repeat(points[at[:-1]], np.diff(first))
    sizes = np.concatenate(([0], np.cumsum(end - start)))
    token = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw[inside[:-1]]))).cast(pa.string())
    rows = pa.StructArray.from_arrays([token, pa.array((points[start] - base).astype(np.int32)), pa.array((points[end] - base).astype(np.int32))], names=["token", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), rows)


def tokens_with_offsets(text: Column | str) -> Column:
    """Tokens between spaces and line ends (no other white space) with half-open code-point offsets.

    Spark has no running sum inside an array; the alternative, exploding every
    token and summing over a window, would shuffle the whole corpus.
    """
    return in_portions(token_lists, TOKENS)(text)


def token_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, tok_idx, token, start, end."""
    rows = docs.select(key, F.posexplode(tokens_with_offsets(text)).alias("tok_idx", "t"))
    return rows.select(key, F.col("tok_idx").cast("long").alias("tok_idx"), "t.token", F.col("t.start").cast("long").alias("start"), F.col("t.end").cast("long").alias("end"))


def token_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.translate(text, "\n", " "), " ", -1), lambda t: t != "")).cast("long")


def first_wins(starts: np.ndarray, ends: np.ndarray, low: list[int], high: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Per token of a document the entity that takes it (-1: none), and whether it is that one's first.

    Entities come in order of precedence as half-open spans. Tokens are in order
    and do not overlap, so an entity overlaps a stretch of them; it takes those
    still free. ``after`` leads over tokens already taken, so each is met once.
    """
    n = len(starts)
    winner, opens = np.full(n, -1, np.int64), np.zeros(n, bool)
    after = list(range(n + 1))

    def free(i: int) -> int:
        root = i
        while after[root] != root:
            root = after[root]
        while after[i] != root:
            after[i], i = root, after[i]
        return root

    firsts, lasts = np.searchsorted(ends, low, side="right").tolist(), np.searchsorted(starts, high, side="left").tolist()
    for e, (a, b) in enumerate(zip(firsts, lasts)):
        i, begun = free(a) if a < b else b, False
        while i < b:
            winner[i], opens[i] = e, not begun
            begun = True
            after[i] = i + 1
            i = free(i + 1)
    return winner, opens


def tag_lists(tokens: pa.Array, entities: pa.Array, ranked: bool) -> pa.Array:
    """The tags of every document's tokens; a null list of tokens stays null."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0), np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    flat = tokens.flatten()
    starts, ends = (np.asarray(flat.field(c)) for c in ("start", "end"))
    names, code = ["O"], np.zeros(len(flat), np.int32)
    known: dict[str | None, int] = {}
    for row in np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(entities), 0), np.int64)):
        listed = [(0 if not ranked or e["role"] == "VALUE" else 1, e["start"], i, e["end"], f"{e['label']}_{e['role']}" if ranked else e["label"]) for i, e in enumerate(entities[row].as_py())]
        listed.sort()
        own = slice(at[row], at[row + 1])
        winner, opens = first_wins(starts[own], ends[own], [e[1] for e in listed], [e[3] for e in listed])
        for i in np.flatnonzero(winner >= 0).tolist():
            tag = ("B-" if opens[i] else "I-") + listed[winner[i]][4]
            if tag not in known:
                known[tag] = len(names)
                names.append(tag)
            code[at[row] + i] = known[tag]
    tags = pa.DictionaryArray.from_arrays(pa.array(code), pa.array(names)).cast(pa.string())
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32), mask=np.append(np.asarray(tokens.is_null()), False)), tags)


def bio_tags(tokens: Column, entities: Column, ranked: bool = False) -> Column:
    """A tag per token. An entity is (label, start, end[, role]).

    A token goes to the overlapping entity that starts first (then the first
    listed); with ``ranked`` VALUE spans come before LABEL spans and the role is
    part of the tag. The first token an entity wins is B-, the others I-. Time is
    linear in tokens, and in entities but for putting them in order.
    """
    return in_portions(lambda t, e: tag_lists(t, e, ranked), T.ArrayType(T.StringType()))(tokens, entities)


def tagged_tokens(text: Column | str, entities: Column | str, ranked: bool = False) -> Column:
    """Tokens (token, start, end, tag) of a text by ``bio_tags``: cut and tagged in one pass, so that tokens cross to Python and back once."""

    def tagged(texts: pa.Array, listed: pa.Array) -> pa.Array:
        tokens = token_lists(texts)
        flat = tokens.flatten()
        rows = pa.StructArray.from_arrays([*(flat.field(c) for c in ("token", "start", "end")), tag_lists(tokens, listed, ranked).flatten()], names=["token", "start", "end", "tag"])
        return pa.ListArray.from_arrays(tokens.offsets, rows)

    return in_portions(tagged, TAGGED)(text, entities)


def bio_samples(records: DataFrame, ranked: bool = False) -> DataFrame:
    """tokens and ner_tags added to records of (text, entities); empty texts go."""
    out = records.where(F.col("text").rlike(r"[^ \n]")).withColumn("__t", tagged_tokens("text", "entities", ranked))
    return out.withColumn("ner_tags", F.transform("__t", lambda t: t["tag"])).withColumn("tokens", F.transform("__t", lambda t: t["token"])).drop("__t")


def missing_types(samples: DataFrame, expected: list[str]) -> DataFrame:
    """Which expected types no tag of a sample has."""
    seen = F.array_distinct(F.transform(F.filter("ner_tags", lambda t: F.contains(t, F.lit("-"))), lambda t: F.substr(t, F.lit(3))))
    return samples.withColumn("missing", F.array_except(F.array(*map(F.lit, expected)), seen))


def known_annotations(records: DataFrame, labels: list[str]) -> DataFrame:
    """Annotations whose type is among the labels' (B-x, I-x) and whose span is sound; empty texts go.
    ``n_unknown``: how many had a type that is not there."""
    types = F.array(*(F.lit(x) for x in sorted({label[2:] for label in labels if "-" in label})))
    sound = F.filter("entities", lambda e: F.array_contains(types, e["label"]) & (e["start"] >= 0) & (e["end"] >= 0) & (e["label"] != ""))
    unknown = F.filter("entities", lambda e: ~F.array_contains(types, e["label"]))
    return records.where(F.coalesce(F.col("text"), F.lit("")) != "").withColumn("n_unknown", F.size(unknown)).withColumn("entities", sound)
