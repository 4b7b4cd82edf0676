"""Templates rendered with the offsets of what they were filled with."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import locate, uniform

PLACEHOLDER = re.compile(r"\{\{\s*(\w+)\s*(\.upper\(\))?\s*\}\}")


def parse_template(body: str) -> list[tuple[str, str, bool]]:
    """(literal, field, upper) segments in order; the last has no field."""
    out, at = [], 0
    for m in PLACEHOLDER.finditer(body):
        out.append((body[at : m.start()], m[1], bool(m[2])))
        at = m.end()
    return [*out, (body[at:], "", False)]


def template_shape(templates: DataFrame) -> DataFrame:
    """doc_type, n_templates, fields (distinct, sorted) of (doc_type, template_idx, body)."""
    shown = F.regexp_extract_all("body", F.lit(PLACEHOLDER.pattern), F.lit(1))
    rows = templates.select("doc_type", "template_idx", F.explode_outer(shown).alias("field"))
    return rows.groupBy("doc_type").agg(F.count_distinct("template_idx").alias("n_templates"), F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields"))


def given_template(index: Column, n: int) -> Column:
    """A given number, modulo the number of templates."""
    return F.pmod(index, F.lit(n)).cast("long")


def drawn_template(key: Column, n: int, seed: int = 42) -> Column:
    """A template drawn evenly."""
    return F.floor(uniform(seed, key, "template") * n).cast("long")


def render(records: DataFrame, body: str, schema_fields: list[str], text: str = "text", entities: str = "entities") -> DataFrame:
    """``text`` and ``entities`` (label, start, end, value) added to records of string columns.

    A template is a fixed list of segments, so a record is rendered in one
    projection: offsets are sums of literal and value lengths. Fields without a
    column are empty, empty values are not tracked, and a field shown in upper
    case is labelled in upper case.
    """
    pieces: list[Column] = []
    found: list[Column] = []
    at: Column = F.lit(0)
    for literal, field, upper in parse_template(body):
        pieces.append(F.lit(literal))
        at = at + len(literal)
        if not field:
            continue
        value = F.coalesce(F.col(field).cast("string"), F.lit("")) if field in records.columns else F.lit("")
        value = F.upper(value) if upper else value
        pieces.append(value)
        size = F.length(value)
        if field in schema_fields:
            found.append(F.struct(F.lit(field.upper() if upper else field).alias("label"), at.alias("start"), (at + size).alias("end"), value.alias("value")))
        at = at + size
    spans = F.filter(F.array(*found), lambda e: e["end"] > e["start"]) if found else F.array().cast("array<struct<label:string,start:int,end:int,value:string>>")
    return records.withColumns({text: F.concat(*pieces), entities: spans})


def render_any(records: DataFrame, bodies: list[str], schema_fields: list[str], index: Column) -> DataFrame:
    """Each record with template number index modulo the number of templates."""
    chosen = records.withColumn("template_idx", F.pmod(index, F.lit(len(bodies))).cast("int"))
    parts = [render(chosen.where(F.col("template_idx") == i), body, schema_fields) for i, body in enumerate(bodies)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def locate_spans(text: Column, labels: dict[str, str], values: dict[str, Column]) -> Column:
    """LABEL and VALUE spans by search: the first place of a field's label, then the first place of its value after it."""
    out = []
    for field, label in labels.items():
        at = F.locate(label, text)
        value_at = locate(values[field], text, at + len(label))
        span = lambda start, size, role, ok: F.when(ok, F.struct(F.lit(field).alias("label"), (start - 1).alias("start"), (start - 1 + size).alias("end"), F.lit(role).alias("role")))  # noqa: B023, E731
        out += [span(at, F.lit(len(label)), "LABEL", at > 0), span(value_at, F.length(values[field]), "VALUE", (at > 0) & (value_at > 0) & (values[field] != ""))]
    return F.array_compact(F.array(*out))


def build_lines(records: DataFrame, key: str, fields: dict[str, tuple[Column, list[str]]], separators: list[str], merged: list[tuple[str, str, float]] = (), seed: int = 42, text: str = "text", spans: str = "spans") -> DataFrame:
    """``text`` and ``spans`` (label, role LABEL or VALUE, start, end) of labelled lines in a drawn order.

    ``fields``: {name: (value, spellings of its label)}. A line is a drawn spelling,
    a drawn separator and the value. ``merged``: (field, field that follows on its
    line, how often); the pair shares the first one's separator. Lines come in the
    order of a draw per record and field. Every draw is a hash of (seed, key, field),
    so a record looks the same in any partition. Offsets are sums over the pieces
    in their new order; nothing is searched, so a value that occurs twice is no trouble.
    Null values count as empty; empty values have no span.
    """
    draw = lambda slot, *more: uniform(seed, F.col(key), slot, *more)
    choice = lambda values, slot, *more: F.element_at(F.array(*map(F.lit, values)), (F.floor(draw(slot, *more) * len(values)) + 1).cast("int"))
    piece = lambda s, field, role: F.struct(s.alias("s"), F.lit(field).cast("string").alias("label"), F.lit(role).cast("string").alias("role"))
    label = {f: choice(spellings, "label", F.lit(f)) for f, (_, spellings) in fields.items()}
    value = {f: F.coalesce(v.cast("string"), F.lit("")) for f, (v, _) in fields.items()}
    own = lambda f, at: [piece(label[f], f, "LABEL"), piece(at, None, None), piece(value[f], f, "VALUE")]
    joins = {a: (b, share) for a, b, share in merged}
    follows = {b: a for a, b, _ in merged}
    lines = []
    for f in fields:
        separator = choice(separators, "separator", F.lit(f))
        pieces = F.array(*own(f, separator))
        if f in joins:
            other, share = joins[f]
            pieces = F.when(draw("merge", F.lit(f)) < share, F.array(*own(f, separator), piece(F.lit("  "), None, None), *own(other, separator))).otherwise(pieces)
        alone = F.lit(True) if f not in follows else draw("merge", F.lit(follows[f])) >= joins[follows[f]][1]
        lines.append(F.when(alone, F.struct(draw("order", F.lit(f)).alias("draw"), F.lit(f).alias("field"), pieces.alias("pieces"))))
    ordered = F.transform(F.array_sort(F.array_compact(F.array(*lines))), lambda x: x["pieces"])
    # a line end before every line but the first
    flat = F.flatten(F.transform(ordered, lambda p, i: F.when(i > 0, F.concat(F.array(piece(F.lit("\n"), None, None)), p)).otherwise(p)))
    rows = records.withColumn("__pieces", flat)
    ends = F.aggregate("__pieces", F.array().cast("array<int>"), lambda out, p: F.concat(out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)) + F.length(p["s"]))))
    rows = rows.withColumn("__ends", ends)
    placed = F.zip_with("__pieces", "__ends", lambda p, e: F.struct(p["label"].alias("label"), p["role"].alias("role"), (e - F.length(p["s"])).alias("start"), e.alias("end")))
    kept = F.filter(placed, lambda x: x["role"].isNotNull() & (x["end"] > x["start"]))
    return rows.withColumns({text: F.array_join(F.transform("__pieces", lambda p: p["s"]), ""), spans: kept}).drop("__pieces", "__ends")
