"""Passages of a small table located in documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.portions import portions, weights

MOST_PASSAGES = 50_000
MOST_BYTES = 32 << 20
SPANS = "array<struct<item_id:long,start:long,end:long>>"


def located_passages(docs: DataFrame, passages: DataFrame, most: int = MOST_PASSAGES, every: bool = False) -> DataFrame:
    """doc_id, text, spans (item_id, start, end of each passage's first place) for documents that hold any; with ``every`` for all.

    Passages go to every task as one automaton while they are at most ``most`` and
    ``MOST_BYTES`` together (checked); a larger table is cut into parts, which the
    documents' rows pass one after the other. A row stays a row, repeated doc_ids too.
    """
    n, size = passages.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // most), -(-size // MOST_BYTES))
    out = docs.select("doc_id", "text", F.array().cast(SPANS).alias("spans"))
    for i in range(parts):
        chosen = passages.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == i)
        rows = [(r.item_id, r.text) for r in chosen.select("item_id", "text").where("text <> ''").collect()]

        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            machine = ahocorasick.Automaton()
            ids: dict[str, list[int]] = {}
            for item, text in rows:
                ids.setdefault(text, []).append(item)
            for text in ids:
                machine.add_word(text, text)
            if ids:
                machine.make_automaton()
            for batch in batches:
                for at, n in portions(weights(batch.column("text"))):  # texts become Python's a portion at a time
                    part, found = batch.slice(at, n), []
                    for text, known in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                        first: dict[str, int] = {}
                        for end, hit in machine.iter(text) if ids and text else ():
                            first.setdefault(hit, end + 1 - len(hit))
                        found.append([*known, *({"item_id": item, "start": start, "end": start + len(hit)} for hit, start in first.items() for item in ids[hit])])
                    spans = pa.array(found, part.schema.field("spans").type)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), spans], schema=part.schema)

        out = out.mapInArrow(run, f"doc_id long, text string, spans {SPANS}")
    if not every:
        out = out.where(F.size("spans") > 0)
    return out.withColumn("spans", F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["item_id"].alias("item_id"), s["end"].alias("end")))))
