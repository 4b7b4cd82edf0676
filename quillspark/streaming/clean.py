"""Streams: the stateless steps over documents as they arrive, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, is_vietnamese, keyword_form
from ..operators.tokens import token_count


def prepare_stream(docs: DataFrame, text: str = "text") -> DataFrame:
    """Cleaned text, keyword form, token count and language flag per arriving document; no state."""
    out = docs.withColumn(text, clean_text(F.col(text)))
    return out.withColumns({"keywords": keyword_form(F.col(text)), "n_tokens": token_count(F.col(text)), "vietnamese": is_vietnamese(F.col(text))})


def windowed_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts per window and kind; state is dropped once the watermark has passed a window."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, window).alias("w"), kind).agg(F.count("*").alias("n")).select("w.start", "w.end", kind, "n")


def sessions(events: DataFrame, key: str = "user_id", time: str = "ts", ident: str = "event_id", gap: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """key, start, end, n of closed sessions: stretches of a key's events no ``gap`` apart, each event counted once.

    An event that comes again within ``late`` of the newest time seen counts once;
    one that comes later than that is dropped with its window's state. A session
    is given out once the newest time is ``late`` past its end. Events without time
    or key are in no session.
    """
    known = events.where(F.col(time).isNotNull() & F.col(key).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    once = known.dropDuplicatesWithinWatermark([ident])
    return once.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, "w.start", "w.end", "n")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process what has arrived, in as many batches as the source makes, and stop; a run that broke off goes on from its checkpoint."""
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
