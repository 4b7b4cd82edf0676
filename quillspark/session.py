"""A session with the settings the plans are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "quillspark", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins; everything else as the cluster has it."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    for key in ("enabled", "coalescePartitions.enabled", "skewJoin.enabled"):
        builder = builder.config(f"spark.sql.adaptive.{key}", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
