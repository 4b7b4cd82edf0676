"""Tables kept as versions: written beside each other, told apart by content, switched in one step, read with a check.

A store is a folder with ``data/<table>/version=<n>`` and ``manifests/version=<n>``.
A version's tables are written first, its manifest last and by Spark's own commit, so
a reader sees a version whole or not at all; a write that broke off leaves rows that
no manifest names. A manifest row holds a table's name, rows and digest. The digest
is the sum and the xor of its rows' hashes, so it depends on neither order nor
partitions. Writing what the newest version already holds adds no version.

One writer at a time is assumed; two that write at once may take the same number,
of which the second fails, as its manifest is there.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "name string, n long, digest string"


def digest(rows: DataFrame) -> tuple[int, str]:
    """The number of rows and a digest of them as a bag."""
    h = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(rows.columns)))))
    n, total, xor = rows.agg(F.count("*"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))).first()
    return n, f"{int(total) & (1 << 64) - 1:016x}{xor & (1 << 64) - 1:016x}"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """version, name, n, digest of all committed versions; none where there is no store."""
    try:
        return spark.read.schema(f"{MANIFEST}, version long").json(f"{root}/manifests").where("name IS NOT NULL")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"{MANIFEST}, version long")


def newest(spark: SparkSession, root: str) -> int | None:
    return manifests(spark, root).agg(F.max("version")).first()[0]


def commit_version(root: str, tables: dict[str, DataFrame]) -> int:
    """Write the tables as a new version, or find that the newest one holds the same; its number."""
    spark = next(iter(tables.values())).sparkSession
    last = newest(spark, root)
    version = 1 if last is None else last + 1
    told = []
    for name, rows in tables.items():
        folder = f"{root}/data/{name}/version={version}"
        rows.write.mode("overwrite").parquet(folder)  # what a broken-off write left is replaced
        told.append((name, *digest(spark.read.parquet(folder))))
    if last is not None and sorted(told) == sorted((r.name, r.n, r.digest) for r in manifests(spark, root).where(F.col("version") == last).collect()):
        return last
    spark.createDataFrame(told, MANIFEST).coalesce(1).write.mode("error").json(f"{root}/manifests/version={version}")
    return version


def load_version(spark: SparkSession, root: str, version: int | None = None, check: bool = True) -> tuple[int, dict[str, DataFrame]] | None:
    """(number, tables) of a version, the newest by default, or None where the store has none; with ``check`` its content must be what was written."""
    wanted = newest(spark, root) if version is None else version
    rows = manifests(spark, root).where(F.col("version") == wanted).collect() if wanted is not None else []
    if not rows:
        return None
    tables = {r.name: spark.read.parquet(f"{root}/data/{r.name}/version={wanted}") for r in rows}
    if check and (broken := [r.name for r in rows if digest(tables[r.name]) != (r.n, r.digest)]):
        raise ValueError(f"version {wanted} of {root} is not what was written: {', '.join(broken)}")
    return wanted, tables


def write_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``rows`` has and leave the others; writing the same rows again changes nothing.

    Spark stages the files and moves whole partitions into place at the commit, so
    a task or a job that broke off leaves the old ones.
    """
    rows.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
