"""Sinks and guards. Reports are written by executors (never pandas on the
driver); only aggregated, bounded results are coalesced to one file."""

from __future__ import annotations

from decimal import Decimal

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class EmptyInputError(ValueError):
    """Raised when a stage receives no rows."""


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail fast on an empty frame (one cheap ``isEmpty`` job, stops at the first row)."""
    if df.isEmpty():
        raise EmptyInputError(f"{what} has no rows")
    return df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _counts(df: DataFrame) -> list[Column]:
    """Rows, and for each column a sum of its values' hashes that any order gives."""
    sums = [F.sum(F.xxhash64(F.col(f"`{c}`")).cast("decimal(38,0)")).alias(c) for c in df.columns]
    return [F.count(F.lit(1)).alias("__rows"), *sums]


def _as_counts(found: dict) -> dict[str, int]:
    return {c: int(v or Decimal(0)) for c, v in found.items()}


def write_counted(df: DataFrame, path: str) -> dict[str, int]:
    """Write ``df`` as Parquet and, counted while it is written, its rows and column
    checksums beside it (``<path>.counts``, JSON). Returns them: ``__rows`` and a sum of
    hashes per column. There is no further pass over the data."""
    seen = Observation()
    df.observe(seen, *_counts(df)).write.mode("overwrite").parquet(path)
    found = _as_counts(seen.get)
    rows = [(c, str(v)) for c, v in found.items()]
    df.sparkSession.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").json(f"{path}.counts")
    return found


def read_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """What ``write_counted`` left beside a table; one row per column."""
    return {r["name"]: int(r["value"]) for r in spark.read.schema("name string, value string").json(f"{path}.counts").collect()}


def count_table(df: DataFrame) -> dict[str, int]:
    """The same numbers of a table as it is read, in one pass."""
    return _as_counts(df.agg(*_counts(df)).first().asDict())


def write_report_csv(report: DataFrame, path: str, single_file: bool = True) -> None:
    """Report tables are aggregates (bounded rows): one CSV file with a header.
    An empty report writes nothing, as the study skipped empty frames.

    The report is kept while it is tested and written, so its input is read once."""
    kept = persist_for_passes(report)
    try:
        if not kept.isEmpty():
            out = kept.coalesce(1) if single_file else kept
            out.write.mode("overwrite").option("header", True).csv(path)
    finally:
        kept.unpersist()


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """Long metrics (one row per metric) as JSON lines."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def persist_for_passes(df: DataFrame) -> DataFrame:
    """Cache before multi-pass work (model fits); the caller unpersists."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` what ``published(path)`` answers: one small file, written after
    everything it stands for. Spark commits it by a rename, so it is there or not."""
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.text(f"{path}/published/{version}")


def published(spark: SparkSession, path: str) -> str | None:
    """The last published version below ``path``; None if there is none."""
    try:
        rows = spark.read.text(f"{path}/published/*").collect()  # a line a version
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return max((r["value"] for r in rows), default=None)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence of a saved model or table, through Spark's own reader (so any
    store that Spark reads)."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
