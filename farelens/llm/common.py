"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the blanks of the contracts, as a Java/DuckDB character class
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot when it holds more than one in HOT_SHARE rows, so there are fewer than HOT_SHARE of them.
HOT_SHARE = 1024


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local
    session (tests, one machine) falls back to a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="farelens-llm-"))
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and reread: the
    lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}.parquet"
    df.write.option("compression", codec).parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def discard(*kept: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and nothing reads any more."""
    for df in kept:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def clean_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """The caller's columns as one struct ``row``, whose names so meet none of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def doc_crc(id_col: str = "doc_id") -> Column:
    """crc32 of the decimal id, the hash that the hold-out rules use."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def join_hot(rows: DataFrame, table: DataFrame, key: str, weight: str, n_rows: int) -> DataFrame:
    """Inner join of ``rows`` to ``table`` (one row per ``key``; ``weight`` = how
    many rows hold that key). Keys with more than ``n_rows / HOT_SHARE`` rows are
    fewer than HOT_SHARE by counting, so that part is broadcast: their rows are joined
    where they lie, and taken out before the others shuffle on the key."""
    least = n_rows // HOT_SHARE
    hot = F.broadcast(table.where(F.col(weight) > least))
    cold = table.where(F.col(weight) <= least)
    others = rows.join(F.broadcast(table.where(F.col(weight) > least).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(others.join(cold, key))
