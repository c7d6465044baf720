"""Session helpers. Operators never create a session; callers pass one in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from .params import DEFAULT, Params


def pin_time_zone(spark: SparkSession, params: Params = DEFAULT) -> None:
    """Calendar fields depend on the session zone; the study pins it (UTC)."""
    spark.conf.set("spark.sql.session.timeZone", params.time_zone)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name below the checkpoint folder that all executors share. Only a
    local session that names none (tests, one machine) gets a temporary one."""
    named = checkpoint_dir(spark)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="farelens-"))
    return f"{named.rstrip('/')}/farelens-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """Make sure checkpoints have a folder: the one the session names, else
    ``folder``, which the caller chooses. On a cluster it must be shared by all
    executors, so none is made up here."""
    d = checkpoint_dir(spark) or folder
    if d is None:
        raise ValueError("name a shared folder in spark.checkpoint.dir, or pass one")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "farelens") -> SparkSession:
    """A local session for tests and the benchmark (never used by operators)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
