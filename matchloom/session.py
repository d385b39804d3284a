"""Session helpers: shared scratch folder, reliable lineage cuts, table loading."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", name: str = "matchloom") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MATCHLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without one (tests, a laptop) gets a folder of its own; on a cluster
    a folder of the driver would be another one on each executor, so there it is an error.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="matchloom-")
        spark.conf.set(CHECKPOINT_KEY, configured)
    return configured.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a written table, so lost executors replay nothing upstream."""
    path = fresh_dir(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at a path, or None if there is nothing yet. Any other failure is raised:
    a table that can't be read is not an empty one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    fs, where = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()] if fs.exists(where) else []


def is_whole(spark: SparkSession, path: str) -> bool:
    """Has the write of this folder ended?"""
    fs, where = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Zone-less timestamps are read as UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df
