"""Tables in the folder that the cluster's executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def root(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; only a local master without one gets a temporary folder."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is unset; a cluster needs a shared folder there")
    if not _own:
        _own.append(f"file://{tempfile.mkdtemp(prefix='gridloom-')}")
    return _own[0]


def path(spark: SparkSession, name: str) -> str:
    return f"{root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes a table and reads it again: lineage ends there."""
    at = path(df.sparkSession, name)
    df.write.parquet(at)
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out._scratch_path = at
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialise returned, once nothing reads them any more; others are left alone."""
    for df in tables:
        if at := getattr(df, "_scratch_path", None):
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(at)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
