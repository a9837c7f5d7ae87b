"""Where a job may write intermediate tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only for local sessions."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="cohortflow-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/cohortflow/{label}-{uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several jobs reuse and read it back: its lineage ends on
    storage that outlives any executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._settled_at = path
    return found


def stored(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def discard(*frames: DataFrame) -> None:
    """Removes the tables behind frames that ``settle`` returned and that no later job reads."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._settled_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
