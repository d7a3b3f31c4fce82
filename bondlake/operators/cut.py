"""Cutting lineage so that every later read sees one fixed, recoverable copy."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a private one is made for local sessions only."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return tempfile.mkdtemp(prefix="bondlake-")


def scratch(spark: SparkSession) -> str:
    """A fresh folder in the shared one; ``remove`` it when its tables are no longer read."""
    return f"{shared_folder(spark)}/bondlake-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return the copy.

    The copy keeps the row order and the partition of every row, and outlives any
    executor. ``spark.cleaner.referenceTracking.cleanCheckpoints`` lets Spark remove copies
    that nothing refers to any more.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
