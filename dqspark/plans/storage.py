"""Shared working storage, taken from the session's checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "dqspark-checkpoints")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for intermediate tables."""
    return f"{shared_dir(spark).rstrip('/')}/dqspark/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and continue from the files.

    For small results that several later steps read. This runs a job.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from it.

    For larger results that several later steps read in part: the files keep their columns apart and
    Spark knows their size. This runs a job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables stored for one piece of work, whose files are deleted when it ends: nothing may read them later."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.made = spark, scratch_path(spark, "work"), 0

    def __enter__(self) -> Scratch:
        return self

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """As the function of this name."""
        self.made += 1
        path = f"{self.path}/{name}-{self.made}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
