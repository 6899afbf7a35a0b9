"""Tables that end lineage: written to the folder that driver and executors share, and read back.

A lost executor then costs a reread, not the work before it. A `Scratch` holds the tables of one
run in a folder of its own; it goes as a whole when the run has ended, and what is left of it when
the driver's process ends.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session may go without one and gets its own (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
        named = spark.sparkContext.getCheckpointDir()
    return named


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark knows; one that is gone is no error."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def tasks_for(spark: SparkSession, rows: int, at_least: int, at_most: int) -> int:
    """Tasks for so many rows: all cores if each then has `at_least` rows, and more where a task would have over `at_most`."""
    return max(1, min(spark.sparkContext.defaultParallelism, -(-rows // at_least)), -(-rows // at_most))


class Scratch:
    """Staged tables of one run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.n = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", 0
        atexit.register(self.drop)

    def folder(self, name: str) -> str:
        """A folder of this run, for a table or a tree of its own."""
        self.n += 1
        return f"{self.path}/{self.n:02d}-{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete all tables; nothing that is still to be computed may read them."""
        atexit.unregister(self.drop)
        if self.n and self.spark.sparkContext._jsc is not None and self.spark.sparkContext._jsc.sc().isStopped() is False:
            delete_folder(self.spark, self.path)
        self.n = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()
