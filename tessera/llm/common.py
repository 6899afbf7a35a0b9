"""What several of the operators share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.staging import delete_folder, shared_folder

#: White space of all contracts: U+0020 and U+0009 to U+000D.
SPACE = r"[ \t-\r]"
#: Spark states sizes about 2**63 for tables whose size it doesn't know.
UNKNOWN = 1 << 58


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: All folders that `stage` has written and nothing has deleted yet.
_LEFT: dict[str, SparkSession] = {}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, so a lost executor costs a reread."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _LEFT[path] = spark
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def _delete(path: str) -> None:
    spark = _LEFT.pop(path, None)
    if spark is not None and spark.sparkContext._jsc is not None:
        delete_folder(spark, path)


def discard(*staged: DataFrame | None) -> None:
    """Delete what `stage` wrote for these, once nothing that is still to be computed reads it."""
    for df in staged:
        if df is not None and (path := _FOLDERS.pop(df, None)):
            _delete(path)


@contextmanager
def only(*, but: list[DataFrame]) -> Iterator[None]:
    """What is staged inside goes at the end, except for the tables that are in the list `but` by then."""
    before = set(_LEFT)
    try:
        yield
    finally:
        kept = {_FOLDERS.get(df) for df in but}
        for path in set(_LEFT) - before - kept:
            _delete(path)


@atexit.register
def _delete_all() -> None:
    """What the last results were read from goes with the driver's process."""
    with suppress(Exception):
        for path in list(_LEFT):
            _delete(path)


def buckets(docs: DataFrame, bytes_each: int = 24 << 20, each: int = 2) -> int:
    """Parts of a key space: `each` for a shuffle partition, and more where the input has many bytes.

    A bucket is what a task holds in memory, so its size is bounded by the input's size as the
    scan states it, whatever number of shuffle partitions is set.
    """
    spark = docs.sparkSession
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    at_least = each * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(at_least, size // bytes_each if size < UNKNOWN else 0)


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
