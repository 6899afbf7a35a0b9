"""Going on after a failure: what a run has listed and which of its groups are finished, kept beside it.

A run with a journal works through its groups in batches, dealt by a hash of the name so that each
has about as many entries. The journal holds the request, both listings as they were at the start,
and for each finished batch a table with a row for each of its groups. A run that is started again
with the same request reads the listings instead of taking them, and skips the finished batches, so
what was planned once is what is done. The journal goes when the run has ended.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.planner import MirrorError
from tessera.sources.inventory import Inventory, inventory_of
from tessera.staging import delete_folder

STATUS = "skill string, n_copied bigint, n_pruned bigint"


class Journal:
    def __init__(self, spark: SparkSession, path: str, request: dict):
        self.spark, self.path, self.request = spark, path.rstrip("/"), json.dumps(request, sort_keys=True)

    def _complete(self, name: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _listing(self, name: str) -> Inventory:
        return inventory_of(self.spark.read.parquet(f"{self.path}/{name}"))

    def begin(self, take: Callable[[], tuple[Inventory, Inventory]]) -> tuple[Inventory, Inventory]:
        """The listings of source and destination, those of the run that broke off if there was one."""
        if self._complete("request"):
            if self.spark.read.text(f"{self.path}/request").first()[0] != self.request:
                raise MirrorError(f"the journal is of another request: {self.path}")
        else:
            for name, found in zip(("source", "target"), take(), strict=True):
                found.rows.write.mode("overwrite").parquet(f"{self.path}/{name}")
            self.spark.createDataFrame([(self.request,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/request")
        return self._listing("source"), self._listing("target")

    def finished(self, batch: int) -> DataFrame | None:
        """What was done for the groups of a finished batch."""
        return self.spark.read.schema(STATUS).parquet(f"{self.path}/done-{batch}") if self._complete(f"done-{batch}") else None

    def finish(self, batch: int, status: DataFrame) -> DataFrame:
        status.write.mode("overwrite").parquet(f"{self.path}/done-{batch}")
        return self.finished(batch)

    def close(self) -> None:
        delete_folder(self.spark, self.path)
