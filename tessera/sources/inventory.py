"""The listing of a tree that a run works by: made once, by many tasks, and kept in the shared folder.

The folders still to be listed are a relation, the frontier. Each round deals it to all cores, and to
more tasks where there are many folders; a task walks down from each of its folders until it has met `BUDGET` entries and hands
the folders beyond back as the next frontier. So a small tree takes a round or two, and a group that
is most of a large tree spreads over all tasks as soon as its upper folders are known. No folder is
listed twice, and every later step of the run joins the same rows: what comes into the tree in the
meantime is in no step's input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.mirror import Snapshot
from tessera.sources.tree import TREE
from tessera.sources.walk import Found, list_root, walk
from tessera.staging import Scratch, tasks_for

#: Entries that a task meets below one folder before it hands folders on, and folders of the frontier for a task at most.
BUDGET, FOLDERS_A_TASK = 512, 32
ROWS = "skill string, rel_path string, is_dir boolean, kind string, mode int, mtime timestamp, size bigint, task int"
TYPES = pa.schema([("skill", pa.string()), ("rel_path", pa.string()), ("is_dir", pa.bool_()), ("kind", pa.string()), ("mode", pa.int32()), ("mtime", pa.timestamp("us", "UTC")), ("size", pa.int64()), ("task", pa.int32())])
AT_ONCE = 10_000


@dataclass(frozen=True)
class Inventory:
    """`rows`: all rounds as staged, with a column `round`; `snapshot`: entries and groups as the planner takes them."""

    rows: DataFrame
    snapshot: Snapshot

    def blocked(self) -> DataFrame:
        """skill, kind: links and files where a destination's group would have its folder."""
        return self.rows.where("rel_path = '' AND kind IN ('link', 'file')").select("skill", "kind")

    def listed(self) -> DataFrame:
        """skill, rel_path, size, round, task: the folders that were listed, and by which task."""
        return self.rows.where("kind = 'listed'").select("skill", "rel_path", "size", "round", "task")


def _batches(rows: Iterator[Found]) -> Iterator[pa.RecordBatch]:
    part, task = [], TaskContext.get().partitionId()
    for row in rows:
        part.append((*row, task))
        if len(part) == AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), TYPES.types, strict=True)], schema=TYPES)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), TYPES.types, strict=True)], schema=TYPES)


def _round(root: str, names: list[str] | None, follow: bool, budget: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[Found]:
        for batch in batches:
            for group, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if group is not None:
                    yield from walk(root, group, folder, follow, budget)
                    continue
                for top in list_root(root, names, follow):
                    yield top
                    if top.kind == "group":
                        yield Found(top.skill, "", True, "open")

    return lambda batches: _batches(found(batches))


def inventory_of(rows: DataFrame) -> Inventory:
    groups = rows.where("rel_path = '' AND kind IN ('group', 'link')").select("skill")
    entries = rows.where("kind NOT IN ('open', 'listed', 'group') AND rel_path <> ''").drop("task", "round")
    return Inventory(rows, Snapshot(entries, groups, TREE))


def take_inventory(spark: SparkSession, root: str, names: list[str] | None, scratch: Scratch, *, follow: bool = True, budget: int = BUDGET, name: str = "inventory", groups: DataFrame | None = None) -> Inventory:
    """List the named groups below `root`, or all; a destination is listed with `follow=False`.

    With `groups` (skill), whose folders are known to be there, the root itself isn't listed.
    """
    frontier = groups.select("skill", F.lit("").alias("rel_path")) if groups is not None else spark.createDataFrame([(None, "")], "skill string, rel_path string")
    rounds, left = [], frontier.count() if groups is not None else 1
    while left or not rounds:
        parts = tasks_for(spark, left, 1, FOLDERS_A_TASK)
        dealt = frontier.repartition(parts) if parts > 1 else frontier.coalesce(1)
        rows = scratch.stage(dealt.mapInArrow(_round(str(root), names, follow, budget), ROWS), f"{name}-{len(rounds)}")
        rounds.append(rows.withColumn("round", F.lit(len(rounds))))
        frontier = rows.where("kind = 'open'").select("skill", "rel_path")
        left = frontier.count()
    every = rounds[0]
    for rows in rounds[1:]:
        every = every.unionByName(rows)
    return inventory_of(every)
