"""Apply a plan to a file tree that all executors share.

One run: list the source and the destination once, check the whole request, copy with a commit,
list the destination again, and delete what the source's listing lacks. Every step may run twice
without harm, since Spark may retry a task: files are written beside their place and renamed over
it, and deleting what is gone already is no error. Nothing is written, deleted or changed through a
link, also not one that appears meanwhile: every place below the root is reached by handles.

Deletion goes by depth, deepest first, since a folder must be empty before it goes. Each depth is a
stage of its own, so one deep tree spreads over all tasks. Copies and deletions are dealt by ranges of
paths of even size, as many as `tasks_for` says whatever the bytes of the rows: a task works through
neighbours, whose folders it keeps open, and in folders where few other tasks do.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import replace
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import paths
from tessera.operators.mirror import Snapshot, sorted_for_deletion, stale_entries
from tessera.plans.planner import MirrorError, MirrorPlan, plan_mirror
from tessera.sinks.confined import Confined, components
from tessera.sinks.journal import Journal
from tessera.sinks.writer import MANIFEST, PARTS, RECEIPTS
from tessera.sources.inventory import Inventory, take_inventory
from tessera.sources.tree import TREE, register, require_sound
from tessera.sources.walk import WORK
from tessera.staging import Scratch, tasks_for

#: Entries on both sides, about, of the groups that a run with a journal works through at once.
BATCH = 1_000_000
#: Entries for a task to copy or delete, at least and at most.
FEW, MANY = 16, 8192
REMOVED = "skill string, n_pruned bigint, left string"


def depth(path: Column) -> Column:
    return F.size(paths.components(path))


def _delete(dst: str):
    """Rows (skill, rel_path) to what was removed by group, and a row for each folder that wasn't empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        removed: Counter[str] = Counter()
        left: list[tuple[str, str]] = []
        with Confined(dst) as target:
            for batch in batches:
                for group, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if target.delete(components(group, path)):
                        removed[group] += 1
                    else:  # something has come since the listing: it is reported, not deleted
                        left.append((group, path))
        rows = [(g, n, None) for g, n in removed.items()] + [(g, 0, path) for g, path in left]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], ["skill", "n_pruned", "left"])

    return run


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """`n` rows (skill, rel_path) dealt by ranges of paths, each in order."""
    parts = tasks_for(rows.sparkSession, n, FEW, MANY)
    return rows.repartitionByRange(parts, "skill", "rel_path").sortWithinPartitions("skill", "rel_path")


def delete_by_depth(doomed: DataFrame, dst: str, scratch: Scratch) -> DataFrame:
    """Delete `doomed` (skill, rel_path), one stage for each depth; skill, n_pruned, left as staged rows of the tasks."""
    doomed = scratch.stage(doomed.select("skill", "rel_path", depth(F.col("rel_path")).alias("depth")), "doomed")
    done = doomed.limit(0).select("skill", F.lit(0).cast("bigint").alias("n_pruned"), F.lit("").alias("left"))
    for level, n in sorted(doomed.groupBy("depth").count().collect(), reverse=True):  # a row for each depth
        wave = doomed.where(F.col("depth") == level).select("skill", "rel_path")
        done = done.unionByName(scratch.stage(dealt(wave, n).mapInArrow(_delete(dst), REMOVED), f"removed-{level}"))
    return done


def _unlink(dst: str):
    """Links go before anything is written, folders take the place of those that were groups."""

    def run(rows: Iterable) -> None:
        with Confined(dst) as target:
            for r in rows:
                target.delete(components(r.skill, r.rel_path))

    return run


def _make(dst: str):
    def run(rows: Iterable) -> None:
        with Confined(dst) as target:
            for (name,) in rows:
                target.make_folder(components(name, ""))

    return run


def _like_source(src: str, dst: str):
    """Mode and times of folders, which writing and deleting inside them has changed."""

    def run(rows: Iterable) -> None:
        with Confined(dst) as target:
            for r in rows:
                way = components(r.skill, r.rel_path)
                source = Path(src, *way)
                if source.is_dir():
                    target.like(way, source.stat())

    return run


def copy_entries(entries: DataFrame, src: str, dst: str, run: str) -> DataFrame:
    """Write `entries` of the tree `src` into `dst`; skill, n_copied."""
    rows = entries.select("skill", "rel_path", "is_dir")
    return committed(dealt(rows, rows.count()), dst, run, src)


def committed(rows: DataFrame, dst: str, run: str, source: str | None = None) -> DataFrame:
    """Write rows (skill, rel_path, is_dir, and content or a source tree) into `dst`; skill, n_copied as the tasks that counted have reported."""
    rows.write.format("tessera_tree").options(path=dst, run=run, **({"source": source} if source else {})).mode("append").save()
    manifest = Path(dst, run, MANIFEST)
    if not manifest.exists():
        raise MirrorError("the copy has no commit: nothing is deleted")
    receipts = [f"file:{Path(dst, run, name).absolute()}" for name in json.loads(manifest.read_text())["receipts"]]  # one for each task
    spark = rows.sparkSession
    return spark.read.schema("skill string, n_copied bigint").parquet(*receipts) if receipts else spark.createDataFrame([], "skill string, n_copied bigint")


def begun(dst: str) -> tuple[str, str]:
    """The target's root, made if missing, and the name of a new run's folder in it."""
    Path(dst).mkdir(parents=True, exist_ok=True)
    dst, run = os.path.realpath(dst), f"{WORK}{uuid.uuid4().hex}"
    for name in (PARTS, RECEIPTS):
        Path(dst, run, name).mkdir(parents=True)
    return dst, run


def write_tree(rows: DataFrame, dst: str, groups: Iterable[str] = ()) -> None:
    """Write rows (skill, rel_path, is_dir, content, optionally mode and mtime) as a tree; `groups` exist even if they hold nothing."""
    register(rows.sparkSession)
    dst, run = begun(dst)
    try:
        committed(rows, dst, run)
        _make(dst)((g,) for g in groups)
    finally:
        shutil.rmtree(os.path.join(dst, run), ignore_errors=True)


def apply_to_tree(plan: MirrorPlan, src: str, dst: str, scratch: Scratch, target: Inventory | None = None) -> DataFrame:
    """Copy, list the destination again, delete; what was done for each selected group."""
    spark = plan.src.entries.sparkSession
    dst, run = begun(dst)
    try:
        links = plan.dst.entries.where("kind = 'link'").select("skill", "rel_path")
        if target:
            links = links.unionByName(target.blocked().where("kind = 'link'").select("skill", F.lit("").alias("rel_path")))
        links.join(plan.selected, "skill", "left_semi").foreachPartition(_unlink(dst))
        plan.selected.select("skill").foreachPartition(_make(dst))
        scope = plan.src.entries.join(plan.selected, "skill", "left_semi")
        copied = scratch.stage(copy_entries(scope, src, dst, run), "copied")
        after = take_inventory(spark, dst, None, scratch, follow=False, name="after", groups=plan.selected)
        stale = stale_entries(plan.src, after.snapshot, plan.selected)
        removed = delete_by_depth(sorted_for_deletion(stale, plan.layout), dst, scratch)
        folders = scope.where("is_dir").select("skill", "rel_path").unionByName(plan.selected.select("skill", F.lit("").alias("rel_path")))
        folders = scratch.stage(folders.withColumn("depth", F.when(F.col("rel_path") == "", 0).otherwise(depth(F.col("rel_path")))), "folders")
        for level in range(folders.agg(F.max("depth")).first()[0] or 0, -1, -1):  # a folder may shut its children off
            folders.where(F.col("depth") == level).repartition("skill", "rel_path").foreachPartition(_like_source(src, dst))
        if left := removed.where("left IS NOT NULL").select("skill", "left").limit(5).collect():
            raise MirrorError(f"came into the destination during the prune; run again: {[tuple(r) for r in left]!r}")
        return Scratch(spark, "mirror-status").stage(status_of(plan.selected, copied, removed), "status")
    finally:
        shutil.rmtree(os.path.join(dst, run), ignore_errors=True)


def status_of(selected: DataFrame, copied: DataFrame, removed: DataFrame) -> DataFrame:
    """skill, n_copied, n_pruned: what the tasks did, groups without anything to do included."""
    no = F.lit(0).cast("bigint")
    counts = selected.select("skill", no.alias("n_copied"), no.alias("n_pruned"))
    counts = counts.unionByName(copied.select("skill", "n_copied", no.alias("n_pruned"))).unionByName(removed.select("skill", no.alias("n_copied"), "n_pruned"))
    return counts.groupBy("skill").agg(F.sum("n_copied").alias("n_copied"), F.sum("n_pruned").alias("n_pruned"))


def mirror_tree(spark: SparkSession, src: str, dst: str, names: Iterable[str] = (), *, prune_orphans: bool = False, journal: str | None = None, batch_entries: int = BATCH) -> DataFrame:
    """Mirror the groups below `src` into `dst`; the whole request is checked before the first write.

    A source that isn't a directory is an error, never an empty snapshot: with `prune_orphans`
    that would empty the destination. The result, a table in the shared folder, says what was done.
    With `journal`, a folder, the groups are worked through in batches of about `batch_entries`, and
    a run that broke off goes on where it was when it is started again.
    """
    if not Path(src).is_dir():
        raise MirrorError(f"the source is not a directory: {src}")
    register(spark)
    names, src, dst = list(dict.fromkeys(names)), os.path.realpath(src), os.path.realpath(dst)
    with Scratch(spark, "mirror") as scratch:
        take = lambda: (
            take_inventory(spark, src, names or None, scratch, name="source"),
            take_inventory(spark, dst, names or None, scratch, follow=False, name="target"),
        )
        log = Journal(spark, journal, {"src": src, "dst": dst, "names": names, "prune_orphans": prune_orphans, "batch_entries": batch_entries}) if journal else None
        source, target = log.begin(take) if log else take()
        plan = plan_mirror(source.snapshot, target.snapshot, names, prune_orphans=prune_orphans)
        require_sound(plan.src.entries)
        if rows := target.blocked().where("kind = 'file'").join(plan.selected, "skill", "left_semi").limit(5).collect():
            raise MirrorError(f"a file is in the place of a group's folder: {[r.skill for r in rows]!r}")
        if log is None:
            return apply_to_tree(plan, src, dst, scratch, target)
        batches = 1 + (plan.src.entries.count() + plan.dst.entries.count()) // batch_entries
        done = []
        for i in range(batches):
            if (status := log.finished(i)) is None:
                some = plan.selected.where(F.pmod(F.xxhash64("skill"), F.lit(batches)) == i)
                status = log.finish(i, apply_to_tree(replace(plan, selected=some), src, dst, scratch, target))
            done.append(status)
        out = Scratch(spark, "mirror-status").stage(reduce(DataFrame.unionByName, done), "status")
        log.close()
        return out


__all__ = ["TREE", "Snapshot", "apply_to_tree", "mirror_tree"]
