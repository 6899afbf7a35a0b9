"""Apply a plan to a Parquet table partitioned by group, with a catalogue of its groups.

A group may exist and hold nothing, which a partitioned table can't say: a partition without rows is
no partition. So the table has a relation of groups beside its data, `_groups`, which readers of the
data don't see (Spark skips names that begin with an underscore). Each run writes its next version:
group, the number of its rows, and the run that wrote it.

The steps of a run, in order: data, by a dynamic partition overwrite, which replaces exactly the
partitions that have rows and leaves unselected groups alone; the catalogue, whose version counts
once its `_SUCCESS` is there; then the folders of selected groups that have become empty, which
tasks delete. A run that breaks off before the catalogue's version is repeated by the next one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.mirror import Layout, Snapshot
from tessera.plans.planner import MirrorError, MirrorPlan, plan_mirror
from tessera.staging import Scratch, delete_folder

GROUPS, KEPT = "_groups", 2
#: The characters that Spark writes as % and two hex digits in the name of a partition's folder.
ESCAPED = "".join(map(chr, range(1, 32))) + "\"#%'*/:=?\\{[]^\x7f"


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The catalogue's complete versions, oldest first; their number is bounded, old ones are deleted."""
    at, fs = _fs(spark, f"{path}/{GROUPS}")
    if not fs.exists(at):
        return []
    found = [s.getPath() for s in fs.listStatus(at)]
    done = lambda p: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return sorted(int(p.getName().removeprefix("v")) for p in found if p.getName().startswith("v") and done(p))


def read_groups(spark: SparkSession, path: str, group: str, kind: str = "string") -> DataFrame:
    """group, n_rows, run: the groups of the table, empty ones included. No catalogue, no rows."""
    schema = f"`{group}` {kind}, n_rows bigint, run string"
    known = versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/{GROUPS}/v{known[-1]}") if known else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def table_snapshot(spark: SparkSession, path: str, schema: str, layout: Layout) -> Snapshot:
    """The table as a snapshot: groups are those of the catalogue and those that have rows."""
    entries = read_table(spark, path, schema)
    catalogued = read_groups(spark, path, layout.group, entries.schema[layout.group].dataType.simpleString())
    return Snapshot.of(entries, layout, catalogued.select(layout.group).unionByName(entries.select(layout.group)))


def _write_groups(spark: SparkSession, path: str, groups: DataFrame) -> None:
    known = versions(spark, path)
    groups.write.mode("overwrite").parquet(f"{path}/{GROUPS}/v{(known or [0])[-1] + 1}")
    for old in known[: -KEPT + 1 or None]:
        delete_folder(spark, f"{path}/{GROUPS}/v{old}")


def folder_of(group: str) -> Column:
    """The name of a group's folder, as Spark writes it."""
    value = F.col(group).cast("string")
    safe = F.transform(F.split(value, ""), lambda c: F.when((c != "") & F.contains(F.lit(ESCAPED), c), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.concat(F.lit(f"{group}="), F.when(value.isNull() | (value == ""), "__HIVE_DEFAULT_PARTITION__").otherwise(F.array_join(safe, "")))


def _remove(uri: str):
    """Folders below `uri`, removed by tasks; one that is gone is no error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                at = f"{base.rstrip('/')}/{name}"
                if files.get_file_info(at).type == pafs.FileType.Directory:
                    files.delete_dir(at)
            yield batch

    return run


def _delete_folders(folders: DataFrame, path: str) -> None:
    at, fs = _fs(folders.sparkSession, path)
    uri = re.sub("^file:/*", "file:///", fs.makeQualified(at).toString())
    try:
        pafs.FileSystem.from_uri(uri)
    except pa.ArrowInvalid:  # a store that only Spark opens: the driver asks it, name by name
        for r in folders.toLocalIterator():
            delete_folder(folders.sparkSession, f"{path}/{r[0]}")
        return
    folders.mapInArrow(_remove(uri), "folder string").write.format("noop").mode("append").save()


def apply_to_table(plan: MirrorPlan, path: str) -> DataFrame:
    """Write the selected groups and the catalogue; the groups' numbers of rows copied and pruned, as a staged table."""
    spark, g, run = plan.src.entries.sparkSession, plan.layout.group, uuid.uuid4().hex
    with Scratch(spark, "mirror-table") as scratch:
        # The target is read before anything is written, its catalogue too.
        before = scratch.stage(plan.status().drop("n_copied"), "planned")
        selected = scratch.stage(plan.selected.select(g), "selected")
        kind = selected.schema[g].dataType.simpleString()
        catalogued = read_groups(spark, path, g, kind)
        unknown = plan.dst.groups.join(catalogued, g, "left_anti").select(g, F.lit(None).cast("bigint").alias("n_rows"), F.lit(None).cast("string").alias("run"))
        other = scratch.stage(catalogued.unionByName(unknown).join(selected, g, "left_anti"), "other-groups")
        rows = plan.src.entries.join(selected, g, "left_semi")
        (
            rows.repartition(F.col(g), F.xxhash64(*plan.layout.keys) % 16)  # one group may be most of the table
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(g)
            .parquet(path)
        )
        # What is there now of what was written: the partitions' values and numbers of rows alone are read.
        present = scratch.stage(rows.select(g).distinct(), "present")
        written = present.limit(0) if present.isEmpty() else spark.read.schema(f"`{g}` {kind}").parquet(path)
        counts = written.join(present, g, "left_semi").groupBy(g).count()
        done = scratch.stage(before.join(counts, g, "left").select(g, F.coalesce("count", F.lit(0)).alias("n_copied"), "n_pruned"), "done")
        kept = done.join(plan.src.groups, g, "left_semi").select(g, F.col("n_copied").alias("n_rows"), F.lit(run).alias("run"))
        _write_groups(spark, path, kept.unionByName(other))
        _delete_folders(done.where("n_copied = 0").select(folder_of(g).alias("folder")), path)
        return Scratch(spark, "mirror-status").stage(done, "status")


def mirror_table(source: Snapshot, path: str, schema: str, names: Iterable[str] = (), *, prune_orphans: bool = False) -> DataFrame:
    """Mirror a snapshot into the table at `path` (made if missing); what was done for each selected group."""
    spark = source.entries.sparkSession
    at, fs = _fs(spark, path)
    if fs.exists(at) and not fs.getFileStatus(at).isDirectory():
        raise MirrorError(f"not a table: {path}")
    fs.mkdirs(at)
    return apply_to_table(plan_mirror(source, table_snapshot(spark, path, schema, source.layout), list(names), prune_orphans=prune_orphans), path)
