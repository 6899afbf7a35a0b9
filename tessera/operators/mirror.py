"""Relational form of a mirror run.

A snapshot is two relations: the groups that exist, and the entries they hold. They
are apart because a group may exist with no entries, and mirroring it then empties
the destination group. Everything here is a lazy DataFrame expression; joins on
(group, key) carry no payload columns unless the result needs them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.paths import components
from tessera.operators.numbering import numbered
from tessera.staging import Scratch


@dataclass(frozen=True)
class Layout:
    """Names of the group column, key columns and, where entries have kinds, the directory flag."""

    group: str = "skill"
    keys: tuple[str, ...] = ("rel_path",)
    is_dir: str | None = None
    path_keys: bool = False

    @property
    def on(self) -> list[str]:
        return [self.group, *self.keys]


@dataclass(frozen=True)
class Snapshot:
    entries: DataFrame
    groups: DataFrame
    layout: Layout = field(default_factory=Layout)

    @staticmethod
    def of(entries: DataFrame, layout: Layout, groups: DataFrame | None = None) -> Snapshot:
        """Without a groups relation, the groups are those that have entries."""
        found = groups if groups is not None else entries.select(layout.group)
        return Snapshot(entries, found.select(layout.group).distinct(), layout)

    def keys(self) -> DataFrame:
        return self.entries.select(*self.layout.on)


def select_groups(snapshot: Snapshot, selected: DataFrame) -> Snapshot:
    """The snapshot restricted to some groups."""
    g = snapshot.layout.group
    return Snapshot(
        snapshot.entries.join(selected, g, "left_semi"), snapshot.groups.join(selected, g, "left_semi"), snapshot.layout
    )


def ordered_groups(snapshot: Snapshot) -> DataFrame:
    """Group names by code point, the order in which a run reports them."""
    return snapshot.groups.orderBy(snapshot.layout.group)


def missing_groups(requested: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Requested names that the source does not have."""
    return requested.distinct().join(snapshot.groups, snapshot.layout.group, "left_anti")


def stale_entries(src: Snapshot, dst: Snapshot, selected: DataFrame) -> DataFrame:
    """Destination keys inside selected groups that the source lacks."""
    lay = src.layout
    cols = lay.on + ([lay.is_dir] if lay.is_dir else [])
    return dst.entries.select(*cols).join(selected, lay.group, "left_semi").join(src.keys(), lay.on, "left_anti")


def kept_outside(dst: Snapshot, selected: DataFrame) -> DataFrame:
    """Destination entries of the groups that the run leaves alone."""
    return dst.entries.join(selected, dst.layout.group, "left_anti")


def copy_phase(src: Snapshot, dst: Snapshot) -> DataFrame:
    """What the destination holds between copying and pruning: source, plus what it doesn't overwrite."""
    return src.entries.unionByName(dst.entries.join(src.keys(), src.layout.on, "left_anti"))


def mirrored(src: Snapshot, dst: Snapshot, selected: DataFrame) -> DataFrame:
    """The destination after the run. It never reads the destination's selected groups."""
    return src.entries.join(selected, src.layout.group, "left_semi").unionByName(kept_outside(dst, selected))


def _delete_key(layout: Layout) -> list[Column]:
    """Descending order; paths go component by component, so children come before parents."""
    return [components(F.col(k)).desc() if layout.path_keys else F.col(k).desc() for k in layout.keys]


def prune_order(stale: DataFrame, layout: Layout, scratch: Scratch | None = None) -> DataFrame:
    """Stale keys numbered in the order of deletion within their group, however many tasks a group takes."""
    return numbered(stale, [layout.group], _delete_key(layout), scratch or Scratch(stale.sparkSession, "prune-order"))


def sorted_for_deletion(stale: DataFrame, layout: Layout) -> DataFrame:
    """Stale keys dealt evenly by key; each partition in deletion order, so that neighbours share their folders."""
    return stale.repartition(*layout.on).sortWithinPartitions(layout.group, *_delete_key(layout))


def action_plan(src: Snapshot, dst: Snapshot, selected: DataFrame) -> DataFrame:
    """One row per key on either side: insert, overwrite, delete or keep_orphan."""
    lay = src.layout
    side = lambda s, n: s.keys().withColumn(n, F.lit(True))
    joined = side(src, "_in_src").join(side(dst, "_in_dst"), lay.on, "full_outer")
    flagged = joined.join(selected.withColumn("_selected", F.lit(True)), lay.group, "left")
    action = (
        F.when(F.col("_selected").isNull(), "keep_orphan")
        .when(F.col("_in_src").isNull(), "delete")
        .when(F.col("_in_dst").isNull(), "insert")
        .otherwise("overwrite")
    )
    return flagged.select(*lay.on, action.alias("action"))


def status_report(src: Snapshot, dst: Snapshot, selected: DataFrame) -> DataFrame:
    """Rows copied and pruned for each selected group, empty ones included."""
    g = src.layout.group
    copied = src.entries.join(selected, g, "left_semi").select(g, F.lit(1).alias("c"), F.lit(0).alias("p"))
    pruned = stale_entries(src, dst, selected).select(g, F.lit(0).alias("c"), F.lit(1).alias("p"))
    none = selected.select(g, F.lit(0).alias("c"), F.lit(0).alias("p"))
    counts = reduce(DataFrame.unionByName, [none, copied, pruned])
    return counts.groupBy(g).agg(F.sum("c").alias("n_copied"), F.sum("p").alias("n_pruned"))


def duplicate_keys(snapshot: Snapshot) -> DataFrame:
    """Keys held more than once; an upsert from such a source has no defined result."""
    return snapshot.keys().groupBy(*snapshot.layout.on).count().where("count > 1")


def kind_conflicts(src: Snapshot, dst: Snapshot, selected: DataFrame) -> DataFrame:
    """Keys that are a directory on one side and a file on the other."""
    lay = src.layout
    if not lay.is_dir:
        return src.keys().limit(0)
    s = src.entries.join(selected, lay.group, "left_semi").select(*lay.on, F.col(lay.is_dir).alias("_s"))
    d = dst.entries.select(*lay.on, F.col(lay.is_dir).alias("_d"))
    return s.join(d, lay.on).where("_s <> _d").select(*lay.on)
