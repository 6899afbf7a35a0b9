"""Resolve a request and check it in full before anything is written."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import mirror as M


class MirrorError(ValueError):
    """A request or snapshot that has no defined mirror."""


@dataclass(frozen=True)
class MirrorPlan:
    src: M.Snapshot
    dst: M.Snapshot
    selected: DataFrame

    @property
    def layout(self) -> M.Layout:
        return self.src.layout

    def actions(self) -> DataFrame:
        return M.action_plan(self.src, self.dst, self.selected)

    def stale(self) -> DataFrame:
        return M.stale_entries(self.src, self.dst, self.selected)

    def result(self) -> DataFrame:
        return M.mirrored(self.src, self.dst, self.selected)

    def status(self) -> DataFrame:
        return M.status_report(self.src, self.dst, self.selected)


def request(spark: SparkSession, names: Iterable[str], group: str = "skill") -> DataFrame:
    """Requested names as a relation: repeats count once, names that would leave a root are refused."""
    names = list(dict.fromkeys(names))
    bad = [n for n in names if not n or n in (".", "..") or "/" in n or "\\" in n]
    if bad:
        raise MirrorError(f"not a group name: {bad!r}")
    return spark.createDataFrame([(n,) for n in names], f"`{group}` string")


def plan_mirror(
    src: M.Snapshot,
    dst: M.Snapshot,
    names: Iterable[str] = (),
    *,
    prune_orphans: bool = False,
    check: bool = True,
) -> MirrorPlan:
    """Plan `dst := src` for the named groups, or for every source group when none is named.

    `prune_orphans` also selects destination groups that the source no longer has, which a
    plain run over all groups leaves alone. `check` runs the validations (missing names,
    repeated source keys, kind mismatches) as one small action each, before any write.
    """
    names, g = list(names), src.layout.group
    if names:
        selected = request(src.entries.sparkSession, names, g)
        if check and (absent := [r[0] for r in M.missing_groups(selected, src).limit(20).collect()]):
            raise MirrorError(f"no such group in the source: {sorted(absent)!r}")
    else:
        selected = src.groups.unionByName(dst.groups).distinct() if prune_orphans else src.groups
    plan = MirrorPlan(src, dst, selected)
    if check:
        scope = M.select_groups(src, selected)
        if rows := M.duplicate_keys(scope).limit(5).collect():
            raise MirrorError(f"keys repeat in the source: {[tuple(r)[:-1] for r in rows]!r}")
        if src.layout.is_dir and (rows := M.kind_conflicts(src, dst, selected).limit(5).collect()):
            raise MirrorError(f"a file on one side and a directory on the other: {[tuple(r) for r in rows]!r}")
    return plan
