"""A file tree as a Spark relation: `spark.read.format("tessera_tree")`, and as a target of `df.write`.

Spark's binaryFile source skips hidden names and lists no directories, and a mirror needs
both. Partitions are sets of folders, not groups: planning lists folders from the top until there
are enough of them to deal, and keeps what it has listed, so that no folder is listed twice.
Links are followed, and a link that leads nowhere is reported as kind 'dangling'.

Filters on `skill` (equal, in) and on the beginning of `rel_path` are pushed down: groups and
folders that can't match aren't listed. `register` turns pushdown on for the session, which Spark
wants for a source that has it.

Options: path (required), groups (JSON list), relation ('entries' or 'groups'),
content ('true' reads file bytes too), follow ('false' lists a link as kind 'link' and stops there).
For writing see `tessera.sinks.writer`.
"""

from __future__ import annotations

import json
import os
from collections import deque
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from tessera.operators.mirror import Layout, Snapshot
from tessera.plans.planner import MirrorError
from tessera.sources.walk import Found, list_root, walk

TREE = Layout(group="skill", keys=("rel_path",), is_dir="is_dir", path_keys=True)
ENTRIES = "skill string, rel_path string, is_dir boolean, kind string, mode int, mtime timestamp, size bigint, content binary"
#: Planning deals at least so many folders, if there are so many, and lists at most so many entries for that.
PARTS, PLANNED = 64, 4096


class Folders(InputPartition):
    """Folders to be walked, and rows that planning has listed already."""

    def __init__(self, folders: list[tuple[str, str]], rows: list[Found]):
        super().__init__(None)
        self.folders, self.rows = folders, rows


class TreeDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tessera_tree"

    def schema(self) -> str:
        return "skill string" if self.options.get("relation") == "groups" else ENTRIES

    def reader(self, schema) -> DataSourceReader:
        return TreeReader(dict(self.options))

    def writer(self, schema, overwrite: bool):
        from tessera.sinks.writer import TreeWriter

        return TreeWriter(dict(self.options), schema)


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.wanted = json.loads(options["groups"]) if options.get("groups") else None
        self.relation = options.get("relation", "entries")
        self.content = options.get("content", "false").lower() == "true"
        self.follow = options.get("follow", "true").lower() == "true"
        self.prefix = ""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("skill",):
                names = [f.value] if isinstance(f, EqualTo) else list(f.value)
                self.wanted = [n for n in names if n is not None and (self.wanted is None or n in self.wanted)]
            elif isinstance(f, StringStartsWith) and f.attribute == ("rel_path",) and (f.value.startswith(self.prefix) or self.prefix.startswith(f.value)):
                self.prefix = max(self.prefix, f.value, key=len)
            else:
                yield f

    def partitions(self):
        found = [f for f in list_root(self.root, self.wanted, self.follow) if f.kind == "group"]
        if self.relation == "groups":
            return [Folders([], found)]
        # The uppermost folders are listed here until enough are left to deal.
        left, rows = deque((f.skill, "") for f in found), []
        while left and len(left) < PARTS and len(rows) < PLANNED:
            group, folder = left.popleft()
            for f in walk(self.root, group, folder, self.follow, 0, self.prefix):
                if f.kind == "open":
                    left.append((group, f.rel_path))
                elif f.kind != "listed":
                    rows.append(f)
        parts = min(len(left), max(PARTS, -(-len(left) // PARTS)))
        return [Folders(list(left)[i::parts], rows[i::parts]) for i in range(parts)] or [Folders([], rows)]

    def read(self, partition):
        for f in partition.rows:
            yield (f.skill,) if self.relation == "groups" else self.row(f)
        for group, folder in partition.folders:
            for f in walk(self.root, group, folder, self.follow, 1 << 62, self.prefix):
                if f.kind != "listed":
                    yield self.row(f)

    def row(self, f: Found) -> tuple:
        data = Path(self.root, f.skill, f.rel_path).read_bytes() if self.content and f.kind == "file" else None
        return (*f, data)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TreeDataSource)


def read_tree(spark: SparkSession, path: str, names: list[str] | None = None, *, content: bool = False, follow: bool = True) -> Snapshot:
    """A tree as a snapshot with its groups relation, empty groups included.

    With `follow=False` links are entries of kind 'link', and nothing behind them is part of the tree;
    a group that is a link itself is left out.
    """
    register(spark)
    reader = lambda relation: spark.read.format("tessera_tree").options(
        path=os.fspath(path), relation=relation, content=str(content).lower(), follow=str(follow).lower(), **({"groups": json.dumps(names)} if names is not None else {})
    ).load()
    return Snapshot(reader("entries"), reader("groups"), TREE)


def require_sound(entries: DataFrame) -> None:
    """Links that lead nowhere have no content to mirror."""
    if rows := entries.where("kind = 'dangling'").select("skill", "rel_path").limit(5).collect():
        raise MirrorError(f"links that lead nowhere: {[tuple(r) for r in rows]!r}")
