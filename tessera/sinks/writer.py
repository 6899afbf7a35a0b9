"""Writing entries into a tree with a commit: `df.write.format("tessera_tree")`.

A task writes each file into its own folder of parts inside the target's root (a folder that all tasks
shared would make them wait for each other at every file) and renames it into place, so a file is there
whole or not at all, and a link in its place is replaced. Of a tree to copy from, a file that the target
holds already, byte for byte, stays where it is and gets the source's mode and times: it counts as copied,
but isn't written, for renaming over a file makes some file systems flush it. Its commit message says
what it wrote, and names a Parquet file of receipts (rows by group) in the run's folder.

`commit` runs when every task has ended well. It writes the manifest, the list of receipts of exactly
these tasks; the prune begins only where there is one. `abort` runs otherwise and removes the run's
folder with all parts. Files that were renamed before a failure stay (there is no rollback), and
another run writes them again.

Options: path and run (the name of the run's folder, which exists already); source, a tree to copy
from, for rows without content. Rows: skill, rel_path, is_dir, and optionally content, mode, mtime.
"""

from __future__ import annotations

import json
import os
import shutil
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSourceWriter, WriterCommitMessage

from tessera.sinks.confined import FOLDER, Confined, components, copy_into, write_into

PARTS, RECEIPTS, MANIFEST = "parts", "receipts", "manifest.json"


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: entries count files that were there already, bytes don't."""

    receipts: str
    entries: int
    n_bytes: int


class TreeWriter(DataSourceWriter):
    def __init__(self, options: dict, schema):
        self.root, self.run, self.source = options["path"], options["run"], options.get("source")
        self.columns = set(schema.names)

    def write(self, iterator: Iterator[Row]) -> Written:
        attempt = TaskContext.get().taskAttemptId()
        made: Counter[str] = Counter()
        n_bytes = 0
        with Confined(self.root) as target:
            beside = os.path.join(self.root, self.run, PARTS, str(attempt))
            os.mkdir(beside)
            parts = os.open(beside, FOLDER)
            try:
                for n, r in enumerate(iterator):
                    way = components(r.skill, r.rel_path)
                    made[r.skill] += 1
                    if r.is_dir:
                        target.make_folder(way)
                        continue
                    part = str(n)
                    content = r.content if "content" in self.columns else None
                    if content is not None:
                        at = r.mtime if "mtime" in self.columns else None
                        n_bytes += write_into(bytes(content), r.mode if "mode" in self.columns else None, at and int(at.timestamp() * 10**6) * 1000, parts, part)
                    elif target.holds(way, source := os.path.join(self.source, *way)):
                        continue
                    else:
                        n_bytes += copy_into(source, parts, part)
                    target.place(way, part, parts)
            finally:
                os.close(parts)
        name = f"{RECEIPTS}/{attempt}.parquet"
        pq.write_table(pa.table({"skill": pa.array(list(made), pa.string()), "n_copied": pa.array(list(made.values()), pa.int64())}), os.path.join(self.root, self.run, name))
        return Written(name, sum(made.values()), n_bytes)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        manifest = {"receipts": [m.receipts for m in done], "entries": sum(m.entries for m in done), "bytes": sum(m.n_bytes for m in done)}
        beside = Path(self.root, self.run, f"{MANIFEST}.new")
        beside.write_text(json.dumps(manifest))
        os.replace(beside, beside.with_name(MANIFEST))

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(os.path.join(self.root, self.run), ignore_errors=True)
