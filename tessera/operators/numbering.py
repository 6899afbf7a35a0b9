"""Numbers of rows within their group, without ever gathering a group.

A window over a group is one task, however large the group. Here rows are sorted over all tasks by
(group, order): a large group lies in several neighbouring partitions. Tasks number the rows of each
run of a group as they stream through; only the first run of a partition can go on from the one
before, so a table of one row for each partition, made of the counts by partition, holds what must
be added.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.staging import Scratch

PART, RUN, FIRST = "_part", "_rn", "_first"


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """Whether each row but the first differs from the one before; nulls are equal."""
    out = np.zeros(len(columns[0]) - 1, bool)
    for c in columns:
        a, b = c.slice(1), c.slice(0, len(c) - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        out |= differ | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    return out


def _runs(groups: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, first = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            keys = [batch.column(g) for g in groups]
            here = [k.slice(0, 1).to_pylist() for k in keys]
            starts = np.concatenate([[last is not None and here != last], _changes(keys)])
            at = np.flatnonzero(starts)
            begin = np.repeat(np.concatenate([[-count], at]), np.diff(np.concatenate([[0], at, [n]])))
            number = np.arange(n) - begin + 1
            upto = int(at[0]) if len(at) else n
            mark = np.zeros(n, bool)
            mark[: upto if first else 0] = True
            first = first and not len(at)
            last, count = [k.slice(n - 1, 1).to_pylist() for k in keys], int(number[-1])
            more = [pa.array(np.full(n, part, np.int32)), pa.array(number.astype(np.int64)), pa.array(mark)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, PART, RUN, FIRST])

    return run


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[Column], scratch: Scratch, name: str = "rn") -> DataFrame:
    """`df` with `name`: 1, 2, ... within each group by `order`; `groups` name columns, nulls are a group.

    The numbered rows are staged in `scratch`, for the counts must be of the same rows. The driver
    reads one row for each partition. Rows that tie in `order` are numbered in any order.
    """
    by = [*map(F.col, groups), *order]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = scratch.stage(ordered.mapInArrow(_runs(groups), f"{fields}, {PART} int, {RUN} bigint, {FIRST} boolean"), "runs")
    key = F.struct(*(F.col(g) for g in groups))
    # A partition's last run is the one with its greatest key; of a single run, that is the first one too.
    edges = rows.groupBy(PART).agg(
        F.min(key).alias("a"), F.max(key).alias("z"), F.max_by(RUN, F.struct(key, F.col(RUN))).alias("n")
    )
    add, group, total = [], None, 0
    for r in edges.orderBy(PART).toLocalIterator():
        goes_on = total and r.a == group
        if goes_on:
            add.append((r[PART], total))
        total = r.n + (total if goes_on and r.a == r.z else 0)
        group = r.z
    number = F.col(RUN)
    if add:
        before = df.sparkSession.createDataFrame(add, f"{PART} int, _before bigint")  # a row for each partition at most
        rows = rows.join(F.broadcast(before), PART, "left")
        number = number + F.when(F.col(FIRST), F.coalesce("_before", F.lit(0))).otherwise(0)
    return rows.select(*df.columns, number.alias(name))
