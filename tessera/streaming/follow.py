"""Keep a table mirrored while a stream names the groups that changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from tessera.operators.mirror import Snapshot
from tessera.plans.planner import MirrorPlan
from tessera.sinks.table import apply_to_table


def follow(changes: DataFrame, source: Callable[[], Snapshot], target: Callable[[], Snapshot], path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of changed group names re-mirrors those groups, once each.

    A replayed batch writes the same partitions again, so the sink is idempotent. Names that
    the source does not have are left alone, as in a run over all groups.
    """

    def one_batch(batch: DataFrame, _: int) -> None:
        src, dst = source(), target()
        g = src.layout.group
        apply_to_table(MirrorPlan(src, dst, src.groups.join(batch.select(g).distinct(), g, "left_semi")), path)

    return changes.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
