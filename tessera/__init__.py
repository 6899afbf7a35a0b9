"""One-way mirroring of grouped snapshots, planned and applied with Spark."""

from tessera.operators.mirror import Layout, Snapshot
from tessera.plans.planner import MirrorPlan, plan_mirror

__all__ = ["Layout", "MirrorPlan", "Snapshot", "plan_mirror"]
