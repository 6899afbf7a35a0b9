"""python -m tessera.cli SOURCE DESTINATION [GROUP ...] [--prune-orphans] [--journal FOLDER]"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from tessera.plans.planner import MirrorError
from tessera.session import local_session
from tessera.sinks.tree import mirror_tree


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tessera", description="Mirror grouped file trees one way.")
    p.add_argument("source")
    p.add_argument("destination")
    p.add_argument("groups", nargs="*")
    p.add_argument("--prune-orphans", action="store_true")
    p.add_argument("--journal", help="a folder by which a run that broke off goes on")
    a = p.parse_args(argv)
    if not Path(a.source).is_dir():
        print(f"the source is not a directory: {a.source}", file=sys.stderr)
        return 1
    try:
        status = mirror_tree(local_session(), a.source, a.destination, a.groups, prune_orphans=a.prune_orphans, journal=a.journal)
    except MirrorError as e:
        print(e, file=sys.stderr)
        return 1
    for r in status.orderBy("skill").toLocalIterator():
        print(f"{r.skill}: {r.n_copied} copied, {r.n_pruned} pruned")
    return 0


if __name__ == "__main__":
    sys.exit(main())
