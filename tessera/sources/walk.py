"""Listing folders, by a budget: what it doesn't reach is handed on, for other tasks to list.

A source is walked by paths, links followed; a link to a folder above it is listed and not entered.
A destination is walked by handles and never through a link: a link is an entry of its own kind.
"""

from __future__ import annotations

import os
import stat
from collections import deque
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import NamedTuple

from tessera.sinks.confined import NO_FOLDER, Confined

#: Folders directly below a root that hold what a run is writing; they are no groups.
WORK = ".tessera-"


class Found(NamedTuple):
    """An entry; of kinds beside file, dir, link and dangling: `group` (a group's folder), `open` (a folder still to be
    listed) and `listed` (a folder that was, with the number of its entries as size)."""

    skill: str
    rel_path: str
    is_dir: bool | None
    kind: str
    mode: int | None = None
    mtime: datetime | None = None
    size: int | None = None


def _entry(group: str, path: str, st: os.stat_result, kind: str) -> Found:
    is_dir = kind in ("dir", "group")
    return Found(group, path, is_dir, kind, stat.S_IMODE(st.st_mode), datetime.fromtimestamp(st.st_mtime, UTC), None if is_dir else st.st_size)


def _kind(st: os.stat_result) -> str:
    return "link" if stat.S_ISLNK(st.st_mode) else "dir" if stat.S_ISDIR(st.st_mode) else "file"


def list_root(root: str, names: list[str] | None, follow: bool) -> Iterator[Found]:
    """The groups below a root. Of a destination, also links and files in place of a group, with the path ''."""
    if not os.path.isdir(root):
        return
    wanted = set(names) if names is not None else None
    with os.scandir(root) as entries:
        found = sorted((e for e in entries if (wanted is None or e.name in wanted) and not e.name.startswith(WORK)), key=lambda e: e.name)
    for e in found:
        try:
            st = e.stat(follow_symlinks=follow)
        except OSError:
            continue
        if stat.S_ISDIR(st.st_mode):
            yield _entry(e.name, "", st, "group")
        elif not follow:
            yield Found(e.name, "", None if e.is_symlink() else False, _kind(st))


def _children(root: str, handles: Confined | None, group: str, folder: str) -> list[tuple[str, os.stat_result | None]]:
    """Names and what they are, in order; None for a link that leads nowhere."""
    if handles:
        try:
            at: int | str = handles.enter([group, *folder.split("/")] if folder else [group])
        except OSError as e:
            if e.errno in NO_FOLDER:  # gone, or a link by now
                return []
            raise
    else:
        at = os.path.join(root, group, folder)
    out = []
    with os.scandir(at) as entries:
        for e in entries:
            try:
                out.append((e.name, e.stat(follow_symlinks=handles is None)))
            except FileNotFoundError:
                if handles is None and e.is_symlink():
                    out.append((e.name, None))
            except OSError:
                out.append((e.name, None))
    return sorted(out, key=lambda x: x[0])


def _real(root: str, group: str, folder: str) -> set[tuple[int, int]]:
    """The folders on the way down to this one, itself included, as device and number."""
    parts = folder.split("/") if folder else []
    return {(st.st_dev, st.st_ino) for i in range(len(parts) + 1) for st in [os.stat(os.path.join(root, group, *parts[:i]))]}


def walk(root: str, group: str, folder: str, follow: bool, budget: int, prefix: str = "") -> Iterator[Found]:
    """What lies below a folder; folders that are met after `budget` entries come as `open`.

    With `prefix`, only paths that start with it, and only folders that can hold such.
    """
    queue, met = deque([folder]), 0
    handles = None if follow else Confined(root)
    try:
        while queue:
            at = queue.popleft()
            if met >= budget and at != folder:
                yield Found(group, at, True, "open")
                continue
            children = _children(root, handles, group, at)
            above = _real(root, group, at) if follow and any(st and stat.S_ISDIR(st.st_mode) for _, st in children) else set()
            yield Found(group, at, True, "listed", size=len(children))
            met += len(children)
            for name, st in children:
                path = f"{at}/{name}" if at else name
                if not (path.startswith(prefix) or prefix.startswith(path + "/")):
                    continue
                if st is None:
                    yield Found(group, path, False, "dangling")
                    continue
                kind = _kind(st)
                if path.startswith(prefix):
                    yield Found(group, path, None, "link") if kind == "link" else _entry(group, path, st, kind)
                if kind == "dir" and (st.st_dev, st.st_ino) not in above:
                    queue.append(path)
    finally:
        if handles:
            handles.__exit__()
