"""Path columns: '/'-separated text, compared component by component where order matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def components(path: Column) -> Column:
    """Sort key under which a parent precedes its children (and follows them when descending)."""
    return F.split(path, "/")


def base_name(path: Column) -> Column:
    return F.element_at(components(path), -1)


def parent(path: Column) -> Column:
    """Everything before the last component; '' for a single component."""
    parts = components(path)
    return F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")


def join(*parts: Column) -> Column:
    """Join non-empty parts; an absolute later part is not special here, callers reject those."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), "/")


def relative_to(path: Column, prefix: Column) -> Column:
    """`path` below `prefix`; NULL when it isn't below it."""
    head = F.concat(prefix, F.lit("/"))
    return F.when(path == prefix, F.lit("")).when(
        F.startswith(path, head), F.substring(path, F.length(head) + 1, F.length(path))
    )


def is_plain_name(name: Column) -> Column:
    """True for a name that stays directly below a root: no '', '.', '..', separators."""
    return name.isNotNull() & ~name.isin("", ".", "..") & ~F.contains(name, F.lit("/")) & ~F.contains(name, F.lit("\\"))
