"""Trees that are large in one place, links in the wrong place, and what changes or fails during a run."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.plans.planner import MirrorError
from tessera.sinks import tree as sink
from tessera.sinks.confined import Confined, components
from tessera.sinks.tree import delete_by_depth, mirror_tree
from tessera.sources import tree as source_tree
from tessera.sources.inventory import take_inventory
from tessera.sources.tree import read_tree, register
from tessera.staging import Scratch
from tests.test_tree import put, tree


@pytest.fixture
def roots(tmp_path):
    src, dst, outside = tmp_path / "src", tmp_path / "dst", tmp_path / "outside"
    put(src, **{"a/f": "1", "a/deep/er/g": "2", "b/h": "3"})
    put(outside, **{"precious": "p", "deep/precious": "q"})
    dst.mkdir()
    return src, dst, outside


def test_a_linked_group_is_replaced_by_a_folder(spark, roots):
    src, dst, outside = roots
    before = tree(outside)
    (dst / "a").symlink_to(outside)
    status = {r.skill: (r.n_copied, r.n_pruned) for r in mirror_tree(spark, str(src), str(dst)).collect()}
    assert tree(outside) == before and not (dst / "a").is_symlink()
    assert tree(dst) == tree(src) and status == {"a": (4, 0), "b": (1, 0)}
    (dst / "orphan").symlink_to(outside)
    mirror_tree(spark, str(src), str(dst))
    assert (dst / "orphan").is_symlink() and tree(outside) == before
    mirror_tree(spark, str(src), str(dst), prune_orphans=True)
    assert not (dst / "orphan").is_symlink() and tree(outside) == before


@pytest.mark.parametrize("where", ["a", "a/deep", "a/old"])
def test_a_link_that_comes_after_the_listing(spark, roots, monkeypatch, where):
    """Between listing and copying, and between listing and deleting, a folder becomes a link to outside."""
    src, dst, outside = roots
    put(dst, **{"a/deep/precious": "stale", "a/old/deep/precious": "stale", "a/precious": "stale"})
    put(outside, **{"deep/deep/precious": "r"})
    before = tree(outside)
    moved = dst.parent / "moved"

    def turn():
        if (dst / where).exists() and not (dst / where).is_symlink():
            moved.mkdir(exist_ok=True)
            os.rename(dst / where, moved / f"{where.replace('/', '_')}{len(os.listdir(moved))}")
            (dst / where).symlink_to(outside)

    def listing(*args, take=sink.take_inventory, **kw):
        found = take(*args, **kw)
        if kw.get("name") in ("target", "after"):
            turn()
        return found

    monkeypatch.setattr(sink, "take_inventory", listing)
    mirror_tree(spark, str(src), str(dst))
    assert tree(outside) == before
    monkeypatch.undo()
    mirror_tree(spark, str(src), str(dst))
    assert tree(outside) == before and tree(dst) == tree(src)


def test_handles_never_leave_the_root(tmp_path):
    put(tmp_path, **{"root/g/x": "1", "outside/x": "2", "outside/d": None})
    (tmp_path / "root/ln").symlink_to(tmp_path / "outside")
    with Confined(str(tmp_path / "root")) as root:
        assert root.delete(["ln", "x"]) and (tmp_path / "outside/x").exists()
        root.like(["ln"], os.stat("/"))
        root.make_folder(["ln", "d"])
        assert not (tmp_path / "root/ln").is_symlink() and tree(tmp_path / "outside") == {"x": b"2", "d": None}
        assert root.delete(["g", "gone", "x"]) and not root.delete(["g"]) and root.delete(["g", "x"]) and root.delete(["g"])
    for group, path in (("..", "x"), ("g", "../x"), ("g", "a//b"), ("", "x"), ("a/b", "x")):
        with pytest.raises(ValueError):
            components(group, path)


def test_a_file_in_place_of_a_group_fails_before_any_write(spark, roots):
    src, dst, _ = roots
    put(dst, **{"b": "a file", "stray": "s"})
    before = tree(dst)
    with pytest.raises(MirrorError, match="in the place of a group"):
        mirror_tree(spark, str(src), str(dst))
    assert tree(dst) == before


def test_one_huge_group_is_listed_by_many_tasks(spark, tmp_path):
    put(tmp_path / "r", **{f"huge/{i:03d}/f{j}": "x" for i in range(1000) for j in range(2)} | {"small/f": "x"})
    with Scratch(spark, "test") as scratch:
        found = take_inventory(spark, tmp_path / "r", None, scratch)
        got = {(r.skill, r.rel_path) for r in found.snapshot.entries.collect()}
        listed = found.listed().collect()
    assert got == {tuple(p.split("/", 1)) for p in tree(tmp_path / "r") if "/" in p}
    assert len({(r["round"], r.task) for r in listed}) > 4
    assert len(listed) == 1002 and len({(r.skill, r.rel_path) for r in listed}) == 1002  # each folder once
    entries = read_tree(spark, str(tmp_path / "r")).entries
    by_task = entries.groupBy(F.spark_partition_id()).count().collect()
    assert {(r.skill, r.rel_path) for r in entries.collect()} == got and len(by_task) > 4


def test_deep_trees_and_links_take_several_rounds(spark, tmp_path):
    put(tmp_path / "r", **{f"g/{'/'.join('abcdefgh'[:n])}/f{n}{j}": "x" for n in range(1, 9) for j in range(3)})
    (tmp_path / "r/g/a/b/up").symlink_to(tmp_path / "r/g")
    with Scratch(spark, "test") as scratch:
        whole = take_inventory(spark, tmp_path / "r", None, scratch, follow=False)
        split = take_inventory(spark, tmp_path / "r", None, scratch, follow=False, budget=1, name="split")
        followed = take_inventory(spark, tmp_path / "r", None, scratch, budget=1, name="followed")
        rows = lambda i: sorted((r.skill, r.rel_path, r.kind) for r in i.snapshot.entries.collect())
        assert rows(whole) == rows(split) and ("g", "a/b/up", "link") in rows(whole)
        assert ("g", "a/b/up", "dir") in rows(followed) and not any(p.startswith("a/b/up/") for _, p, _ in rows(followed))
        assert split.listed().select("round").distinct().count() > 4


def test_a_run_lists_the_source_once_and_the_destination_twice(spark, roots, monkeypatch):
    src, dst, _ = roots
    put(dst, **{"a/old/f": "stale"})
    taken = []

    def listing(spark, root, *args, take=sink.take_inventory, **kw):
        found = take(spark, root, *args, **kw)
        taken.append((os.path.basename(root), [(r.skill, r.rel_path) for r in found.listed().collect()]))
        return found

    monkeypatch.setattr(sink, "take_inventory", listing)
    mirror_tree(spark, str(src), str(dst))
    assert [name for name, _ in taken] == ["src", "dst", "dst"]
    assert all(len(folders) == len(set(folders)) for _, folders in taken)


def test_what_comes_meanwhile_is_in_no_step(spark, roots, monkeypatch):
    """A file that comes into the source after its listing is neither copied nor counted; one that comes into the destination is pruned."""
    src, dst, _ = roots

    def copy(entries, *args, run=sink.copy_entries):
        put(src, **{"a/late": "l"})
        put(dst, **{"a/deep/late": "l"})
        return run(entries, *args)

    monkeypatch.setattr(sink, "copy_entries", copy)
    status = {r.skill: (r.n_copied, r.n_pruned) for r in mirror_tree(spark, str(src), str(dst)).collect()}
    assert status == {"a": (4, 1), "b": (1, 0)}  # what was done, not what was planned
    assert set(tree(dst)) == {"a", "a/f", "a/deep", "a/deep/er", "a/deep/er/g", "b", "b/h"}


def test_a_failing_task_leaves_no_part_and_no_deletion(spark, roots, monkeypatch):
    src, dst, _ = roots
    put(dst, **{"a/old/f": "stale", "b/h": "before"})

    def copy(entries, *args, run=sink.copy_entries):
        (src / "a/deep/er/g").unlink()
        return run(entries, *args)

    monkeypatch.setattr(sink, "copy_entries", copy)
    with pytest.raises(Exception, match="FileNotFoundError|No such file"):
        mirror_tree(spark, str(src), str(dst))
    assert (dst / "a/old/f").read_text() == "stale"
    assert not [p for p in os.listdir(dst) if p.startswith(".tessera")]
    monkeypatch.undo()
    mirror_tree(spark, str(src), str(dst))
    assert tree(dst) == tree(src)


def test_without_a_commit_nothing_is_deleted(spark, roots, monkeypatch):
    src, dst, _ = roots
    put(dst, **{"a/old/f": "stale"})
    from tessera.sinks import writer

    monkeypatch.setattr(sink, "MANIFEST", "of another run")
    with pytest.raises(MirrorError, match="no commit"):
        mirror_tree(spark, str(src), str(dst))
    assert (dst / "a/old/f").exists() and writer.MANIFEST == "manifest.json"


def test_a_deep_tree_is_deleted_by_many_tasks(spark, tmp_path):
    put(tmp_path, **{f"g/top/{i:02d}/{j}/f": "x" for i in range(40) for j in range(3)} | {"g/keep": "k"})
    rows = [("g", p.removeprefix("g/")) for p in tree(tmp_path) if p.startswith("g/top")]
    doomed = spark.createDataFrame(rows, "skill string, rel_path string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    with Scratch(spark, "test") as scratch:
        done = delete_by_depth(doomed, str(tmp_path), scratch)
        assert done.agg(F.sum("n_pruned")).first()[0] == len(rows) and done.where("left IS NOT NULL").isEmpty()
        assert done.where("n_pruned > 0").count() > 8  # a row from each task and depth
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(tree(tmp_path)) == {"g", "g/keep"}


def test_filters_are_pushed_down(spark, tmp_path, monkeypatch):
    put(tmp_path / "r", **{"a/x/1": "1", "a/x/2": "2", "a/y/3": "3", "b/x/4": "4", "c/x/5": "5"})
    snap = read_tree(spark, str(tmp_path / "r")).entries
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    one = snap.where("skill = 'a'")
    assert {r.rel_path for r in one.collect()} == {"x", "x/1", "x/2", "y", "y/3"}
    assert ") Filter" not in plan(snap.where("skill IN ('a', 'b')"))
    below = snap.where("skill IN ('a', 'b') AND rel_path LIKE 'x/%' AND size = 1")
    assert {(r.skill, r.rel_path) for r in below.collect()} == {("a", "x/1"), ("a", "x/2"), ("b", "x/4")}
    os.chmod(tmp_path / "r/b", 0)  # a folder that isn't listed can't fail either
    listed = []
    monkeypatch.setattr(source_tree, "walk", lambda root, group, *a, walk=source_tree.walk: listed.append(group) or walk(root, group, *a))
    reader = source_tree.TreeReader({"path": str(tmp_path / "r")})
    assert list(reader.pushFilters([source_tree.EqualTo(("skill",), "a"), source_tree.StringStartsWith(("rel_path",), "x/")])) == []
    rows = [row[:2] for p in reader.partitions() for row in reader.read(p)]
    os.chmod(tmp_path / "r/b", 0o755)
    assert sorted(rows) == [("a", "x/1"), ("a", "x/2")] and set(listed) == {"a"}
    assert list(reader.pushFilters([source_tree.EqualTo(("kind",), "file")]))


def test_writing_rows_with_content(spark, tmp_path):
    register(spark)
    (tmp_path / "t/.tessera-x/parts").mkdir(parents=True)
    (tmp_path / "t/.tessera-x/receipts").mkdir()
    rows = [("g", "a/f", False, bytearray(b"hello")), ("g", "d", True, None)]
    df = spark.createDataFrame(rows, "skill string, rel_path string, is_dir boolean, content binary")
    df.write.format("tessera_tree").options(path=str(tmp_path / "t"), run=".tessera-x").mode("append").save()
    assert Path(tmp_path / "t/g/a/f").read_bytes() == b"hello" and (tmp_path / "t/g/d").is_dir() and (tmp_path / "t/.tessera-x/manifest.json").exists()


def test_a_run_that_broke_off_goes_on(spark, roots, tmp_path, monkeypatch):
    src, dst, _ = roots
    put(src, **{f"g{i}/f{j}": f"{i}{j}" for i in range(12) for j in range(4)} | {"empty": None})
    put(dst, **{f"g{i}/old/f": "stale" for i in range(12)})
    journal, calls = str(tmp_path / "journal"), []

    def copy(entries, *args, run=sink.copy_entries):
        calls.append({r.skill for r in entries.select("skill").distinct().collect()})
        if len(calls) == 3:
            raise OSError("killed")
        return run(entries, *args)

    monkeypatch.setattr(sink, "copy_entries", copy)
    go = lambda: mirror_tree(spark, str(src), str(dst), journal=journal, batch_entries=20)
    with pytest.raises(OSError, match="killed"):
        go()
    finished = calls[0] | calls[1]
    assert finished and all(tree(dst / g) == tree(src / g) for g in finished)
    late = min(set(calls[2]) or {"g0"})
    assert (dst / late / "old/f").exists() or late not in {f"g{i}" for i in range(12)}
    put(src, **{"late/f": "comes after the listing"})
    with pytest.raises(MirrorError, match="another request"):
        mirror_tree(spark, str(src), str(dst), ["a"], journal=journal)
    listings = []
    monkeypatch.setattr(sink, "take_inventory", lambda *a, take=sink.take_inventory, **kw: listings.append(kw["name"]) or take(*a, **kw))
    status = {r.skill: (r.n_copied, r.n_pruned) for r in go().collect()}
    assert not finished & set().union(*calls[3:]) and set().union(*calls) == {*(f"g{i}" for i in range(12)), "a", "b"}
    assert "source" not in listings and "target" not in listings
    assert status == {**{f"g{i}": (4, 2) for i in range(12)}, "a": (4, 0), "b": (1, 0), "empty": (0, 0)}
    assert not os.path.exists(journal)
    want = tree(src)
    del want["late"], want["late/f"]
    assert tree(dst) == want


def test_few_rows_of_few_bytes_are_copied_by_all_cores(spark, roots):
    """Rows of paths are so small that Spark by itself made one task of thousands of files."""
    src, dst, _ = roots
    put(src, **{f"a/d{i % 3}/f{i}": "x" for i in range(400)})
    dst, run = sink.begun(str(dst))
    register(spark)
    with Scratch(spark, "test") as scratch:
        entries = take_inventory(spark, src, None, scratch).snapshot.entries
        copied = sink.copy_entries(entries, str(src), dst, run).groupBy(F.input_file_name()).agg(F.sum("n_copied")).collect()
    assert len(copied) == 8 and max(r[1] for r in copied) < 120
    assert sum(r[1] for r in copied) == 400 + 3 + 5


def test_a_file_that_is_there_already_is_not_written_again(spark, roots):
    src, dst, outside = roots
    put(src, **{"a/same": "same", "a/other": "1234", "a/linked": "same"})
    put(dst, **{"a/same": "same", "a/other": "5678", "a/linked": "same"})
    os.link(dst / "a/linked", outside / "second name")
    os.chmod(src / "a/same", 0o640)
    os.utime(src / "a/same", ns=(10**18, 10**18 + 7))
    before = {f: (dst / "a" / f).stat() for f in ("same", "other", "linked")}
    elsewhere = (outside / "second name").stat()
    status = {r.skill: (r.n_copied, r.n_pruned) for r in mirror_tree(spark, str(src), str(dst)).collect()}
    after = {f: (dst / "a" / f).stat() for f in before}
    assert tree(dst) == tree(src) and status == {"a": (7, 0), "b": (1, 0)}
    assert after["same"].st_ino == before["same"].st_ino and (after["same"].st_mode & 0o777, after["same"].st_mtime_ns) == (0o640, 10**18 + 7)
    assert after["other"].st_ino != before["other"].st_ino and after["linked"].st_ino != before["linked"].st_ino
    assert (outside / "second name").stat().st_mtime_ns == elsewhere.st_mtime_ns
