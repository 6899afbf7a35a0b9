import os
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators.mirror import prune_order, sorted_for_deletion
from tessera.plans.planner import MirrorError, request
from tessera.sinks.tree import mirror_tree
from tessera.sources.tree import TREE, read_tree


def put(root: Path, **files):
    for name, data in files.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.mkdir(exist_ok=True) if data is None else p.write_bytes(data.encode())


def tree(root: Path) -> dict:
    return {str(p.relative_to(root)): None if p.is_dir() else p.read_bytes() for p in root.rglob("*")}


@pytest.fixture
def roots(tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    put(src, **{"g1/SKILL.md": "one", "g1/a/b/c.txt": "deep", "g1/empty": None, "g1/.hidden": "h", "g1/_under/x": "u", "g3": None, "stray.txt": "no"})
    put(dst, **{"g1/SKILL.md": "old", "g1/old/deep/f": "stale", "g3/x": "gone", "g9/kept": "orphan"})
    return src, dst


def test_all_groups(spark, roots):
    src, dst = roots
    before = tree(src)
    status = {r.skill: (r.n_copied, r.n_pruned) for r in mirror_tree(spark, str(src), str(dst)).collect()}
    got = tree(dst)
    assert {k: v for k, v in got.items() if k.startswith("g1/")} == {k: v for k, v in before.items() if k.startswith("g1/")}
    assert (dst / "g3").is_dir() and not list((dst / "g3").iterdir())
    assert got["g9/kept"] == b"orphan" and "stray.txt" not in got
    assert status == {"g1": (8, 3), "g3": (0, 1)} and tree(src) == before
    mirror_tree(spark, str(src), str(dst))
    assert tree(dst) == got


def test_named_group_only(spark, roots):
    src, dst = roots
    mirror_tree(spark, str(src), str(dst), ["g3", "g3"])
    assert (dst / "g1/SKILL.md").read_bytes() == b"old" and not (dst / "g3/x").exists()


def test_prune_orphans(spark, roots):
    src, dst = roots
    mirror_tree(spark, str(src), str(dst), prune_orphans=True)
    assert not (dst / "g9/kept").exists()


@pytest.mark.parametrize("name", ["", ".", "..", "/etc", "a/b", "a\\b"])
def test_bad_names(spark, roots, name):
    with pytest.raises(MirrorError):
        mirror_tree(spark, *map(str, roots), [name])


def test_missing_name_fails_before_any_write(spark, roots):
    src, dst = roots
    before = tree(dst)
    with pytest.raises(MirrorError):
        mirror_tree(spark, str(src), str(dst), ["g1", "nope"])
    assert tree(dst) == before


@pytest.mark.parametrize("in_src", [True, False])
def test_kind_mismatch_fails_before_any_write(spark, roots, in_src):
    src, dst = roots
    put(src if in_src else dst, **{"g1/X/y": "dir"})
    put(dst if in_src else src, **{"g1/X": "file"})
    before = tree(dst)
    with pytest.raises(MirrorError):
        mirror_tree(spark, str(src), str(dst))
    assert tree(dst) == before


def test_links(spark, roots, tmp_path):
    src, dst = roots
    put(tmp_path / "far", **{"f": "linked"})
    (src / "g1/ln").symlink_to(tmp_path / "far")
    (dst / "g1/stale_ln").symlink_to(tmp_path / "far")
    (dst / "g1/SKILL.md").unlink()
    (dst / "g1/SKILL.md").symlink_to(tmp_path / "far/f")
    mirror_tree(spark, str(src), str(dst))
    assert (dst / "g1/ln/f").read_bytes() == b"linked" and not (dst / "g1/ln").is_symlink()
    assert not (dst / "g1/stale_ln").is_symlink() and (tmp_path / "far/f").read_bytes() == b"linked"
    assert (dst / "g1/SKILL.md").read_bytes() == b"one"
    (src / "g1/dang").symlink_to(tmp_path / "nowhere")
    with pytest.raises(MirrorError):
        mirror_tree(spark, str(src), str(dst))


def test_read_only_file_twice(spark, roots):
    src, dst = roots
    os.chmod(src / "g1/SKILL.md", 0o444)
    for _ in range(2):
        mirror_tree(spark, str(src), str(dst))
    assert (dst / "g1/SKILL.md").stat().st_mode & 0o777 == 0o444


def test_scan_sees_links_into_themselves_once(spark, tmp_path):
    put(tmp_path / "r", **{"g/a/x": "1"})
    (tmp_path / "r/g/a/up").symlink_to(tmp_path / "r/g")
    assert {r.rel_path for r in read_tree(spark, str(tmp_path / "r")).entries.collect()} == {"a", "a/x", "a/up"}


def test_content_and_groups_option(spark, roots):
    snap = read_tree(spark, str(roots[0]), ["g1"], content=True)
    rows = {r.rel_path: r.content for r in snap.entries.collect()}
    assert bytes(rows["SKILL.md"]) == b"one" and rows["empty"] is None
    assert [r.skill for r in snap.groups.collect()] == ["g1"]


names = st.lists(st.sampled_from(["a", "a-b", "B", "é", "z", "\U0001f600", "a.b"]), min_size=1, max_size=4).map("/".join)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(names, min_size=1, max_size=12))
def test_delete_order(spark, paths):
    df = spark.createDataFrame([("g", p) for p in paths], "skill string, rel_path string")
    want = [str(p) for p in sorted(map(Path, paths), reverse=True)]
    assert [r.rel_path for r in prune_order(df, TREE).orderBy("rn").collect()] == want
    parts = sorted_for_deletion(df, TREE).withColumn("p", F.spark_partition_id()).collect()
    seen = [(r.p, r.rel_path) for r in parts]
    for i, (p, path) in enumerate(seen):
        assert not any(q == p and later.startswith(path + "/") for q, later in seen[i + 1 :])


def test_request_repeats_count_once(spark):
    assert request(spark, ["a", "a"]).count() == 1


def test_cli(spark, roots, capsys):
    from tessera.cli import main

    assert main([*map(str, roots), "g3"]) == 0 and "g3: 0 copied, 1 pruned" in capsys.readouterr().out
    assert main([*map(str, roots), "nope"]) == 1
    assert main(["/nowhere/at/all", str(roots[1])]) == 1


def test_a_missing_source_writes_and_deletes_nothing(spark, roots):
    src, dst = roots
    before = tree(dst)
    for wrong in (src / "typo", src / "stray.txt"):
        with pytest.raises(MirrorError):
            mirror_tree(spark, str(wrong), str(dst), prune_orphans=True)
    assert tree(dst) == before


def test_directories_keep_mode_and_time(spark, roots):
    src, dst = roots
    for path, mode, at in (("g1/a/b", 0o750, 1_000_000_000), ("g1/a", 0o700, 1_100_000_000), ("g1/empty", 0o711, 1_200_000_000), ("g1", 0o705, 1_300_000_000)):
        os.chmod(src / path, mode)
        os.utime(src / path, (at, at))
    mirror_tree(spark, str(src), str(dst))
    for path in ("g1", "g1/a", "g1/a/b", "g1/empty"):
        a, b = (src / path).stat(), (dst / path).stat()
        assert (a.st_mode, a.st_mtime) == (b.st_mode, b.st_mtime), path


def test_what_comes_during_the_prune_is_reported(spark, roots, monkeypatch):
    from tessera.sinks import tree as sink

    src, dst = roots
    ordered = sink.sorted_for_deletion

    def meanwhile(doomed, layout):
        rows = doomed.sparkSession.createDataFrame(ordered(doomed, layout).select("skill", "rel_path").collect())
        put(dst, **{"g1/old/deep/new": "just now"})
        return rows.coalesce(1)

    monkeypatch.setattr(sink, "sorted_for_deletion", meanwhile)
    with pytest.raises(MirrorError, match="run again"):
        mirror_tree(spark, str(src), str(dst))
    assert (dst / "g1/old/deep/new").read_text() == "just now"
    monkeypatch.undo()
    mirror_tree(spark, str(src), str(dst))
    assert not (dst / "g1/old").exists()
