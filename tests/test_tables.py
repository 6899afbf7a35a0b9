from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.functions import paths as P
from tessera.operators.mirror import Layout, Snapshot
from tessera.plans.planner import MirrorError, plan_mirror
from tessera.operators.mirror import ordered_groups
from tessera.sinks.table import apply_to_table, folder_of, mirror_table, read_groups, read_table, table_snapshot, versions
from tessera.streaming.follow import follow

LAY = Layout(group="g", keys=("k",))
SCHEMA = "k bigint, v string, g string"


def snap(spark, rows, groups=None):
    df = spark.createDataFrame(rows, SCHEMA)
    return Snapshot.of(df, LAY, spark.createDataFrame([(g,) for g in groups], "g string") if groups else None)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "old", "a"), (2, "gone", "a"), (3, "x", "empty one"), (4, "kept", "orphan")], SCHEMA).write.partitionBy("g").parquet(path)
    return path


def rows(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path, SCHEMA).select("g", "k", "v").collect())


def test_apply(spark, table):
    src = snap(spark, [(1, "new", "a"), (5, "n", "b")], ["a", "b", "empty one"])
    for _ in range(2):
        status = apply_to_table(plan_mirror(src, Snapshot.of(read_table(spark, table, SCHEMA), LAY)), table)
        assert rows(spark, table) == [("a", 1, "new"), ("b", 5, "n"), ("orphan", 4, "kept")]
    assert {r.g for r in status.collect()} == {"a", "b", "empty one"}


def test_an_emptied_group_is_still_a_group(spark, table):
    """Read from the table alone: the catalogue has what the data can't say."""
    src = snap(spark, [(1, "new", "a"), (5, "n", "b")], ["a", "b", "empty one"])
    groups = lambda: [r.g for r in ordered_groups(table_snapshot(spark, table, SCHEMA, LAY)).collect()]
    assert groups() == ["a", "empty one", "orphan"]
    status = {r.g: (r.n_copied, r.n_pruned) for r in mirror_table(src, table, SCHEMA).collect()}
    assert status == {"a": (1, 1), "b": (1, 0), "empty one": (0, 1)}
    assert groups() == ["a", "b", "empty one", "orphan"] and not list(Path(table).glob("g=empty*"))
    assert {r.g: r.n_rows for r in read_groups(spark, table, "g").collect()} == {"a": 1, "b": 1, "empty one": 0, "orphan": None}
    mirror_table(snap(spark, [(9, "z", "a")], ["a"]), table, SCHEMA, ["a"])
    assert groups() == ["a", "b", "empty one", "orphan"] and rows(spark, table) == [("a", 9, "z"), ("b", 5, "n"), ("orphan", 4, "kept")]
    mirror_table(snap(spark, [(9, "z", "a")], ["a", "new and empty"]), table, SCHEMA, prune_orphans=True)
    assert groups() == ["a", "new and empty"] and rows(spark, table) == [("a", 9, "z")]
    assert len(versions(spark, table)) == 2


def test_a_table_is_made(spark, tmp_path):
    path = str(tmp_path / "new")
    mirror_table(snap(spark, [], ["only", "empty"]), path, SCHEMA)
    assert [r.g for r in ordered_groups(table_snapshot(spark, path, SCHEMA, LAY)).collect()] == ["empty", "only"]
    (tmp_path / "file").write_text("x")
    with pytest.raises(MirrorError):
        mirror_table(snap(spark, []), str(tmp_path / "file"), SCHEMA)


def test_an_unfinished_catalogue_does_not_count(spark, table):
    mirror_table(snap(spark, [(1, "new", "a")], ["a", "b"]), table, SCHEMA)
    half = Path(table, "_groups", "v2")
    half.mkdir()
    assert versions(spark, table) == [1] and read_groups(spark, table, "g").count() == 4
    mirror_table(snap(spark, [(1, "new", "a")], ["a", "b"]), table, SCHEMA)
    assert versions(spark, table) == [1, 2]


def test_folders_are_named_as_spark_names_them(spark, tmp_path):
    odd = ["a b", "x=y", "50%", "a/b", "é", "q?*:\"'", "{[]^", "\x01\t", "\\", None, "#", "a.b-c_d~"]
    df = spark.createDataFrame([(1, g) for g in odd], "k int, g string")
    df.write.partitionBy("g").parquet(str(tmp_path / "t"))
    assert {r[0] for r in df.select(folder_of("g")).collect()} == {p.name for p in (tmp_path / "t").glob("g=*")}


def test_source_keys_must_be_unique(spark, table):
    with pytest.raises(MirrorError):
        plan_mirror(snap(spark, [(1, "x", "a"), (1, "y", "a")]), snap(spark, []))


def test_empty_source(spark):
    plan = plan_mirror(snap(spark, []), snap(spark, [(1, "x", "a")]))
    assert plan.result().count() == 1 and plan.stale().count() == 0


def test_stream_of_changed_groups(spark, table, tmp_path):
    src = lambda: snap(spark, [(1, "new", "a")], ["a", "empty one"])
    dst = lambda: Snapshot.of(read_table(spark, table, SCHEMA), LAY)
    changes = str(tmp_path / "changes")
    spark.createDataFrame([("a",), ("a",), ("unknown",)], "g string").write.parquet(changes)
    follow(spark.readStream.schema("g string").parquet(changes), src, dst, table, str(tmp_path / "cp")).awaitTermination(120)
    assert rows(spark, table) == [("a", 1, "new"), ("empty one", 3, "x"), ("orphan", 4, "kept")]


def test_path_functions(spark):
    df = spark.createDataFrame([("a/b/c",), ("a",), ("a-b/c",)], "p string")
    got = df.select(P.base_name(F.col("p")), P.parent(F.col("p")), P.relative_to(F.col("p"), F.lit("a")), P.join(F.lit("r"), F.lit(""), F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("c", "a/b", "b/c", "r/a/b/c"), ("a", "", "", "r/a"), ("c", "a-b", None, "r/a-b/c")]
    names = spark.createDataFrame([("x",), ("..",), ("a/b",), (None,)], "n string")
    assert [r[0] for r in names.select(P.is_plain_name(F.col("n"))).collect()] == [True, False, False, False]
