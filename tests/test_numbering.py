import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.numbering import numbered
from tessera.staging import Scratch, shared_folder


def brute(rows):
    out, seen = [], {}
    for g, k in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1])):
        seen[g] = seen.get(g, 0) + 1
        out.append((g, k, seen[g]))
    return sorted(out, key=repr)


@pytest.fixture(autouse=True)
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed", range(6))
def test_a_group_over_many_partitions(spark, seed):
    pick = random.Random(seed)
    groups = pick.choice([["a"], ["a", "b", None], [None], list("abcdefghij")])
    keys = pick.sample(range(10_000), 3_000)
    rows = [("hot" if pick.random() < 0.4 and seed else pick.choice(groups), k) for k in keys]
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    with Scratch(spark, "numbering") as scratch:
        got = numbered(df, ["g"], [F.col("k").desc()], scratch)
        parts = got.select("g", F.spark_partition_id().alias("p")).distinct().groupBy("g").count().agg(F.max("count")).first()[0]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows) and parts > 1
        assert "Window" not in got._jdf.queryExecution().toString()
        folder = scratch.path
        assert os.path.isdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:")) and folder.startswith(shared_folder(spark))


def test_no_rows_and_one(spark):
    with Scratch(spark, "numbering") as scratch:
        df = spark.createDataFrame([(1, "x", 5)], "a int, b string, k int")
        assert numbered(df.limit(0), ["a", "b"], [F.col("k")], scratch).count() == 0
        assert [tuple(r) for r in numbered(df, ["a", "b"], [F.col("k")], scratch, "no").collect()] == [(1, "x", 5, 1)]


def test_repeated_rows_have_numbers_of_their_own(spark):
    df = spark.createDataFrame([("a", 1)] * 500 + [("b", 2)] * 3, "g string, k int")
    with Scratch(spark, "numbering") as scratch:
        got = numbered(df, ["g"], [F.col("k")], scratch).groupBy("g").agg(F.sort_array(F.collect_list("rn")).alias("n")).collect()
        assert {r.g: r.n for r in got} == {"a": list(range(1, 501)), "b": [1, 2, 3]}
