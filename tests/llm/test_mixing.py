import pytest

from tessera.llm import mixing as X

SCHEMA = "doc_id bigint, text string, source string, size int, target string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x") for i, t, s in rows], SCHEMA)


def test_query_equals_sql(spark, compare):
    assert compare(spark, X.op6_mix_sources, X.SQL, "/root/testdata/sf0.01")


def test_targets_are_met(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), s) for i in range(3000) for s in [["a", "b", "c", "d", None][i % 5 if i % 3 else 0]]]
    got = X.mix(table(spark, rows)).toPandas()
    assert len(got) == 3000 and (got.taken <= 3 * got["size"]).all()
    by = got.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((by.target - by.taken).abs() <= 20).all() and by.target.sum() == pytest.approx(got["size"].sum())
    again = X.mix(table(spark, rows[::-1]).repartition(5)).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_sample_is_of_unequal_probability(spark):
    got = X.mix(table(spark, [(i, "w " * (4 if i % 2 else 40), "ab"[i % 3 == 0]) for i in range(6000)])).toPandas()
    a = got[got.target < got.source_size]
    assert a[a["size"] == 40].copies.mean() > a[a["size"] == 4].copies.mean() + 0.1


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x y", "b"), (3, "x y", "b"), (None, "z", "b")]
    got = sorted((r.doc_id or 0, r.size, r.taken, r.target) for r in X.mix(table(spark, rows)).collect())
    assert [g[:2] for g in got] == [(0, 1), (1, 0), (2, 0), (3, 2), (3, 2)] and got[0][3] == 5.0
    assert all(r.taken == 0 for r in X.mix(table(spark, [(1, None, None)])).collect())
    assert X.mix(table(spark, [])).count() == 0
