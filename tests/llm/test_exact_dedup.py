import hashlib
import re

import pytest

from tessera.llm import exact_dedup as X

SCHEMA = "doc_id bigint, text string, `row` string, recipe int"


def brute(rows):
    norm = [re.sub(r"[ \t-\r]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm, strict=True):
        groups.setdefault(t, []).append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm, strict=True)), key=repr)


LONG = "Some words here. " * 3000
ROWS = [(1, "a  b\n"), (2, "a b "), (3, None), (4, ""), (5, LONG), (6, LONG.replace(". ", ".\n")), (7, LONG + "x"), (None, "a b "), (8, "é" * 20000), (9, "é" * 20000), (10, "é" * 20001), (11, "\x0b\x0ca"), (12, " a")]


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_against_brute_force(spark, bits):
    if not bits:
        bits = 1
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in ROWS], SCHEMA)
    got = X.exact_dedup(df, bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(ROWS)
    assert sum(r.kept for r in got) == len({t for *_, t in brute(ROWS)}) and not any(r.kept for r in got if r.doc_id is None)


#: Two texts with one value in two seeded 64-bit hashes and one length.
ALIKE = ["u_R{J3u<xxxxxxxxxxxxxxxxxxxxxxxx#~##~~#~xxxxxxxxxxxxxxxxxxxxxxxx", "0CZDf`W9xxxxxxxxxxxxxxxxxxxxxxxxX4oPVTydxxxxxxxxxxxxxxxxxxxxxxxx"]


def test_chunks_with_one_hash_are_told_apart_by_content(spark):
    rows = [(1, ALIKE[0]), (2, ALIKE[1]), (3, ALIKE[0]), (4, ALIKE[1] + " "), (5, "other")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    assert df.where("doc_id < 3").selectExpr("xxhash64(text) AS a", "xxhash64(1, text) AS b").distinct().count() == 1
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.exact_dedup(df).collect())
    assert got == [(1, 1, 2, True), (2, 2, 1, True), (3, 1, 2, False), (4, 4, 1, True), (5, 5, 1, True)]


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a", "x", 1)] * 3, SCHEMA)
    got = X.exact_dedup(df).collect()
    assert [r.keep_id for r in got] == [1] * 3 and sum(r.kept for r in got) == 1


def test_empty_table(spark):
    assert X.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chunks_cover_the_text(spark):
    text = "One. two three! " * 500 + "x" * 9000 + " end"
    df = spark.createDataFrame([(text,)], "t string")
    chunks = df.select(X.chunks_of(df.t)).first()[0]
    assert "".join(chunks) == text and max(map(len, chunks)) <= X.MAX_CHUNK
    moved = df.select(X.chunks_of(df.t.substr(17, 10**6))).first()[0]  # chunks fall into step again
    assert set(chunks) & set(moved)


def test_query_equals_sql(spark, compare):
    assert compare(spark, X.op1_exact_dedup, X.SQL, "/root/testdata/sf0.01")
