"""Vector codes against brute force over all entries, and the filter against what it may leave out."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import vectors as V


def brute(rows, parts=V.PARTS, entries=V.ENTRIES, rounds=V.ROUNDS, scale=V.SCALE):
    """By the contract, in plain integers: (vec_id, code, error, label_error), and the codebooks' digest."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    cut = lambda v, p: v[p * len(v) // parts : (p + 1) * len(v) // parts]
    first = [v for _, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))[:entries]]
    books = [[cut(v, p) for v in first] for p in range(parts)]
    nearest = lambda q, book: min((sum((a - b) ** 2 for a, b in zip(q, e, strict=True)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            for j, m in members.items():
                books[p][j] = [sum(x) // len(m) for x in zip(*m, strict=True)]
    out, by_label = [], defaultdict(int)
    for i, v, label in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label]) for i, c, e, label in out), key=repr), digest


def run(spark, rows, tmp_path, name="t"):
    folder = str(tmp_path / name)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    found = V.op13_vector_codes(spark, folder).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=repr), {r.codebooks_sha256 for r in found}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, compare, sf):
    assert len(compare(spark, V.op13_vector_codes, V.SQL, f"/root/testdata/sf{sf}")) == 500


def test_odd_rows(spark, tmp_path):
    pick = np.random.default_rng(1)
    f32 = lambda *shape: pick.normal(size=shape).astype(np.float32).astype(float).tolist()
    rows = [(i, v, i % 3 or None) for i, v in enumerate(f32(60, 16))]
    same = f32(16)
    rows += [(100 + i, same, 7) for i in range(40)]  # ties and repeats of one vector
    rows += [(None, f32(16), 1), (5000, None, 1), (5001, [None, *f32(15)], 1), (5002, [float("nan"), *f32(15)], 1), (5003, [*f32(15), float("-inf")], 2)]
    rows += [(200, [-0.0] * 16, None), (201, [-1e-9] * 16, None), (202, [9000.5] * 16, 3), (203, [-9000.5] * 16, 3)]
    got, digests = run(spark, rows, tmp_path)
    want, digest = brute(rows)
    assert got == want and digests == {digest}


def test_few_and_no_rows_and_short_vectors(spark, tmp_path):
    few = [(3, [0.5] * 8, 1), (1, [0.25] * 8, None), (2, [0.25] * 8, None)]
    got, digests = run(spark, few, tmp_path, "few")
    want, digest = brute(few)
    assert got == want and digests == {digest}
    assert run(spark, [], tmp_path, "none") == ([], set())
    assert run(spark, [(1, None, 1)], tmp_path, "nothing usable") == ([], set())
    uneven = [(i, [0.1 * i] * (1 + i % 11), 1) for i in range(30)]
    filled = [(i, [*v, *[0.0] * (16 - len(v))], label) for i, v, label in uneven]
    as_float = [(i, np.float32(v).astype(float).tolist(), label) for i, v, label in filled]
    got, digests = run(spark, uneven, tmp_path, "uneven")
    want, digest = brute(as_float)
    assert got == want and digests == {digest}
    assert [r[1:3] for r in run(spark, [(1, [], 1), (2, [], 2)], tmp_path, "empty")[0]] == [("00" * 8, 0)] * 2


def test_huge_components_have_a_bound(spark, tmp_path):
    rows = [(i, [3e38 * (-1) ** i] * 64, 1) for i in range(3)] + [(9, [1.0] * 64, 2)]
    got, _ = run(spark, rows, tmp_path)
    assert len(got) == 4 and all(0 <= e <= V.LARGEST and 0 <= s <= V.LARGEST for _, _, e, s in got)


def test_extra_columns_and_expanding(spark):
    pick = np.random.default_rng(4)
    table = pick.normal(size=(200, 16))
    rows = [(i, v.tolist(), 1, "x", b"y", 1.0) for i, v in enumerate(table)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int, code string, body binary, error double")
    codes, books = V.compressed(df)
    back = {r.vec_id: np.array(r.vector) for r in V.expanded(codes, books).collect()}
    error = {r.vec_id: r.error for r in codes.collect()}
    assert codes.columns == ["vec_id", "label", "code", "error"] and len(back) == 200
    for i, v in back.items():
        assert abs(np.square((v - 0.5 / V.SCALE) * V.SCALE - np.floor(table[i] * V.SCALE)).sum() - error[i]) < 1e-3 * (1 + error[i])


@pytest.mark.parametrize("scale", [3, 1000, 1 << 26])
def test_the_filter_leaves_no_nearest_entry_out(scale):
    pick = np.random.default_rng(scale)
    for count in (1, 2, 5, 16):
        entries = pick.integers(-scale, scale, (count, 8))
        queries = np.concatenate([pick.integers(-scale, scale, (300, 8)), entries, (entries + entries[::-1]) // 2])
        cells = V.Cells(entries)
        lower, upper = cells.bounds(queries)
        exact = np.square(queries[:, None, :] - entries[None]).sum(axis=2)
        assert (lower <= exact).all() and (exact <= upper).all()
        best, distance = cells.nearest(queries)
        assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    if scale > 3:
        assert (lower <= upper.min(axis=1, keepdims=True)).mean() < 0.5  # the filter does leave entries out
