import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import suffix_dedup as X

SCHEMA = "doc_id bigint, text string, key string, size int, body string"


def brute(rows, size):
    seen = {}
    texts = [(t or "").encode() for _, t in rows]
    for (i, _), raw in zip(rows, texts, strict=True):
        for p in range(len(raw) - size + 1):
            w = raw[p : p + size]
            seen[w] = min(seen.get(w, (i, p)), (i, p))
    out = []
    for (i, _), raw in zip(rows, texts, strict=True):
        gone = bytearray(len(raw))
        for p in range(len(raw) - size + 1):
            if seen[raw[p : p + size]] < (i, p):
                gone[p : p + size] = b"\1" * size
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, rows, size=100, core=32, parts=4, hot=X.HOT):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(parts)
    got = X.without_repeats(df, size, core, hot).collect()
    assert all(sum(e - s for s, e in zip(r.starts, r.stops, strict=True)) == r.n_removed for r in got)
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, X.op10_suffix_array_dedup(spark, "/root/testdata/sf0.01").collect()))
    assert got == brute([tuple(r) for r in docs], 100) and sum(r[2] > 0 for r in got) > 20


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_small_alphabets(spark, seed):
    rng = random.Random(seed)
    some = ["".join(rng.choice("ab") for _ in range(40)) for _ in range(5)]
    rows = [(rng.randrange(-500, 500) * 100 + i, "".join(rng.choice([*some, "a" * 30, "é\x00", "\x00" * 9, rng.choice("abc")]) for _ in range(rng.randrange(12)))) for i in range(60)]
    assert run(spark, rows, 20, 6) == brute(rows, 20)
    assert run(spark, rows, 12, 12, 1) == brute(rows, 12)


@pytest.mark.parametrize("hot", [2, 5])
def test_split_cores(spark, hot):
    """The same results however few cores count as hot, whatever repeats."""
    rng = random.Random(hot)
    some = ["".join(rng.choice("ab") for _ in range(40)) for _ in range(5)]
    rows = [(rng.randrange(-500, 500) * 100 + i, "".join(rng.choice([*some, "a" * 30, "é\x00", rng.choice("abc")]) for _ in range(rng.randrange(12)))) for i in range(60)]
    rows += [(9, "same " * 40), (9, "same " * 40)]
    assert run(spark, rows, 20, 6, hot=hot) == brute(rows, 20)
    assert run(spark, rows, 100, 32, hot=hot) == brute(rows, 100)


def test_one_line_in_many_contexts(spark):
    """Its suffixes are dealt to all buckets, and results are right."""
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    line, passage = prose(80), prose(150)
    rows = [(i, prose(150) + (line if i % 2 else passage) + prose(150)) for i in range(3000)]
    assert run(spark, rows) == brute(rows, 100)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found, often = X.repeated_cores(df, 100, 32, 16, X.HOT)
    assert 1 <= len(often) < 20
    texts = X.packed_texts(df, bytes).join(found, "key").select("key", "size", "body", "pos")
    runs = X.sorted_runs(texts, 100, 32, 16, often).where("kind = 0").select("bucket", "pos").collect()
    sizes = {}
    for r in runs:
        sizes[r.bucket] = sizes.get(r.bucket, 0) + len(X.A.unpack(r.pos))
    assert len(sizes) == 16 and max(sizes.values()) < 1.5 * sum(sizes.values()) / 16


def test_edges(spark, monkeypatch):
    long = "".join(random.Random(4).choice("abcdefgh \n") for _ in range(30_000))
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 1000), (6, long), (7, "y" + long[5000:9000] + "é" * 200), (9, "same " * 40), (9, "same " * 40)]
    want = brute(rows, 100)
    assert run(spark, rows) == want
    assert run(spark, []) == [] and run(spark, [(1, "a")]) == brute([(1, "a")], 100)
    assert len(X.without_repeats(spark.createDataFrame([(None, "z" * 150, "", 1, "")] * 2, SCHEMA)).collect()) == 2


def test_long_texts_in_pieces(monkeypatch):
    import numpy as np

    data = np.frombuffer("".join(random.Random(4).choice("abcd") for _ in range(5000)).encode(), np.uint8)
    offsets = np.array([0, 300, 300, 4100, 5000])
    whole = X.all_anchors(data, offsets, 100, 32)
    monkeypatch.setattr(X.A, "CHUNK_BYTES", 700)
    pieces = X.all_anchors(data, offsets, 100, 32)
    spread = lambda r: {(t, s): a for t, a, p, q, _ in zip(*r, strict=True) for s in range(p, q + 1)}
    assert spread(whole) == spread(pieces) and len(spread(whole)) == 201 + 3701 + 801


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="ab", max_size=6), max_size=8), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(x.encode() for x in r) for r in runs]
    coded = [[(X.common(a, b, 0), b) for a, b in zip([b"", *r], r, strict=False)] for r in runs]
    got = list(X.LoserTree([iter(r) for r in coded])) if runs else []
    assert [t for *_, t in got] == sorted(x for r in runs for x in r)
    assert all(n == X.common(a[2], b[2], 0) for a, b in zip(got, got[1:], strict=False) for n in [b[1]])
    for i, r in enumerate(runs):
        assert [t for w, _, t in got if w == i] == r


def test_a_missing_id_is_no_other_rows_id(spark):
    """A doc_id that is the hash of a text without one: neither row loses what the other does."""
    twice, whole = "0123456789abcdefghij" * 2 + "x", "".join(chr(200 + i) for i in range(60))
    taken = spark.createDataFrame([(twice,)], "t string").selectExpr("xxhash64(0, t)", "xxhash64(t)").first()
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in [(None, twice), (taken[0], whole), (taken[1], whole[::-1])]], SCHEMA)
    got = {r.doc_id: r.n_removed for r in X.without_repeats(df, 20, 6).collect()}
    assert got == {None: 20, taken[0]: 0, taken[1]: 0}
