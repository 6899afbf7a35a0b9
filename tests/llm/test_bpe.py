import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "a", "Hello  world\n\n  x", "'s't don't", "é" * 300, "<|endoftext|> x", "日本語 テキスト", "\x1c\x85  a　", "x" * 5000, "ab1!" * 2000, "\x00\x01", "😀 👍🏽 a"]


@pytest.fixture(scope="module")
def v():
    return bpe.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def library(v):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.rank, special_tokens={})


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (1, "twice")], "doc_id bigint, text string")
    docs = docs.unionByName(extra)
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encode_documents(docs).collect()), key=repr) == sorted(want, key=repr)


def test_round_trip(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH).collect()}
    assert got == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    assert bpe.encode_documents(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abthing e!é\n'0", max_size=200))
def test_texts(v, library, text):
    got = bpe.Encoder(v, P.PATTERN).encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == library.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=80), st.binary(max_size=9), st.integers(0, 80), st.integers(0, 6))
def test_appends_and_edits(v, raw, other, at, removed):
    table = bpe.PrefixTable(v, raw)
    assert table.ids() == library_piece(v, raw)
    table.append(other)
    assert table.ids() == library_piece(v, raw + other)
    at = min(at, len(raw))
    new = (raw + other)[:at] + other + (raw + other)[at + removed :]
    table.edit(at, min(removed, len(raw + other) - at), other)
    assert table.data == new and table.last == bpe.PrefixTable(v, new).last


def library_piece(v, raw):
    """Plain merging, lowest rank first, leftmost of equals."""
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while True:
        ranks = [v.rank.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:], strict=False)]
        if not ranks or min(ranks) == 1 << 30:
            return [v.rank[p] for p in parts]
        i = ranks.index(min(ranks))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_an_edit_costs_its_surroundings(v):
    table = bpe.PrefixTable(v, b"the thing and another thing " * 200)
    assert table.edit(2800, 1, b"xy") < 200


def test_pair_check_in_numpy_is_the_plain_one(v):
    rng = np.random.default_rng(1)
    u, t = rng.integers(0, len(v.tokens), (2, 3000))
    assert v.all_beside(u, t).tolist() == [v.beside(int(a), int(b)) for a, b in zip(u, t, strict=True)]
