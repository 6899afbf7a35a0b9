import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import token_counts as X

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = [None, "", " \n", "ΣΑΣ İ é", "a<|endoftext|>b <|startoftext|><|endoftext", "x" * 9000, "don't 'S 123 !!", "日本", "\x1c\x85", "ꟋꟜ", "t " * 3000]
    docs = docs.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)] + [(None, "a"), (1, "b")], "doc_id bigint, text string"))
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
    got = X.token_counts(docs.selectExpr("*", "1 as n_tokens", "'x' as n_bytes"), PATH)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert any(r[3] for r in want) and X.token_counts(docs.limit(0), PATH).count() == 0


def test_shortcut_is_proved(library):
    c = X.read_counter(PATH)
    some = sorted(c.shortcut)[::97]
    assert len(c.shortcut) > 30_000 and all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in some if c.pretokens(w) == ([w], 0))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["A", "b", "!", " ", "É", "th", "\n", "0", "ing", "'s", "'", "日", "Σ", "İ", "\x85", "<|endoftext|>"]), max_size=150).map("".join))
def test_texts(library, text):
    assert X.read_counter(PATH).count([text]) == [len(library.encode(text, add_special_tokens=False).ids)]


@given(st.binary(min_size=1, max_size=48))
@settings(max_examples=60, deadline=None)
def test_long_and_short_ways_agree(word):
    m = X.read_counter(PATH).merges
    assert [m.count_long(word)] == m.count_many([word]).tolist()
