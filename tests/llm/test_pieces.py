"""SentencePiece by backtracking against the library itself, and its parts against plain merging."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.pieces import LONG, NORMAL, Decoder, Encoder, Pieces, decode, encode, op11_sentencepiece, read_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a\tb\n", "▁", "a▁ b", "\0x", "日本語𠮷", "<s>", "<0x0A>", "a\u3000b", "\ufeffx", "\r\n", " " * 100, " " * 999 + "a", "a" * 5000, "=-" * 3000, "日" * 3000, " \n" * 500, "é" * 200, "\U0001f600" * 70]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(read_pieces(PATH))


@pytest.fixture(scope="module")
def decoder():
    return Decoder(read_pieces(PATH))


def ids_of(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def test_odd_texts(encoder, decoder, library):
    for text, packed in zip(ODD, encoder.encode(ODD), strict=True):
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert ids_of(packed) == ids and decoder.decode(packed) == library.decode(ids), text[:20]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" ▁\n\tabcthe12éß日本𠮷.,;:_-ATHIN\0", max_size=80))
def test_random_texts(encoder, library, text):
    assert ids_of(encoder.encode([text])[0]) == library.encode(text, add_bos=True, add_eos=True)


def test_texts_of_pieces(encoder, decoder, library):
    """Pieces in a random order give many neighbours that merge otherwise."""
    pick, names = random.Random(3), read_pieces(PATH).names
    for _ in range(3000):
        text = "".join(names[pick.randrange(259, len(names))] for _ in range(pick.randint(1, 7)))
        packed = encoder.encode([text])[0]
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert ids_of(packed) == ids and decoder.decode(packed) == library.decode(ids), text


def test_ids_that_no_text_has(decoder, library):
    pick = random.Random(5)
    for _ in range(3000):
        ids = [pick.choice([pick.randrange(0, 259), pick.randrange(32000)]) for _ in range(pick.randint(0, 9))]
        assert decoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_backtracking_equals_merging():
    """A small vocabulary in which the longest piece is often wrong, with equal scores; parts of any length."""
    pick = random.Random(7)
    for _ in range(40):
        names = ["<unk>", "a", "b", "c"]
        while len(names) < 16:
            made = pick.choice(names[1:]) + pick.choice(names[1:])
            names += [made] * (made not in names)
        scores = [0.0, *(-float(pick.randrange(6)) for _ in names[1:])]
        p = Pieces(names, scores, [2, *[NORMAL] * (len(names) - 1)], 0, 0)
        e = Encoder(p)
        texts = ["".join(pick.choice("abc") for _ in range(pick.randint(1, LONG))) for _ in range(60)]
        for text, numbers in zip(texts, e.pieces(texts), strict=True):
            want = p.merged(text)
            assert [e.list[i] for i in numbers] == want and [e.list[i] for i in e.long_pieces(text)] == want


def test_memory_is_bounded(library, monkeypatch):
    from tessera.llm import pieces

    monkeypatch.setattr(pieces, "REMEMBERED", 20_000)
    monkeypatch.setattr(pieces, "PAIRS", 50)
    e, pick = Encoder(read_pieces(PATH)), random.Random(2)
    for _ in range(30):
        texts = [" ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(1, 90))) for _ in range(9)) for _ in range(4)]
        assert [ids_of(x) for x in e.encode(texts)] == library.encode(texts, add_bos=True, add_eos=True)
        assert len(e.known) + len(e.older) < 400 and not any(len(k) > LONG for k in [*e.known, *e.older])


def test_query_equals_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op11_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_nulls_repeats_extra_columns_and_round_trip(spark, library):
    long = "word " * 40_000
    rows = [(1, None, "x"), (1, "a b", "y"), (1, "a b", "y"), (None, "", None), (2, long, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = encode(docs, PATH, decoded=True)
    want = sorted(((i, library.encode(t or "", add_bos=True, add_eos=True), t or "") for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, ids_of(r.ids), r.decoded) for r in found.collect()), key=repr) == want
    assert sorted((r.decoded for r in decode(found, PATH).collect())) == sorted(t or "" for _, t, _ in rows)
    assert decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), PATH).first().decoded == ""
    none = encode(docs.limit(0), PATH)
    assert none.count() == 0 and none.columns == ["doc_id", "ids"]
