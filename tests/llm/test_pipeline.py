import base64
import hashlib
import re
from collections import Counter

import public_tokenizers as P
import tiktoken

import corpus_pipeline as X
from tessera.llm.mixing import mix
from tessera.llm.quality import op4_quality_rules
from test_ngram_join import brute as near

D = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    """Each stage on what the one before kept; verdicts and draws as in the operators, which have tests of their own."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in op4_quality_rules(spark, D).collect() if r.kept}
    assert 0 < len(kept) < len(rows)
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", rows[i].text), i)
    single = sorted(first.values())
    apart = sorted(i for i, _, root in near([(i, rows[i].text) for i in single]) if i == root)
    wants = [sorted(kept), single, apart]
    now = docs
    for (_, step), want in zip(X.STAGES, wants, strict=False):
        now = X.stage(step(spark, now, D), "test")
        assert now.columns == docs.columns and sorted(r.doc_id for r in now.collect()) == want
        assert all(r == rows[r.doc_id] for r in now.collect())
    copies = {r.doc_id: r.copies for r in mix(now).collect() if r.copies}
    now = X.stage(X.STAGES[3][1](spark, now, D), "test")
    assert now.columns == docs.columns and Counter(r.doc_id for r in now.collect()) == copies
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    bpe = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = X.STAGES[4][1](spark, now, D).collect()
    assert Counter(r.doc_id for r in got) == copies
    for r in got:
        ids = bpe.encode_ordinary(rows[r.doc_id].text)
        assert r.n_tokens == len(ids) and bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest()


def test_nulls_and_repeated_rows(spark):
    text = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"other{i}" for i in range(40))
    rows = [(1, text, None, "a", 1), (1, text, None, "a", 1), (2, None, "en", None, None), (None, other, "en", None, 2), (None, other, "en", None, 2), (3, other, "en", "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    good = X.of_quality(spark, docs, D)
    assert good.where("text IS NULL").count() == 0
    once = X.one_of_equals(spark, docs, D)
    assert sorted((r.doc_id for r in once.collect()), key=str) == [1, 2, 3]
    assert X.one_of_near_copies(spark, once, D).count() == 3
    assert {r.doc_id for r in X.mixed(spark, once, D).collect()} <= {1, 3}
    for _, step in X.STAGES:
        assert step(spark, docs.limit(0), D).count() == 0


def test_one_of_each_group_of_near_copies_stays(spark):
    """Where a doc_id stands for several texts, or is missing, too."""
    x, y, z = ([f"{c}{i}" for i in range(60)] for c in "xyz")
    near = lambda w, end: " ".join([*w, end])
    rows = [(5, near(x, "one")), (7, near(x, "two")), (5, near(y, "one")), (3, near(y, "two")), (None, near(z, "one")), (None, near(z, "two")), (None, near(x, "three"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.text[0]) for r in X.one_of_near_copies(spark, docs, D).collect()), key=str)
    assert got == [(3, "y"), (5, "x"), (None, "z")]


def test_texts_that_only_their_content_tells_apart_both_stay(spark):
    from test_exact_dedup import ALIKE

    docs = spark.createDataFrame([(1, ALIKE[0], "x"), (2, ALIKE[1], "y"), (3, ALIKE[0] + "\n", "z"), (4, ALIKE[0], "w")], "doc_id bigint, text string, _kept string")
    assert sorted(r.doc_id for r in X.one_of_equals(spark, docs, D).collect()) == [1, 2, 3]


def test_run_leaves_no_folder_but_the_last_stage(spark):
    import os

    from tessera.staging import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    found = X.run(spark, D)
    assert {f.rpartition("-")[0] for f in set(os.listdir(folder)) - before} == {"mixing-sources"}
    assert found.count() > 0 and found.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
