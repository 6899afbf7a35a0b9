import hashlib
from collections import Counter

from tessera.llm import substring_dedup as X

SCHEMA = "doc_id bigint, text string, key string, size int, body string"


def brute(rows, size):
    lists = [(t or "").encode().split() for _, t in rows]
    n = Counter(tuple(w[i : i + size]) for w in lists for i in range(len(w) - size + 1))
    out = []
    for (i, _), w in zip(rows, lists, strict=True):
        gone = {k + d for k in range(len(w) - size + 1) if n[tuple(w[k : k + size])] > 1 for d in range(size)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, size=35, parts=5):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(parts)
    got = X.without_repeats(df, size).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got), key=repr)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, X.op5_substring_dedup(spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == brute([tuple(r) for r in docs], 35) and any(r[2] for r in got)


def test_edges(spark):
    long = " ".join(str(i * i % 997) for i in range(70_000))
    rows = [(1, None), (2, ""), (3, " \n\x0b"), (4, "a b c d e"), (5, "x a b c\td e f"), (6, "a a a a a a"), (7, long), (8, "z " + long[-3000:]), (None, "q a b c"), (None, "other text here"), (9, "é ß ü é ß ü"), (10, "twice this row"), (10, "twice this row")]
    for size in (3, 4):
        assert run(spark, rows, size) == brute(rows, size)
    assert run(spark, rows, 3, 1) == brute(rows, 3)
    assert run(spark, [], 3) == [] and run(spark, [(1, "a b")], 3) == [(1, 2, 0, hashlib.sha256(b"a b").hexdigest())]


def test_words_that_collide_in_powers_of_two(spark):
    """Thue-Morse words and their complements: one value in every polynomial modulo a power of two."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([word] * 35)), (2, " ".join([other] * 35)), (3, " ".join(word)), (4, " ".join(other))]
    got = run(spark, rows)
    assert got == brute(rows, 35) and [r[2] for r in got[:2]] == [0, 0]


#: Two words with one value in the tabulation hash that was used before.
ALIKE = ["hrlpstprgprmeuqxvcybyitmzmzolbpinunmlsskatwwrswgsjcucznannbtbwki", "srlpsairwrruheqaycsbyixmzxzedbgiyjqslnhvatwwssuusjppcznaynbybsri"]


def test_words_that_collided_in_tables(spark):
    head = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{head} {ALIKE[0]}"), (2, f"{head} {ALIKE[1]}")]
    got = run(spark, rows)
    assert got == brute(rows, 35) and [r[2] for r in got] == [0, 0]


def test_remembered_words_are_bounded(monkeypatch):
    import numpy as np

    from tessera.llm import arrays as A

    monkeypatch.setattr(A, "REMEMBERED", 180 * 50)
    words, fresh = A._Words(), lambda w: int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    for k in range(40):
        some = [f"{k} {i}".encode() for i in range(20)] + [b"x" * (60 + i) for i in range(10)]
        assert words.get(some).tolist() == [fresh(w) for w in some] and len(words.known) <= 50 and max(map(len, words.known)) <= A.PLACES
    assert words.get([]).dtype == np.uint64


def test_a_missing_id_is_no_other_rows_id(spark):
    """A doc_id that is the hash of a text without one: neither row loses what the other does."""
    text, whole = "a b c d e f g a b c d e f g", " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(text,)], "t string")
    for seed in (0, 1):
        taken = df.selectExpr(f"xxhash64({seed}, t)", "xxhash64(t)").first()
        rows = [(None, text), (taken[0], whole), (taken[1], whole + " x"), (None, "other " + whole)]
        assert run(spark, rows[:3], 5) == brute(rows[:3], 5) and run(spark, rows, 5) == brute(rows, 5)


def test_query_equals_sql(spark, compare):
    assert compare(spark, X.op5_substring_dedup, X.SQL, "/root/testdata/sf0.01")
