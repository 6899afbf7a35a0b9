import random

import numpy as np
import pytest

from tessera.llm import ngram_join as X
from tessera.llm.components import components

SCHEMA = "doc_id bigint, text string, class string, n int, a string"


def shingle_set(text):
    words = [w.lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w.encode()).decode() for w in (x.decode() for x in (text or "").encode().split())]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent=75):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    lists = {}
    for i, s in enumerate(sets):
        near = {j for g in s for j in lists.get(g, ())}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                up[find(i)] = find(j)
        for g in s:
            lists.setdefault(g, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, X.component_ids(df, **kw).collect()), key=repr)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, X.op3_ngram_jaccard_join(spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == brute(rows) and sum(r[0] != r[2] for r in got) > 20


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_edits(spark, seed):
    """Random walks of edits around the threshold, on a common passage: links that only some members have."""
    rng, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(30)]
    for g in range(12):
        words = [f"w{g}_{i}" for i in range(rng.choice([8, 40, 90]))]
        for _ in range(12):
            words = [w if rng.random() > 0.02 else f"x{rng.random()}" for w in words]
            at = rng.randrange(len(words))
            rows.append((len(rows) * 3 % 1009, " ".join(words[:at] + passage * rng.choice([0, 1]) + words[at:])))
    assert run(spark, rows) == brute(rows)
    assert any(r[0] != r[2] for r in run(spark, rows))


def test_the_search_alone_finds_all_links(spark, monkeypatch):
    """Without first links every link comes from the T-occurrence search."""
    rng = random.Random(5)
    base = [[f"w{g}_{i}" for i in range(60)] for g in range(4)]
    rows = [(i, " ".join(w if rng.random() > 0.01 else f"x{rng.random()}" for w in base[i % 4])) for i in range(60)]
    none = lambda classes, *a: classes.sparkSession.createDataFrame([], "a bigint, b bigint")
    monkeypatch.setattr(X, "vote_links", none)
    monkeypatch.setattr(X, "leader_pairs", none)
    for mu in (0.01, 5.0):
        monkeypatch.setattr(X, "MU", mu)
        assert run(spark, rows) == brute(rows)


def thue_morse(k):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(1 << k))


def test_words_that_collide_in_powers_of_two(spark):
    """A polynomial modulo a power of two has one value for a Thue-Morse word and its complement, whatever its base."""
    word = thue_morse(10)
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([word] * 5)), (2, " ".join([other] * 5)), (3, word), (4, other), (5, " ".join(thue_morse(11))), (6, " ".join(thue_morse(11)).translate(str.maketrans("ab", "ba")))]
    got = run(spark, rows)
    assert got == brute(rows) and [r[2] for r in got][:4] == [1, 2, 3, 4]


#: Two words with one value in the tabulation hash that was used before.
ALIKE = ["hrlpstprgprmeuqxvcybyitmzmzolbpinunmlsskatwwrswgsjcucznannbtbwki", "srlpsairwrruheqaycsbyixmzxzedbgiyjqslnhvatwwssuusjppcznaynbybsri"]


def test_words_that_collided_in_tables(spark):
    rows = [(1, " ".join([ALIKE[0]] * 5)), (2, " ".join([ALIKE[1]] * 5))]
    got = run(spark, rows)
    assert got == brute(rows) and [r[2] for r in got] == [1, 2]


def test_a_group_just_below_the_threshold_emits_no_pairs():
    """Members near to a leader, none near to another member: what is looked at together doesn't grow with the square."""
    rng, made = random.Random(3), []
    for n in (100, 200, 400):
        base = list(range(200))
        sets = {0: base}
        for c in range(1, n):
            gone = {x for at in rng.sample(range(0, 200, 5), 7) for x in range(at, at + 5)}
            sets[c] = [x for x in base if x not in gone] + [1000 * c + i for i in range(35)]
        entries = sorted((h, len(s), c) for c, s in sets.items() for h in s)
        votes = {c: sum(h < 200 for h in s) for c, s in sets.items()}
        size = X.np.array([e[1] for e in entries])
        column = lambda f: X.np.array([f(h, c) for h, _, c in entries])  # noqa: B023, E731
        led = lambda h, c: (0 if h < 200 else X.SHORT) | (X.PLAIN if votes[c] >= X.least_overlap(200, 75) else 0)  # noqa: B023, E731
        e = {"hashes": column(lambda h, c: h), "ids": column(lambda h, c: c), "n": size, "m": size, "roots": column(lambda h, c: c), "leads": column(lambda h, c: 0), "votes": column(lambda h, c: votes[c]), "aside": column(lambda h, c: 0), "extra": column(led)}
        made.append(sum(len(p["q"]) for p in X.meetings(e, 75)))
    assert made == [0, 0, 0]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "A b c d e"), (8, "a B c\nd e"), (9, "É b c d e"), (10, "é b c d e"), (None, "one"), (None, "alone here"), (11, "same row"), (11, "same row"), (12, "w " * 50_000), (13, "w w w w w w")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(1, "a b")]) == [(1, 1, 1)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query_equals_sql(spark, compare):
    assert compare(spark, X.op3_ngram_jaccard_join, X.SQL, "/root/testdata/sf0.01")


def test_shingles_are_the_same_in_parts_of_any_size(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "B", "cc", "x" * 90], n)) for n in (0, 1, 4, 5, 6, 300, 2, 3000, 0, 7)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = X.shingles(data, offsets, 5)
    for size, words in ((1, 1), (50, 7), (1 << 20, 3)):
        monkeypatch.setattr(X, "SHINGLED", size)
        monkeypatch.setattr(X.A, "WORDS_AT_ONCE", words)
        assert all((a == b).all() for a, b in zip(X.shingles(data, offsets, 5), whole, strict=True))
    assert sorted(set(whole[0].tolist())) == [i for i, t in enumerate(texts) if t]
    assert len(X.shingles(data[:0], np.zeros(1, np.int64), 5)[0]) == 0
