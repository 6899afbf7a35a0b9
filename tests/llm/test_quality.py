import math
from collections import Counter

import xxhash

from tessera.llm import quality as X

SCHEMA = "doc_id bigint, text string, `row` string, words int, score string"
B = 64


def words_of(t):
    return (t or "").encode().split() and [w.decode() for w in t.encode().split()]


def xx(*parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=h)
    return (h - 2**64 if h >= 2**63 else h) % B


def grams(w):
    return [xx(x) for x in w] + [xx(a, b) for a, b in zip(w, w[1:], strict=False)]


def brute(rows, good, threshold):
    raw = Counter(g for _, t in rows for g in grams(words_of(t)))
    tgt = Counter(g for i, t in rows if i in good for g in grams(words_of(t)))
    n_raw, n_good = sum(raw.values()) or 1, sum(tgt.values())
    weight = {b: round(math.log((tgt[b] + B * (raw[b] / n_raw)) / (n_good + B) / (raw[b] / n_raw)) * 1e6) for b in raw}
    out = []
    for i, t in rows:
        t, w = t or "", words_of(t)
        lines = [x for x in t.split("\n") if words_of(x)]
        win = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        n = Counter(win)
        rep = {k + d for k, x in enumerate(win) if n[x] > 1 for d in range(5)}
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        g = grams(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), failed, not failed and sum(weight[b] for b in g) >= round(threshold * 1e6) * len(g)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def check(spark, rows, good, threshold):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id bigint, quality int")
    got = X.judge(docs, labels, threshold, B).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, good, threshold)
    return got


def test_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(900, None), (901, ""), (902, " \n\t"), (None, "a b c d e f g h i j k"), (903, "ab " * 30000), (904, "é ß\n\né ß\nx <|> " * 3), (904, "é ß"), (905, "a b c d e f a b c d e f g h i j k l m n o p q r s t u v w x y z 1 2 3 4 5 6 7 8 9 0 11 12 13 14 15 16")]
    got = check(spark, rows, set(range(0, 200, 3)), -0.01)
    assert 0 < sum(r.kept for r in got) < len(got)


def test_no_labels_and_empty(spark):
    check(spark, [(1, "one two three four five six seven eight nine ten")], set(), -0.1)
    assert check(spark, [], {1}, -0.1) == []


def test_clean_documents_stay_and_junk_goes(spark):
    d = "/root/testdata/sf0.1"
    got = X.op4_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").toPandas()
    got = got[~got.base_failed]
    assert got[got.quality == 1].kept.mean() > 0.999 and got[got.quality == 0].kept.mean() < 0.05


def brute_apart(rows, good, threshold):
    """doc_id and kept: every document by the counts of the others."""
    own = [Counter(grams(words_of(t))) for _, t in rows]
    raw, tgt = Counter(), Counter()
    target = {t or "" for i, t in rows if i in good}
    for t in {t or "" for _, t in rows}:
        raw.update(grams(words_of(t)))
        tgt.update(grams(words_of(t)) if t in target else {})
    plain = {r[:7]: 0 for r in brute(rows, good, threshold)}
    out = []
    for (i, t), c in zip(rows, own, strict=True):
        g, n = int((t or "") in target), sum(c.values())
        weight = {b: round(math.log((tgt[b] - g * k + X.PRIOR) / ((sum(tgt.values()) - g * n) * (raw[b] - k) / max(sum(raw.values()) - n, 1) + X.PRIOR)) * 1e6) for b, k in c.items()}
        failed = next(r[6] for r in plain if r[0] == i and r[1] == len(words_of(t)))
        out.append((i, n, not failed and sum(weight[b] * k for b, k in c.items()) >= round(threshold * 1e6) * n))
    return sorted(out, key=repr)


def apart(spark, rows, good, threshold):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id bigint, quality int")
    return X.verdicts(docs, labels, threshold, B).collect()


def test_own_counts_are_left_out(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(900, None), (901, ""), (903, "ab " * 3000), (None, "a b c d e f g h i j k")]
    good = set(range(0, 200, 3))
    got = apart(spark, rows, good, -0.01)
    assert sorted(((r.doc_id, max(0, 2 * r.n_words - 1), r.kept) for r in got), key=repr) == brute_apart(rows, good, -0.01)
    assert 0 < sum(r.kept for r in got) < len(got)
    assert apart(spark, [], {1}, -0.1) == [] and len(apart(spark, rows[:5], set(), -0.1)) == 5


def test_good_documents_left_out_of_the_target_stay(spark):
    for sf, share in [("0.001", 2), ("0.01", 2), ("0.01", 5), ("0.1", 2), ("0.1", 50)]:
        d = f"/root/testdata/sf{sf}"
        labels = spark.read.parquet(f"{d}/labels.parquet")
        fitted = labels.where(f"pmod(xxhash64(doc_id, 7), {share}) = 0")
        got = X.verdicts(spark.read.parquet(f"{d}/documents.parquet"), fitted).join(labels, "doc_id").join(fitted.select("doc_id"), "doc_id", "left_anti").toPandas()
        got = got[~got.base_failed & (got.quality == 1)]
        assert len(got) > 20 and got.kept.mean() > 0.98, (sf, share, len(got), got.kept.mean())


def test_many_copies_without_labels_stay(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    labelled, texts = {r.doc_id for r in labels.collect()}, {r.doc_id: r.text for r in docs.collect()}
    n_of = Counter(texts.values())
    before = sorted((r.doc_id, r.score) for r in X.verdicts(docs, labels).collect() if r.kept)
    clean = [(texts[i], score) for i, score in before if i not in labelled and n_of[texts[i]] == 1][:2]
    assert len(clean) == 2
    for text, score in clean:
        n = len(texts) // 2  # a third of all rows
        copies = spark.createDataFrame([(10000000 + i, text) for i in range(n)], "doc_id bigint, text string")
        got = X.verdicts(docs.select("doc_id", "text").unionByName(copies), labels).collect()
        got = [r for r in got if r.doc_id >= 10000000]
        assert len(got) == n and all(r.kept and abs(r.score - score) < 1e-9 for r in got)


def test_blanks_and_symbols_of_every_kind(spark):
    """What splitting and counting by patterns must find in texts as in Python."""
    blanks = "\t\n\x0b\f\r "
    rows = [(i, t) for i, t in enumerate([*blanks, blanks, f"{blanks}a{blanks}b{blanks}", "\x85a\xa0b c\x1fd \x1c e", "a\r\nb\r\na\n \t\na", "[^]\\-#*$%&|<>", "# * $ % & | < > ## é# 😀<", "\x00 a\x00b", "&& ]] -- ^^", f"one{blanks}two " * 9])]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = []
    for i, t in rows:
        w = t.encode().split()
        lines = [x for x in t.split("\n") if x.encode().split()]
        win = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        rep = {k + d for k, x in enumerate(win) if win.count(x) > 1 for d in range(5)}
        want.append((i, len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), len(w) < 10 or 100 * len(rep) > 20 * len(w)))
    assert sorted(map(tuple, X.verdicts(docs, labels).select(*counts).collect())) == want


def test_no_character_is_looked_up_in_a_map(spark):
    plan = X.base_counts(X.with_words(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), "doc_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and "split(" in plan
