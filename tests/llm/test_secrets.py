import hashlib
import re

from pyspark.sql import functions as F

from tessera.llm import secrets as X

SCHEMA = "doc_id bigint, text string, base string, spans int"
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out)


def row(i, text):
    spans = base(text)
    said = ",".join(f"{X.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return (i, *(sum(k == n for _, k, _ in spans) for n in range(3)), hashlib.sha256(said.encode()).hexdigest())


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = X.found(df).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted((row(*r) for r in rows), key=repr)
    return got


RANDOM = "q7Zp0XvB2mKd91TfYw3LsRe8"


def test_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(1000 + i, t) for i, t in enumerate([
        None, "", "token = token: abcdef", "Password:'abc.de' passwd=\"x\" SECRET= abcdefg,api_key=AAAAAA apikey:token=abcdef", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "0" * 30,
        "a" * 23, "😀é " + "a" * 24 + "g" + "0" * 50, "toKen=abcdef", "token==abcdef", "token=" + "f" * 100_000, "token=abcdef " * 2000, "key " + RANDOM + " end", "thisisanordinaryword"])]
    rows += [(5, "token=repeated"), (5, "token=repeated"), (None, "secret: nothing1")]
    got = {r.doc_id: r.spans for r in check(spark, rows)}
    assert got[1013] == f"random:4:{4 + len(RANDOM)}" and got[1014] == ""


def test_held_out_accuracy(spark):
    """Trained on one table, tried on strings it hasn't seen."""
    weights = X.model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    keys = [hashlib.sha1(str(i).encode()).hexdigest()[:32].upper() for i in range(300)]
    words = {w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() for w in re.findall("[a-z]{16,}", r.text)}
    df = spark.createDataFrame([(w, w in words) for w in [*keys, *words]], "value string, ordinary boolean")
    got = df.select("ordinary", (X.score(df.value, weights) >= X.THRESHOLD * X.MICRO).alias("random")).collect()
    assert sum(r.random != r.ordinary for r in got) / len(got) > 0.99


def test_empty(spark):
    assert check(spark, []) == []


def test_many_matches_in_one_text(spark):
    """The work grows about as the number of matches, and no block's edge loses one."""
    for n in (15, 16, 17, 255, 256, 257, 20_000):
        text = "token=abcdef 0123456789abcdef01234567 " * n
        got = check(spark, [(1, text)])[0]
        assert (got.n_assign, got.n_hex) == (n, n) and got.spans.count("random") == 0
    text = f"{RANDOM} api_key={RANDOM} " * 500
    runs = [m.span() for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", text)]
    want = [f"random:{s}:{e}" for s, e in runs if not any(a < e and b > s for a, _, b in base(text))]
    weights = X.model(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    got = X.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), weights=weights).select(X.written(F.col("spans")).alias("spans")).first()
    assert [x for x in got.spans.split(",") if x.startswith("random")] == want and len(want) == 500


def hard(n=400):
    """Random strings of several alphabets, and ordinary ones that look like them."""
    import base64
    import random

    rng = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = "read write parse token stream buffer index value node tree hash user account session config default request handler manager factory service error result total count order price customer shipping address update delete insert select table column query cache memory thread worker queue event listener callback render layout window button image upload download file path folder version release build deploy server client socket".split()
    pick = lambda k: [rng.choice(words) for _ in range(k)]
    secrets = [*("".join(rng.choices(letters, k=rng.randrange(20, 44))) for _ in range(n)), *(base64.b64encode(rng.randbytes(30)).decode() for _ in range(n)), *(rng.randbytes(16).hex().upper() for _ in range(n))]
    makes = {
        "camel case": lambda: "".join(w.title() for w in pick(4)),
        "snake case": lambda: "_".join(pick(4)),
        "path": lambda: "/usr/" + "/".join(pick(4)),
        "kebab case and year": lambda: "-".join([*pick(3), str(rng.randrange(1990, 2030))]),
        "base64 of prose": lambda: base64.b64encode(" ".join(pick(5)).encode()).decode(),
    }
    return secrets, {name: [s for s in (make() for _ in range(n)) if len(s) >= X.RUN] for name, make in makes.items()}


def rates(spark):
    weights = X.model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    secrets, negatives = hard()
    rows = [("secret", s) for s in secrets] + [(name, s) for name, some in negatives.items() for s in some]
    df = spark.createDataFrame(rows, "kind string, value string")
    got = df.select("kind", (X.score(df.value, weights) >= X.THRESHOLD * X.MICRO).alias("random")).groupBy("kind").agg(F.avg(F.col("random").cast("int")).alias("rate"), F.count("*").alias("n"))
    return {r.kind: (r.rate, r.n) for r in got.collect()}


def test_hard_negatives(spark):
    """Recall on random strings, and false alarms on what looks like them; base64 of prose isn't told apart (README)."""
    found = rates(spark)
    print(found)
    recall, named = found["secret"][0], {k: v for k, v in found.items() if k not in ("secret", "base64 of prose")}
    false = sum(r * n for r, n in named.values())
    caught = recall * found["secret"][1]
    assert recall > 0.9 and caught / (caught + false) > 0.9


def test_transitions_of_joined_words(spark):
    """Each distinct word weighed once has the transitions of all words alone and joined with the next."""
    from collections import Counter

    lists = [["password", "another_one", "Third-word"], ["password", "another_one"], ["single-"], ["_under_", "password", "password"]]
    strings = [w for words in lists for w in words]
    for words in lists:
        for a, b in zip(words, words[1:], strict=False):
            strings += [a[0].upper() + a[1:].lower() + b[0].upper() + b[1:].lower(), *(a + j + b for j in X.JOINTS if j)]
    place = lambda c: X.ALPHABET.find(c) + 1
    want = Counter(place(a) * (len(X.ALPHABET) + 1) + place(b) for s in strings for a, b in zip(s, s[1:], strict=False))
    pairs = [(w, words[i + 1] if i + 1 < len(words) else None) for words in lists for i, w in enumerate(words)]
    found = X.transitions(X.ordinary_strings(spark.createDataFrame(pairs, "word string, next string"))).collect()
    assert {r["pair"]: r["count"] for r in found} == want
