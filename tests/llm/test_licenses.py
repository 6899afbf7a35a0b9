import random
import re

from tessera.llm import licenses as X

SCHEMA = "doc_id bigint, text string, findings string, n int"


def words(text):
    return [w.lower() for w in re.findall(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+", text)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return {r.doc_id: [tuple(f) for f in r.findings] for r in X.scan(df.repartition(3)).collect()}


def brute_notices(text):
    """Every notice as a regular expression over the whole text; of overlapping ones the longest."""
    found = []
    for name, phrases in X.NAMES.items():
        for lead in X.LEADS:
            for article in ("", " the"):
                for p in phrases:
                    w = words(f"{lead}{article} {p}")
                    pattern = r"(?<![^\W_])" + r"(?:(?![^\W_])[\x00-\x7f])+".join(w) + r"(?![^\W_])"
                    found += [(len(w), name, *m.span()) for m in re.finditer(pattern, text, re.I | re.A)]
    found.sort(key=lambda f: (-f[0], f[1], f[2]))
    kept = []
    for f in found:
        if all(f[3] <= k[2] or f[2] >= k[3] for k in kept):
            kept.append(f)
    return sorted((name, s, e) for _, name, s, e in kept)


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.1"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = {r.doc_id: r for r in X.op8_license_scan(spark, d).collect()}
    assert got.keys() == docs.keys()
    some = 0
    for i, text in docs.items():
        want = brute_notices(text) if re.search("under", text, re.I) else []
        spans = sorted((n, int(s), int(e)) for n, s, e in (x.split(":") for x in got[i].spans.split(",") if x))
        assert spans == want, i
        some += bool(want)
    assert some > 200


def test_edited_texts(spark):
    """A text stays found while a tenth of its words change; matched never exceeds the longest common subsequence."""
    rng, rows, want = random.Random(3), [], {}
    for i, (name, text) in enumerate(sorted(X.TEXTS.items()) * 4):
        w = text.split()
        for _ in range(rng.randrange(len(w) // 10)):
            at = rng.randrange(len(w))
            w[at : at + rng.choice([0, 1])] = rng.choice([[], ["edited"], ["é"]])
        prose = [f"p{rng.randrange(500)}" for _ in range(400)]
        at = rng.randrange(400)
        rows.append((i, " ".join(prose[:at] + w + prose[at:])))
        want[i] = (name, lcs(words(text), words(" ".join(w))))
    got = run(spark, rows)
    for i, (name, most) in want.items():
        best = max(got[i], key=lambda f: f[3])
        assert best[0] == name and 0.95 * most <= best[3] <= most, (i, name, got[i], most)


def test_edges(spark):
    twice = X.MIT + " and once more " + X.MIT
    mix = "é" * 50 + " Released under the MIT-License! " + X.ISC
    rows = [(1, None), (2, ""), (3, "MIT License"), (4, twice), (5, mix), (6, "licensed under cc by xx 4.0"), (7, "the software " * 60_000), (None, "licensed under\nCC BY-NC 4.0"), (8, X.MIT), (8, X.MIT)]
    got = run(spark, rows)
    assert all(got[i] == [] for i in (1, 2, 3, 6, 7))
    assert [f[0] for f in got[4]] == ["MIT", "MIT"] and all(f[3] == f[4] for f in got[4])
    assert [f[0] for f in got[5]] == ["MIT", "ISC"] and mix[got[5][0][1] : got[5][0][2]] == "Released under the MIT-License"
    assert [f[0] for f in got[None]] == ["CC-BY-NC-4.0"] and len(got[8]) == 1
    assert run(spark, []) == {}


def test_chunks_without_a_seed(spark):
    """No text of a task has three words of a template together, or only some have."""
    for rows in ([(1, "plain text here")], [(1, "plain text here"), (2, None), (3, "one two")], [(1, "x " * 9), (2, X.MIT)]):
        got = run(spark, rows)
        assert {i for i, found in got.items() if found} == {i for i, t in rows if t == X.MIT}


def test_increasing():
    rng = random.Random(1)
    for _ in range(200):
        v = rng.sample(range(30), rng.randrange(12))
        best = [1] * len(v)
        for i in range(len(v)):
            best[i] = 1 + max((best[j] for j in range(i) if v[j] < v[i]), default=0)
        got = [v[i] for i in X.increasing(v)]
        assert got == sorted(set(got)) and len(got) == max(best, default=0)


def test_rights_lines_and_tags(spark):
    d = "/root/testdata/sf0.1"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    lines = 0
    for r in X.op8_license_scan(spark, d).collect():
        want = [f"All-rights-reserved:{m.start()}:{m.end()}" for m in re.finditer(r"\bAll rights reserved\b", docs[r.doc_id], re.I)]
        assert r.rights == ",".join(want)
        lines += len(want)
    assert lines >= 66
    got = run(spark, [(1, "# SPDX-License-Identifier: MIT\ncode"), (2, "// SPDX-License-Identifier: CC-BY-NC-4.0"), (3, "SPDX-License-Identifier: none")])
    assert [[f[0] for f in got[i]] for i in (1, 2, 3)] == [["MIT"], ["CC-BY-NC-4.0"], []]


def test_other_wordings(spark):
    """Terms of a license, short names, and a header that states no version."""
    said = {
        "Released under the terms of the MIT license.": ["MIT"],
        "distributed under the terms of the GPL v3": ["GPL-3.0"],
        "licensed under the LGPL-2.1": ["LGPL-2.1"],
        "Released under the Unlicense": ["Unlicense"],
        "available under Apache-2.0": ["Apache-2.0"],
        "SPDX-License-Identifier: CC0-1.0": ["CC0-1.0"],
        X.GPL_HEADER.format(n=""): ["GPL"],
        X.GPL_HEADER.format(n=3): ["GPL-3.0"],
        "under the terms of the agreement": [],
    }
    got = run(spark, list(enumerate(said)))
    assert {t: [f[0] for f in got[i]] for i, t in enumerate(said)} == said


def test_names_that_stand_alone(spark):
    """Short names without a lead-in, and in prose."""
    said = {
        "released under the MIT licence": ["MIT"],
        "Apache License v2.0": ["Apache-2.0"],
        "This is GPLv3.": ["GPL-3.0"],
        "MIT licensed": ["MIT"],
        "the BSD-3-Clause license applies": ["BSD-3-Clause"],
        "GPLv3, AGPLv3 and GPLv2": ["GPL-3.0", "AGPL-3.0", "GPL-2.0"],
        "GPLv33 xGPLv3 MIT-licensee licensed MIT": [],
        "licensed under the GPLv3": ["GPL-3.0"],
    }
    got = run(spark, list(enumerate(said)))
    assert {t: [f[0] for f in got[i]] for i, t in enumerate(said)} == said
