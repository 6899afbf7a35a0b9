"""License scans by patience alignment of texts with license templates.

Words are runs of letters and digits, A-Z lower-cased; every byte beyond ASCII counts as a
letter. A template is a license's text, or a notice: a lead-in and the license's name.

1. Seeds: places of a text where three words of a template stand together, or all words of a
   shorter one, found by hash for all templates at once. A seed at word p of the template and word i of the text puts the
   template's start at i - p; seeds whose starts are near each other make a candidate window,
   and starts further apart than `SLACK` of the template make another, so a license that is
   there twice is found twice.
2. A window that holds a tenth of the template's seeds or more is aligned with the template:
   words that occur once in both are anchors, the longest increasing subsequence of them
   stays, and the gaps between anchors are aligned in the same way, where other words are
   unique in turn. Equal words next to an anchor or a gap's edge are matched outwards. What
   is matched of the template is its coverage.
3. A finding is a window whose coverage is `COVERAGE` percent or more; a notice must be there
   in full. Of findings that overlap, the one with most matched words stays, then the better
   covered, then the first by license and start.

Everything happens where the text is read: nothing is shuffled, and the templates, a constant,
travel with the code. A whole text is looked at, however long, in pieces of numpy arrays.

Defined results: a null or empty text has no findings. Rows are independent, so repeated rows,
ties and null doc_ids need no further rule. Spans are code points, the end exclusive. An empty
table gives an empty result; further columns are ignored.

Not found: notices with a word changed, and the full texts of Apache, GPL, LGPL, MPL, AGPL and
Creative Commons, which have no template.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import arrays as A
from tessera.llm.common import documents, text_of

SEED_WORDS, COVERAGE, SLACK, LEAST_SEEDS = 3, 80, 4, 10

# The wording of public licenses and of the notices that refer to them.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. """
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""
GPL_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version {n} of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
TEXTS = {
    "Apache-2.0": APACHE_HEADER,
    "BSD-2-Clause": BSD_GRANT + BSD_DISCLAIMER,
    "BSD-3-Clause": BSD_GRANT + BSD_NAMES + BSD_DISCLAIMER,
    "GPL": GPL_HEADER.format(n=""),  # no version stated
    "GPL-2.0": GPL_HEADER.format(n=2),
    "GPL-3.0": GPL_HEADER.format(n=3),
    "ISC": ISC,
    "MIT": MIT,
}
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0", "Apache License v2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "CC0-1.0": ["CC0 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL-2.0", "GPL v2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL-3.0", "GPL v3", "GPLv3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL-2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3"],
    "MIT": ["MIT License", "MIT Licence"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "MPL-2.0"],
    "Unlicense": ["Unlicense"],
}
#: What names a license without a lead-in.
ALONE = {
    "AGPL-3.0": ["AGPLv3"],
    "Apache-2.0": ["Apache License v2.0"],
    "BSD-2-Clause": ["BSD-2-Clause license"],
    "BSD-3-Clause": ["BSD-3-Clause license"],
    "GPL-2.0": ["GPLv2"],
    "GPL-3.0": ["GPLv3"],
    "LGPL-2.1": ["LGPLv2.1"],
    "LGPL-3.0": ["LGPLv3"],
    "MIT": ["MIT licensed"],
}
RIGHTS = {"All-rights-reserved": "All rights reserved"}
LEADS = ("licensed under", "released under", "distributed under", "available under", "under the terms of")

#: Each byte of a word as itself, A-Z lower-cased; all others blank.
WORD_BYTE = np.full(256, 0x20, np.uint8)
for _range in (range(0x30, 0x3A), range(0x61, 0x7B), range(0x80, 0x100)):
    WORD_BYTE[[*_range]] = [*_range]
WORD_BYTE[0x41:0x5B] = np.arange(0x61, 0x7B)


class Template:
    def __init__(self, license_id: str, text: str, notice: bool):
        raw = WORD_BYTE[np.frombuffer(text.encode(), np.uint8)]
        self.license, self.words = license_id, raw.tobytes().split()
        self.least = len(self.words) if notice else -(-COVERAGE * len(self.words) // 100)
        self.slack = 0 if notice else len(self.words) // SLACK
        self.seed_words = min(SEED_WORDS, len(self.words))
        self.seeds = seed_hashes(raw, np.array([0, len(raw)]), self.seed_words)[0]


def seed_hashes(data: np.ndarray, offsets: np.ndarray, size: int = SEED_WORDS) -> tuple[np.ndarray, ...]:
    """Hash, text and word number of every `size` words together; starts, ends and first word of the texts' words."""
    starts, ends, first = A.words_in(data, offsets)
    n = np.maximum(np.diff(first) - size + 1, 0)
    text = A.owners(n)
    at = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    head = first[:-1][text] + at
    words = A.range_hashes(A.BYTE[data], starts, ends)
    return A.range_hashes(words, head, head + size), text, at, starts, ends, first


class Templates:
    """All templates with a sorted table of their seeds for each size of seeds; names of one or two words are seeds of that size."""

    def __init__(self, texts: dict[str, str], names: dict[str, list[str]], rights: dict[str, str], alone: dict[str, list[str]]):
        leads = [f"{lead}{article}" for lead in LEADS for article in (" ", " the ")]
        self.all = [Template(k, t, False) for k, t in texts.items()]
        self.all += [Template(k, lead + name, True) for k, some in names.items() for name in some for lead in leads]
        self.all += [Template(k, f"SPDX-License-Identifier: {k}", True) for k in sorted({*texts, *names})]
        self.all += [Template(k, t, True) for k, t in rights.items()]
        self.all += [Template(k, t, True) for k, some in alone.items() for t in some]
        self.tables = {size: self.table(size) for size in sorted({t.seed_words for t in self.all})}

    def table(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, ascending, and each one's template and word number there."""
        some = [(i, t) for i, t in enumerate(self.all) if t.seed_words == size]
        hashes = np.concatenate([t.seeds for _, t in some])
        owner = np.concatenate([np.full(len(t.seeds), i) for i, t in some])
        at = np.concatenate([np.arange(len(t.seeds)) for _, t in some])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], owner[order], at[order]

    def windows(self, size: int, hashes: np.ndarray, text: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, template, first and last start of the template in words of the text) of candidate windows."""
        known, owner, at = self.tables[size]
        low = np.searchsorted(known, hashes, side="left")
        n = np.searchsorted(known, hashes, side="right") - low
        hit = np.flatnonzero(n)
        if not len(hit):
            return
        n = n[hit]
        entry = np.repeat(low[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        of, template = np.repeat(text[hit], n), owner[entry]
        start = np.repeat(place[hit], n) - at[entry]
        order = np.lexsort((start, template, of))
        of, template, start = of[order], template[order], start[order]
        slack = np.array([t.slack for t in self.all])[template]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (template[1:] != template[:-1]) | (start[1:] > start[:-1] + slack[1:])
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(of))
        need = np.array([-(-len(t.seeds) // LEAST_SEEDS) if t.slack else len(t.seeds) for t in self.all])
        for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
            if b - a >= need[template[a]]:
                yield int(of[a]), int(template[a]), int(start[a]), int(start[b - 1])


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience piles."""
    tops, piles, back = [], [], []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[pile], piles[pile] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), increasing in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        where = {w: k for k, w in enumerate(b[j:j_end], j) if in_b[w] == 1}
        unique = [(k, where[w]) for k, w in enumerate(a[i:i_end], i) if in_a[w] == 1 and w in where]
        anchors = [unique[k] for k in increasing([y for _, y in unique])]
        for x, y in anchors:
            found.append((x, y))
            todo.append((i, x, j, y))
            i, j = x + 1, y + 1
        if anchors:
            todo.append((i, i_end, j, j_end))
    return sorted(found)


def apart(found: list[tuple]) -> list[tuple]:
    """Of findings (license, start, end, matched, length) that overlap, the best; in order of start."""
    kept: list[tuple] = []
    for f in sorted(found, key=lambda f: (-f[3], -f[3] / f[4], f[0], f[1])):
        at = bisect_left(kept, f[1], key=lambda k: k[1])
        if (at == len(kept) or kept[at][1] >= f[2]) and (at == 0 or kept[at - 1][2] <= f[1]):
            kept.insert(at, f)
    return kept


def findings(templates: Templates, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple]]:
    """By text: (license, start, end, matched, length), positions in code points."""
    plain = WORD_BYTE[data]
    out: dict[int, list[tuple]] = {}
    seeds = {size: seed_hashes(plain, offsets, size) for size in templates.tables}
    *_, starts, ends, first = seeds[SEED_WORDS]
    for i, k, low, high in (w for size, found in seeds.items() for w in templates.windows(size, *found[:3])):
        t, base = templates.all[k], int(first[i])
        a = max(0, low - t.slack)
        b = min(int(first[i + 1]) - base, high + len(t.words) + t.slack)
        words = [plain[s:e].tobytes() for s, e in zip(starts[base + a : base + b].tolist(), ends[base + a : base + b].tolist(), strict=True)]
        pairs = align(t.words, words)
        if len(pairs) >= t.least:
            spot = (int(starts[base + a + pairs[0][1]]), int(ends[base + a + pairs[-1][1]]))
            out.setdefault(i, []).append((t.license, *spot, len(pairs), len(t.words)))
    for i, found in out.items():
        points = lambda x, i=i: int(np.count_nonzero((data[offsets[i] : x] & 0xC0) != 0x80))
        out[i] = [(name, points(s), points(e), n, size) for name, s, e, n, size in apart(found)]
    return out


@lru_cache(maxsize=1)
def all_templates() -> Templates:
    return Templates(TEXTS, NAMES, RIGHTS, ALONE)


FINDING = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("matched", pa.int64()), ("length", pa.int64())])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and its findings (license, start, end, matched and length in words), a row for each row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = all_templates()
        for batch in batches:
            at = 0
            for keys, data, offsets in A.text_chunks([batch]):
                found = findings(templates, data, offsets)
                names = ("license", "start", "end", "matched", "length")
                rows = [[dict(zip(names, f, strict=True)) for f in found.get(i, ())] for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(keys)), pa.array(rows, pa.list_(FINDING))], ["doc_id", "findings"])
                at += len(keys)

    rows = docs.select("doc_id", text_of(docs).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    finding = "struct<license:string,start:bigint,end:bigint,matched:bigint,length:bigint>"
    return rows.mapInArrow(run, f"doc_id {kind}, findings array<{finding}>")


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_findings, licenses (distinct ids in order, comma-joined), coverage (the best), spans (id:start:end, comma-joined), rights (as spans, of notices that name no license)."""
    span = lambda f: F.concat_ws(":", f["license"], f["start"].cast("string"), f["end"].cast("string"))
    is_right = lambda f: f["license"].isin(*RIGHTS)
    found = scan(documents(spark, sf_dir)).withColumn("rights", F.filter("findings", is_right)).withColumn("findings", F.filter("findings", lambda f: ~is_right(f)))
    return found.select(
        "doc_id",
        F.size("findings").cast("bigint").alias("n_findings"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("findings", lambda f: f["license"]))), ",").alias("licenses"),
        F.array_max(F.transform("findings", lambda f: f["matched"] / f["length"])).alias("coverage"),
        F.array_join(F.transform("findings", span), ",").alias("spans"),
        F.array_join(F.transform("rights", span), ",").alias("rights"),
    )
