"""Substring dedup by Rabin-Karp hashes of every window of a fixed number of words.

1. Tasks hash every window of every text. A task combines what it sees first: of a window
   that it meets more than once, it marks all places itself and sends on the hash alone. So a
   passage that a third of all documents share costs one entry for each chunk of text.
2. Spark deals the hashes into buckets, which count them; windows counted twice or more, or
   sent on as repeated, mark their places.
3. Marked places meet by document, merge into maximal intervals of words, and are removed.

Windows count as equal when their Rabin-Karp hashes modulo two primes are, 62 bits of which the
bucket and seven bytes keep 60 or more. Words enter these as eight bytes of their BLAKE2 digest, so
words can't be written to have one value. Two different windows are taken for equal with a chance of
about 1e-18, which at 1e13 windows means a few million wrong words in 1e13; a check of the words
themselves would move all texts once more and isn't made. Windows are judged on the input, not on
what is left of it.

Defined results: a null text counts as empty; it, and any text with fewer words than a window,
loses nothing. Rows that repeat are documents of their own, so their windows repeat. doc_id is
the key of a document: of rows that share one with different texts, each loses the places that
any of them loses. A null doc_id is allowed. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import arrays as A
from tessera.llm.common import buckets, documents
from tessera.llm.removal import intervals, keyed, mark_rows, shortened

WINDOW = 35
#: kind 0: hashes met once in a chunk, with their places; 1: hashes met more often; 2: places already marked;
#: 3: how many times hashes were met (pos) that a chunk has very often.
POSTINGS = "bucket int, kind int, hashes binary, ids binary, runs binary, pos binary"


def windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of the text and number of the first word of each window."""
    starts, ends, first = A.words_in(data, offsets)
    n = np.maximum(np.diff(first) - size + 1, 0)
    text = A.owners(n)
    pos = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    at = first[:-1][text] + pos
    words = A.word_hashes(data, starts, ends)
    return A.window_hashes(words, at, at + size), text, pos


def postings(rows: DataFrame, places: Callable, n_buckets: int, often: int = 0) -> DataFrame:
    """Hashes of `rows` (key, text) into buckets; `places(bytes, offsets)` gives hash, text number and position.

    Hashes that a chunk has `often` times or more are also sent with their number, unless it is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, data, offsets in A.text_chunks(batches):
            hashes, text, pos = places(data, offsets)
            order = np.argsort(hashes)
            ranked = hashes[order]
            same = np.zeros(len(ranked) + 1, bool)
            same[1:-1] = ranked[1:] == ranked[:-1]
            twice = same[1:] | same[:-1]
            rows = []
            once = order[~twice]
            for b, x, y in A.slices(A.bucket_of(hashes[once], n_buckets)):
                part = np.sort(once[x:y])
                ids, n = A.runs(keys[text[part]])
                rows.append((b, 0, A.pack56(hashes[part]), A.pack_keys(ids), A.pack(n), A.pack(pos[part])))
            several = ranked[twice & ~same[:-1]]
            for b, x, y in A.slices(A.bucket_of(several, n_buckets)):
                rows.append((b, 1, A.pack56(several[x:y]), None, None, None))
            if often:
                times = np.diff(np.flatnonzero(~same))  # of each different hash, in order
                many = times >= often
                most, times = ranked[~same[:-1]][many], times[many]
                rows += [(b, 3, A.pack56(most[x:y]), None, None, A.pack(times[x:y])) for b, x, y in A.slices(A.bucket_of(most, n_buckets))]
            again = np.sort(order[twice])
            rows += [(b, 2, None, *rest) for b, *rest in mark_rows(keys[text[again]], pos[again], n_buckets)]
            yield batch_of(rows, POSTINGS)

    return rows.mapInArrow(run, POSTINGS)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def count(found: DataFrame, n_buckets: int, hot: int = 0) -> DataFrame:
    """bucket (of the document), ids, runs, pos of the places whose hash is met twice or more.

    With `hot`, there are also columns hash and times: rows with bucket -1 say which hashes were met
    `hot` times or more, as far as the numbers sent tell.
    """
    schema = "bucket int, ids binary, runs binary, pos binary" + (", hash bigint, times bigint" if hot else "")

    def run(table: pa.Table) -> pa.Table:
        kind = np.array(table["kind"].to_pylist())
        column = lambda name, k: [v for v, x in zip(table[name].to_pylist(), kind, strict=True) if x == k]
        rows = list(zip([int(table["bucket"][0].as_py())] * int((kind == 2).sum()), *(column(c, 2) for c in ("ids", "runs", "pos")), strict=True))
        once, several = ([A.unpack56(x) for x in column("hashes", k)] for k in (0, 1))
        if once:
            hashes = np.concatenate([*once, *several])
            known = np.arange(len(hashes)) >= sum(map(len, once))
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            new = np.ones(len(ranked), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            group = np.cumsum(new) - 1
            repeated = (np.bincount(group) > 1)[group]
            place = np.sort(order[repeated & ~known[order]])
            keys = np.concatenate([np.repeat(A.unpack_keys(i), A.unpack(n)) for i, n in zip(column("ids", 0), column("runs", 0), strict=True)])
            pos = np.concatenate([A.unpack(p).astype(np.int64) for p in column("pos", 0)])
            rows += mark_rows(keys[place], pos[place], n_buckets)
        if hot:
            numbers = [A.unpack(p).astype(np.int64) for p in column("pos", 3)]
            hashes = np.concatenate([*once, *several, *map(A.unpack56, column("hashes", 3))] or [np.zeros(0, np.uint64)])
            one = np.ones(sum(map(len, [*once, *several])), np.int64)
            met, group = np.unique(hashes, return_inverse=True)
            times = np.bincount(group, np.concatenate([one, *numbers]), len(met)).astype(np.int64)
            rows = [(*r, None, None) for r in rows]
            rows += [(-1, None, None, None, h, n) for h, n in zip(met[times >= hot].astype(np.int64).tolist(), times[times >= hot].tolist(), strict=True)]
        return pa.Table.from_batches([batch_of(rows, schema)])

    return found.groupBy("bucket").applyInArrow(run, schema)


def repeated_words(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """key, starts, stops: the maximal intervals of words of each document to be removed."""
    n = buckets(docs)
    found = postings(keyed(docs), lambda data, offsets: windows(data, offsets, size), n)
    return intervals(count(found, n), size)


def without_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space), starts, stops (word numbers)."""

    def cut(raw: bytes, starts, stops):
        words, kept, at = raw.split(b" ") if raw else [], [], 0
        for s, e in zip(starts, stops, strict=True):
            kept += words[at:s]
            at = e
        kept += words[at:]
        return len(words), len(words) - len(kept), b" ".join(kept).decode(), [int(s) for s in starts], [int(e) for e in stops]

    body = lambda raw: b" ".join(raw.split())  # noqa: E731  bytes split at ASCII white space
    return shortened(docs, repeated_words(docs, size), body, cut, "n_words bigint, n_removed bigint, kept string, starts array<bigint>, stops array<bigint>")


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     k AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
           FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1)::BIGINT)) AS i FROM d)),
     t AS (SELECT g FROM k GROUP BY g HAVING count(*) > 1),
     p AS (SELECT DISTINCT r, i + o AS p FROM k JOIN t USING (g), range(0, {WINDOW}) AS x(o)),
     a AS (SELECT r, list(p) AS gone, count(*) AS n FROM p GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' '), '') END) AS kept_sha256
FROM d LEFT JOIN a USING (r)
"""
