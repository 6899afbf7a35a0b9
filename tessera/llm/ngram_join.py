"""Similarity self-join of texts by the Jaccard coefficient of their word shingles.

No pair at or above the threshold is missed, and every link is counted in full (shingles count
as equal when their 62-bit Rabin-Karp hashes modulo two primes are). The steps:

1. Texts become sets of shingle hashes; texts with equal sets are one class from here on, so
   copies never meet each other. A class is named by a 64-bit sum of its hashes; should two sets
   get one name, which another sum of each tells, all is done again with other sums. Tasks send
   (hash, class) postings, packed, into buckets.
2. An inverted list is what a bucket has for one hash. Lists of one class are dropped. A class
   of n shingles can have a link only if T = ceil(0.75 n) of them are in lists of two classes
   or more; the rest of the classes is done. What stays is a set per class of shared shingles.
3. Votes. Every list names one leader, the class whose lists are longest on average, and a class
   counts its lists by leader. That count is a part of the overlap with the leader, so it is a
   link where it suffices; the leaders with most votes are compared in full where it doesn't.
   A group of near copies thus costs a comparison or two for each member. Only lists that reach
   another component count from here on, and classes with fewer than T of them are done.
4. T-occurrence search with DivideSkip for what is left. A class q puts its longest lists aside
   and merges the short ones with a heap; a class that occurs in T less the lists put aside is a
   candidate, and the long lists are probed for it by binary search: whether a list has the
   candidate is whether the candidate's sorted set has the hash, so no long list is moved.
   T is that of both sizes. Two choices of the long lists are made for a class:
   a) All k lists of its own leader. A group of near copies has long lists led by one leader, and
      of two members with k and k' such lists at most min(k, k') are common. A pair that needs
      more than that must meet in the short lists, those of what the members don't share with
      the leader, T - min(k, k') times; a pair without so many of them is dropped at once. So a
      group of members that are near to the leader but not to each other emits no pairs.
   b) For the pairs that need no more than min(k, k'): the longest of all lists.
5. A class needs one link to a component, not all of them, so its `MOST` best candidates by
   count, `BEST` from each other component, are verified first, beside new leaders. While classes have candidates in
   other components that haven't been tried, the search goes on with `MORE` times as many of
   them; it ends when no candidate is left.

Within a component nothing is paired. Class pairs that were found come out as `links`; they
connect what all links would. What is left to be quadratic is pairs of different components that
share enough short lists and still are no link.

Defined results: a null text counts as empty; it has no shingles and is linked with nothing.
A text of 1 to 4 words is one shingle. Rows that repeat are linked documents. A null doc_id
never is the smallest; a component of such rows alone has a null id. Empty table, empty result.
Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import merge as heap_merge
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import arrays as A
from tessera.llm.common import buckets, discard, documents, stage, text_of
from tessera.llm.components import components

WORDS, PERCENT, MU, BEST, MOST, MORE = 5, 75, 0.02, 4, 64, 16
#: The open classes are worked out again when there are links of one in so many of them.
RENEW = 50
#: kind 0: (hash, class) postings; 1: documents with their classes and the classes' other sums.
POSTINGS = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary()), ("runs", pa.binary()), ("sizes", pa.binary()), ("docs", pa.binary())])
#: kind 0: a class with its shared hashes; 1: as above.
SETS = pa.schema([("kind", pa.int32()), ("class", pa.int64()), ("n", pa.int32()), ("weight", pa.int32()), ("hashes", pa.list_(pa.int64())), ("ids", pa.binary()), ("runs", pa.binary()), ("sizes", pa.binary()), ("docs", pa.binary()), ("sums", pa.binary())])
#: Pairs looked at together inside a task, and postings of open classes in a bucket.
AT_ONCE, POSTINGS_EACH = 1 << 21, 1 << 16
#: Bytes of text whose words and windows are arrays at the same time; some 30 bytes of memory for each.
SHINGLED = 1 << 19


def ddl(schema: pa.Schema) -> str:
    kinds = {"int32": "int", "int64": "bigint", "list<item: int64>": "array<bigint>", "list<item: int32>": "array<int>"}
    return ", ".join(f"{f.name} {kinds.get(str(f.type), str(f.type))}" for f in schema)


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash), distinct, in order of both; A-Z lower-cased. Worked out for about `SHINGLED` bytes at a time."""
    texts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in A.cuts(offsets, SHINGLED):
        text, found = some_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
        texts.append(text + a)
        hashes.append(found)
    return np.concatenate(texts), np.concatenate(hashes)


def some_shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    data = A.TO_LOWER[data]
    starts, ends, first = A.words_in(data, offsets)
    n = np.diff(first)
    n = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    text = A.owners(n)
    at = first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    hashes = A.window_hashes(A.word_hashes(data, starts, ends), at, np.minimum(at + words, first[1:][text]))
    edges = [0, *np.cumsum(n).tolist()]
    for a, b in zip(edges, edges[1:], strict=False):
        hashes[a:b].sort()
    new = np.ones(len(text), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return text[new], hashes[new]


def sums_of(hashes: np.ndarray, edge: np.ndarray, seed: int) -> np.ndarray:
    """A sum for each set hashes[edge[i]:edge[i + 1]]."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(A.mix(hashes + np.uint64(seed)))])
    return A.mix((total[edge[1:]] - total[edge[:-1]]) ^ np.diff(edge).astype(np.uint64)).view(np.int64)


def postings(docs: DataFrame, words: int, n_buckets: int, seed: int) -> DataFrame:
    """Packed postings of classes, and the documents' classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, data, offsets in A.text_chunks(batches):
            text, hashes = shingles(data, offsets, words)
            n = np.bincount(text, minlength=len(keys))
            edge = np.concatenate([[0], np.cumsum(n)])
            kind, other = sums_of(hashes, edge, seed), sums_of(hashes, edge, seed + 1)
            # Of equal sets in this chunk, one is sent.
            chosen = np.zeros(len(keys), bool)
            chosen[np.unique(kind, return_index=True)[1]] = True
            use = np.flatnonzero(chosen[text])
            where = A.bucket_of(hashes[use], n_buckets)
            order = np.argsort(where, kind="stable")
            rows = []
            for b, x, y in A.slices(where[order]):
                part = use[order[x:y]]
                owner, count = A.runs(text[part])
                rows.append((b, 0, A.pack56(hashes[part]), A.pack_keys(kind[owner]), A.pack(count), A.pack(n[owner]), None))
            null = np.array([k is None or k != k for k in keys])
            ids = np.array([0 if z else k for k, z in zip(keys, null, strict=True)], np.int64)
            rows.append((int(A.key_bucket(ids[:1], n_buckets)[0]), 1, A.pack_keys(other), A.pack_keys(kind), A.pack(null), A.pack(n), A.pack_keys(ids)))
            yield from table_of(rows, POSTINGS).to_batches()

    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(run, ddl(POSTINGS))


def shared(found: DataFrame, n_buckets: int) -> DataFrame:
    """By class: the hashes that are in lists of two classes or more. Documents pass through."""

    def run(table: pa.Table) -> pa.Table:
        rows, lists = [], []
        for r in table.to_pylist():
            if r["kind"]:
                rows.append(tuple(r.values()))
            else:
                lists.append((A.unpack56(r["hashes"]), A.unpack_keys(r["ids"]), A.unpack(r["runs"]), A.unpack(r["sizes"])))
        if lists:
            hashes = np.concatenate([h for h, *_ in lists])
            ids = np.concatenate([np.repeat(i, c) for _, i, c, _ in lists])
            sizes = np.concatenate([np.repeat(s, c).astype(np.int64) for *_, c, s in lists])
            order = np.lexsort((ids, hashes))
            hashes, ids, sizes = hashes[order], ids[order], sizes[order]
            new = np.ones(len(ids), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1])
            hashes, ids, sizes = hashes[new], ids[new], sizes[new]
            same = np.zeros(len(ids) + 1, bool)
            same[1:-1] = hashes[1:] == hashes[:-1]
            keep = same[1:] | same[:-1]
            # The bucket is part of what tells hashes apart; it is folded in.
            salt = A.mix(np.array([table["bucket"][0].as_py() + 1], np.uint64))
            length = np.repeat(n_of := A.runs(hashes)[1], n_of)
            rows += by_class(A.mix(hashes[keep] + salt), ids[keep], sizes[keep], length[keep], n_buckets)
        return table_of(rows, POSTINGS)

    return found.groupBy("bucket").applyInArrow(run, ddl(POSTINGS))


def by_class(hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, length: np.ndarray, n_buckets: int) -> Iterator[tuple]:
    """Postings dealt by class; beside them, for each class, 16 times the logarithms of its lists' lengths."""
    order = np.argsort(ids, kind="stable")
    hashes, ids, sizes, length = hashes[order], ids[order], sizes[order], length[order]
    where = A.key_bucket(ids, n_buckets)
    order = np.argsort(where, kind="stable")
    for b, x, y in A.slices(where[order]):
        part = order[x:y]
        owner, count = A.runs(ids[part])
        yield b, 0, hashes[part].astype("<u8").tobytes(), A.pack_keys(owner), A.pack(count), A.pack(sizes[part][np.cumsum(count) - 1]), A.pack(np.add.reduceat(16 * np.log2(length[part]), np.cumsum(count) - count).astype(np.int64))


def least_overlap(n, percent: int):
    """The smallest intersection with any set that a set of n can be linked with."""
    return -(-percent * n // 100)


def overlap_for(sizes, percent: int):
    """The smallest intersection that links two sets with this sum of sizes."""
    return -(-percent * sizes // (100 + percent))


def sets(lists: DataFrame, percent: int) -> DataFrame:
    """class, n, weight, hashes (shared ones, sorted) of the classes that can still have a link; documents pass through.

    The weight is 16 times the mean logarithm of the lengths of the class's lists.
    """

    def run(table: pa.Table) -> pa.Table:
        kinds = np.array(table["kind"].to_pylist())
        rows = table.filter(pa.array(kinds == 1))
        out = [pa.table([pa.array([1] * len(rows), pa.int32()), *(pa.nulls(len(rows), SETS.field(i).type) for i in range(1, 5)), *(rows[c] for c in ("ids", "runs", "sizes", "docs", "hashes"))], schema=SETS)]
        parts = [(np.frombuffer(h, np.uint64), *map(A.unpack_keys, [i]), *map(A.unpack, (c, s, w))) for h, i, c, s, w in zip(*(table.filter(pa.array(kinds == 0))[k].to_pylist() for k in ("hashes", "ids", "runs", "sizes", "docs")), strict=True)]
        if parts:
            hashes = np.concatenate([r[0] for r in parts]).view(np.int64)
            ids = np.concatenate([np.repeat(r[1], r[2]) for r in parts])
            sizes = np.concatenate([np.repeat(r[3], r[2]).astype(np.int64) for r in parts])
            each = np.concatenate([r[1] for r in parts])
            logs = np.concatenate([r[4].astype(np.float64) for r in parts])
            order = np.lexsort((hashes, ids))
            hashes, ids, sizes = hashes[order], ids[order], sizes[order]
            owner, count = A.runs(ids)
            weight = (np.bincount(np.searchsorted(owner, each), logs, len(owner)) / count).astype(np.int32)
            n = sizes[np.cumsum(count) - 1]
            keep = count >= least_overlap(n, percent)
            edges = np.concatenate([[0], np.cumsum(count[keep])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(hashes[np.repeat(keep, count)]))
            k = int(keep.sum())
            out.append(pa.table([*map(pa.array, (np.zeros(k, np.int32), owner[keep], n[keep].astype(np.int32), weight[keep])), lists, *(pa.nulls(k, pa.binary()) for _ in range(5))], schema=SETS))
        return pa.concat_tables(out)

    return lists.groupBy("bucket").applyInArrow(run, ddl(SETS))


def classes_of(found: DataFrame) -> DataFrame:
    """doc_id, class, n and the class's other sum for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = pa.array(A.unpack_keys(r["docs"]), pa.int64(), mask=A.unpack(r["runs"]).astype(bool))
                yield pa.RecordBatch.from_arrays([ids, pa.array(A.unpack_keys(r["ids"])), pa.array(A.unpack(r["sizes"]).astype(np.int64)), pa.array(A.unpack_keys(r["sums"]))], ["doc_id", "class", "n", "other"])

    return found.where("kind = 1").select("ids", "runs", "sizes", "docs", "sums").mapInArrow(run, "doc_id bigint, class bigint, n bigint, other bigint")


def verified(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold, with their overlap: the hashes of a are looked up in the sorted set of b."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in (batch.column(4), batch.column(5))]
            overlap = np.zeros(len(batch), np.int64)
            for i in range(len(batch)):
                x, y = (v[e[i] : e[i + 1]] for v, e in values)
                x, y = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(y, x)
                overlap[i] = np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x) if len(y) else 0
            size = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            keep = np.flatnonzero(100 * overlap >= percent * (size - overlap))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array(overlap[keep])], ["a", "b", "overlap"])

    # Only classes that are in a pair are dealt; few pairs are sent to the classes instead.
    named = lambda x: found.join(pairs.select(F.col(x).alias("class")).distinct(), "class", "left_semi")
    side = lambda x: named(x).select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("hashes").alias(f"h_{x}"))
    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", "n_a", "n_b", "h_a", "h_b").mapInArrow(probe, "a bigint, b bigint, overlap bigint")


#: Entries of lists (hash, class, extra) by bucket; per class: n and number of lists, root, leader, votes, lists put aside.
CLASS_LISTS = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("hashes", "ids", "runs", "n", "m", "roots", "leads", "votes", "aside", "extra"))])
OF_CLASS = ("n", "m", "roots", "leads", "votes", "aside")
SIGNED = ("roots", "leads")


def _deal(entry: dict[str, np.ndarray], where: np.ndarray) -> Iterator[tuple]:
    """Rows of CLASS_LISTS: entries in order of class within their bucket."""
    order = np.lexsort((entry["ids"], where))
    entry, where = {k: v[order] for k, v in entry.items()}, where[order]
    for b, x, y in A.slices(where):
        owner, count = A.runs(entry["ids"][x:y])
        last = x + np.cumsum(count) - 1
        per = [(A.pack_keys if c in SIGNED else A.pack)(entry[c][last]) for c in OF_CLASS]
        yield b, entry["hashes"][x:y].astype(np.int64).tobytes(), A.pack_keys(owner), A.pack(count), *per, A.pack(entry["extra"][x:y])


def _entries(table: pa.Table, *by: str) -> dict[str, np.ndarray]:
    """The columns of CLASS_LISTS rows, one value for each entry, in order of `by`, the last one first."""
    parts: dict[str, list] = {c: [] for c in ("hashes", "ids", *OF_CLASS, "extra")}
    for r in table.to_pylist():
        c = A.unpack(r["runs"])
        parts["hashes"].append(np.frombuffer(r["hashes"], np.int64))
        parts["ids"].append(np.repeat(A.unpack_keys(r["ids"]), c))
        for k in OF_CLASS:
            parts[k].append(np.repeat(A.unpack_keys(r[k]) if k in SIGNED else A.unpack(r[k]).astype(np.int64), c))
        parts["extra"].append(A.unpack(r["extra"]).astype(np.int64))
    entry = {k: np.concatenate(v) for k, v in parts.items()}
    order = np.lexsort([entry[k] for k in by])
    return {k: v[order] for k, v in entry.items()}


def _by_hash(classes: DataFrame, n_buckets: int) -> DataFrame:
    """Rows of (class, n, root, lead, votes, aside, hashes, flags) into buckets by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = np.diff(batch.column(6).offsets.to_numpy())
            of_class = lambda i: np.repeat(batch.column(i).to_numpy().astype(np.int64), count)  # noqa: B023, E731
            hashes = batch.column(6).flatten().to_numpy()
            entry = {"hashes": hashes, "ids": of_class(0), "n": of_class(1), "m": np.repeat(count, count), "roots": of_class(2), "leads": of_class(3), "votes": of_class(4), "aside": of_class(5)}
            entry["extra"] = batch.column(7).flatten().to_numpy().astype(np.int64) if batch.num_columns > 7 else np.zeros(len(hashes), np.int64)
            yield from table_of(list(_deal(entry, A.key_bucket(hashes, n_buckets))), CLASS_LISTS).to_batches()

    return classes.mapInArrow(run, ddl(CLASS_LISTS))


#: Flags of a class's list: to be merged for pairs that must meet outside the leader's lists; for the other pairs.
SHORT, PLAIN = 1, 2
CLASSES = pa.schema([("class", pa.int64()), ("n", pa.int32()), ("weight", pa.int32()), ("root", pa.int64()), ("lead", pa.int64()), ("votes", pa.int32()), ("aside", pa.int64()), ("hashes", pa.list_(pa.int64())), ("flags", pa.list_(pa.int32())), ("link", pa.int64()), ("maybe", pa.list_(pa.int64()))])
HALF = 1 << 31


def crossing(found: DataFrame, n_buckets: int, percent: int) -> DataFrame:
    """The classes with T or more lists that reach another component, with those lists, as CLASSES has them.

    `link` is the leader that the votes alone link the class with; `maybe` are up to two leaders
    to be compared: the one with most votes, and the first among the lists that it doesn't lead.
    `aside` has the numbers of lists put aside, for SHORT times 2**31 plus that for PLAIN.
    """

    def lists(table: pa.Table) -> pa.Table:
        e = _entries(table, "ids", "votes", "hashes")  # the heaviest comes last in its list; votes are weights here
        _, count = A.runs(e["hashes"])
        at = np.cumsum(count) - count
        mixed = np.minimum.reduceat(e["roots"], at) != np.maximum.reduceat(e["roots"], at)
        head = at + count - 1
        # The leader, its size (0 for classes of its own component) and, for the choice of long lists, the length.
        other = e["roots"] != np.repeat(e["roots"][head], count)
        e |= {"leads": np.repeat(e["ids"][head], count), "aside": np.repeat(e["n"][head], count) * other, "m": np.repeat(count, count)}
        keep = np.repeat(mixed, count)
        return table_of(list(_lists_by_class({k: v[keep] for k, v in e.items()}, n_buckets)), LED)

    def choose(table: pa.Table) -> pa.Table:
        out = []
        for owner, n, weight, root, hashes, lead, size, length in _led_classes(table):
            least = least_overlap(n, percent)
            if len(hashes) < least:
                continue
            leaders, first, votes = np.unique(lead, return_index=True, return_counts=True)
            top = np.lexsort((leaders, votes))[-1]
            g, k = int(leaders[top]), int(votes[top])
            other = size[first] > 0
            linked = np.flatnonzero(other & (100 * votes >= percent * (n + size[first] - votes)))
            link = int(leaders[linked[np.argmax(votes[linked])]]) if len(linked) else None
            maybe = [] if link is not None or not other[top] else [g]
            if link is None and len(rest := np.flatnonzero(other & (leaders != g))):
                maybe.append(int(leaders[rest[np.argmax(votes[rest])]]))
            outside, flags = np.flatnonzero(lead != g), np.zeros(len(hashes), np.int32)
            longest = int(length.max())
            short = set_aside(least - k, longest) if least - k > 1 else 0
            flags[outside[np.argsort(length[outside], kind="stable")[: len(outside) - short]]] |= SHORT
            plain = 0
            if k >= least:
                plain = set_aside(least, longest)
                flags[np.argsort(length, kind="stable")[: len(hashes) - plain]] |= PLAIN
            out.append((owner, n, weight, root, g, k, short * HALF + plain, hashes, flags, link, maybe))
        return table_of(out, CLASSES)

    classes = found.select("class", "n", "root", F.lit(0).alias("lead"), F.col("weight").alias("votes"), F.lit(0).alias("aside"), "hashes")
    dealt = _by_hash(classes, n_buckets).groupBy("bucket").applyInArrow(lists, ddl(LED))
    return dealt.groupBy("bucket").applyInArrow(choose, ddl(CLASSES))


#: As CLASS_LISTS with, for each entry, its list's leader, that one's size and the list's length.
LED = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("hashes", "ids", "runs", "n", "roots", "weights", "leads", "sizes", "lengths"))])


def _lists_by_class(e: dict[str, np.ndarray], n_buckets: int) -> Iterator[tuple]:
    where = A.key_bucket(e["ids"], n_buckets)
    order = np.lexsort((e["leads"], e["ids"], where))
    e, where = {k: v[order] for k, v in e.items()}, where[order]
    for b, x, y in A.slices(where):
        owner, count = A.runs(e["ids"][x:y])
        last = x + np.cumsum(count) - 1
        yield b, e["hashes"][x:y].tobytes(), A.pack_keys(owner), A.pack(count), A.pack(e["n"][last]), A.pack_keys(e["roots"][last]), A.pack(e["votes"][last]), A.pack_keys(e["leads"][x:y]), A.pack(e["aside"][x:y]), A.pack(e["m"][x:y])


def _led_classes(table: pa.Table) -> Iterator[tuple]:
    """class, n, weight, root, hashes (ascending), and each one's leader, its size and the list's length."""
    parts: dict[str, list] = {c: [] for c in LED.names[1:] if c != "runs"}
    for r in table.to_pylist():
        c = A.unpack(r["runs"])
        for k in ("ids", "roots"):
            parts[k].append(np.repeat(A.unpack_keys(r[k]), c))
        for k in ("n", "weights"):
            parts[k].append(np.repeat(A.unpack(r[k]).astype(np.int64), c))
        for k in ("sizes", "lengths"):
            parts[k].append(A.unpack(r[k]).astype(np.int64))
        parts["leads"].append(A.unpack_keys(r["leads"]))
        parts["hashes"].append(np.frombuffer(r["hashes"], np.int64))
    e = {k: np.concatenate(v) for k, v in parts.items()}
    order = np.lexsort((e["hashes"], e["ids"]))
    e = {k: v[order] for k, v in e.items()}
    for owner, x, y in A.slices(e["ids"]):
        yield owner, int(e["n"][x]), int(e["weights"][x]), int(e["roots"][x]), e["hashes"][x:y], e["leads"][x:y], e["sizes"][x:y], e["lengths"][x:y]


def set_aside(least: int, longest: int) -> int:
    """How many of a query's longest lists are probed rather than merged, by DivideSkip's rule; below `least`."""
    return max(0, min(least - 1, int(least / (MU * log2(max(2, longest)) + 1))))


#: kind 0: partners of a class in one bucket's lists, each list sorted and its length before it; 1: partners tried before.
REQUESTS = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("class", pa.int64()), ("others", pa.binary()), ("roots", pa.binary()), ("needs", pa.binary())])


def meetings(e: dict[str, np.ndarray], percent: int) -> Iterator[dict[str, np.ndarray]]:
    """Pairs of a query's entry and a partner's in one list: q, other, root, need (times to meet), list; in order of all but the root.

    Entries are in order of hash, then n. A larger partner finds this class from its own side; of
    equal ones the one with the larger id does. So partners are a range of the list.
    """
    size, ids, k = e["n"], e["ids"], e["votes"]
    rank = np.cumsum(np.concatenate([[False], e["hashes"][1:] != e["hashes"][:-1]]))
    place = rank * (HALF << 1) + size  # ascending
    query = np.flatnonzero(e["extra"])
    low = np.searchsorted(place, rank[query] * (HALF << 1) + least_overlap(size[query], percent))
    # A pair that has enough in its leader's lists has a partner no larger than this.
    most = np.where(e["extra"][query] & SHORT, size[query], np.minimum(size[query], (100 + percent) * k[query] // percent - size[query]))
    high = np.maximum(low, np.searchsorted(place, rank[query] * (HALF << 1) + most, side="right"))
    total = np.cumsum(high - low)
    at = 0
    while at < len(query):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + AT_ONCE, side="right")))
        n = (high - low)[at:stop]
        q = np.repeat(query[at:stop], n)
        y = np.repeat(low[at:stop], n) + np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
        at = stop
        keep = (e["roots"][q] != e["roots"][y]) & ((size[y] < size[q]) | (ids[y] < ids[q]))
        q, y = q[keep], y[keep]
        overlap = overlap_for(size[q] + size[y], percent)
        same = e["leads"][q] == e["leads"][y]
        led = np.where(same, k[y], np.minimum(k[y], e["m"][y] - k[y]))  # at most so many of the query's leader
        common = np.minimum(k[q], led)
        enough = common >= overlap
        flag = e["extra"][q]
        need = np.where(enough, overlap - e["aside"][q] % HALF, overlap - common - e["aside"][q] // HALF)
        # Outside the leader's lists both must have what is needed.
        outside = np.minimum(e["m"][q] - k[q], np.where(same, e["m"][y] - k[y], e["m"][y]))
        fits = np.where(enough, flag & PLAIN, flag & SHORT).astype(bool) & (np.minimum(e["m"][q], e["m"][y]) >= overlap) & (enough | (outside >= overlap - common))
        q, y, need = q[fits], y[fits], need[fits]
        order = np.lexsort((ids[y], rank[q], ids[q]))
        yield {"q": ids[q][order], "other": ids[y][order], "root": e["roots"][y][order], "need": need[order], "list": rank[q][order]}


def requests(classes: DataFrame, n_buckets: int, percent: int) -> DataFrame:
    """By class: its possible partners in another component in each of its short lists, as REQUESTS."""

    def short_lists(table: pa.Table) -> pa.Table:
        out = []
        for p in meetings(_entries(table, "ids", "n", "hashes"), percent):
            for q, x, y in A.slices(p["q"]):
                _, n = A.runs(p["list"][x:y])
                others = np.insert(p["other"][x:y], np.cumsum(n) - n, n)
                out.append((int(A.key_bucket(p["q"][x : x + 1], n_buckets)[0]), 0, q, others.tobytes(), A.pack_keys(p["root"][x:y]), A.pack(p["need"][x:y])))
        return table_of(out, REQUESTS)

    entries = _by_hash(classes.select("class", "n", "root", "lead", "votes", "aside", "hashes", "flags"), n_buckets)
    return entries.groupBy("bucket").applyInArrow(short_lists, ddl(REQUESTS))


def candidates(asked: DataFrame, tried: DataFrame, n_buckets: int, best: int, most: int) -> DataFrame:
    """Pairs (a, b), b in another component and in enough short lists of a, that haven't been tried.

    Of a class's candidates the `most` by count come out, `best` of each component at most; the
    rest waits for a later call.
    """

    def search(table: pa.Table) -> pa.Table:
        lists: dict[int, list] = {}
        root, need, done = {}, {}, {}
        for r in table.to_pylist():
            q, others = r["class"], np.frombuffer(r["others"], np.int64)
            if r["kind"]:
                done.setdefault(q, set()).update(others.tolist())
                continue
            at, flat = 0, []
            while at < len(others):
                part = others[at + 1 : at + 1 + others[at]].tolist()
                lists.setdefault(q, []).append(part)
                flat += part
                at += 1 + int(others[at])
            root.update(zip(flat, A.unpack_keys(r["roots"]).tolist(), strict=True))
            need.setdefault(q, {}).update(zip(flat, A.unpack(r["needs"]).tolist(), strict=True))
        out = []
        for q, found in lists.items():
            times: dict[int, int] = {}
            for other in heap_merge(*found):
                times[other] = times.get(other, 0) + 1
            skip, per, left = done.get(q, ()), {}, most
            for _, other in sorted((-n, o) for o, n in times.items() if o not in skip and n >= need[q][o]):
                if left and (seen := per.get(root[other], 0)) < best:
                    per[root[other]], left = seen + 1, left - 1
                    out.append((q, other))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    def as_requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            rows = [(int(A.key_bucket(a[x : x + 1], n_buckets)[0]), 1, q, b[x:y].tobytes(), None, None) for q, x, y in A.slices(a)]
            yield from table_of(rows, REQUESTS).to_batches()

    return asked.unionByName(tried.select("a", "b").mapInArrow(as_requests, ddl(REQUESTS))).groupBy("bucket").applyInArrow(search, "a bigint, b bigint")


def vote_links(classes: DataFrame) -> DataFrame:
    """Links that the votes alone show; the overlap is at least what the threshold asks for."""
    return classes.where("link IS NOT NULL").select(F.col("class").alias("a"), F.col("link").alias("b"))


def leader_pairs(classes: DataFrame, tried: DataFrame | None) -> DataFrame:
    """Classes with the leaders that they are to be compared with, but not again."""
    pairs = classes.select(F.col("class").alias("a"), F.explode("maybe").alias("b"))
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def parts_of(classes: DataFrame) -> int:
    """Buckets for the hashes of these classes, by their number."""
    size = classes.agg(F.sum(F.size("hashes").cast("bigint"))).first()[0] or 0  # one number
    return 1 + size // POSTINGS_EACH


def follow(rooted: DataFrame, mapping: DataFrame) -> DataFrame:
    """`rooted` with the roots that `mapping` (node, root) leads to."""
    to = mapping.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return rooted.join(to, F.col("root") == F.col("_node"), "left").withColumn("root", F.coalesce("_root", "root")).drop("_node", "_root")


def joined_roots(links: DataFrame, classes: DataFrame) -> DataFrame:
    """node, root: where the components named by `root` in `classes` go by these links."""
    end = lambda x: classes.select(F.col("class").alias(x), F.col("root").alias(f"root_{x}"))
    return stage(components(links.join(end("a"), "a").join(end("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "roots")


def similar(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, seed: int = 7) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """(doc_id, class, n, other) for every document; tables of links (a, b) between classes; tables (node, root).

    The links connect exactly the classes that the links of all pairs at or above the threshold
    connect; inside a group that is connected already, not every pair is listed. A class's
    component is where the tables of roots lead, one after the other.
    """
    # A posting carries its share of its document's name, the larger the more buckets deal a document's postings.
    n = buckets(docs, each=1)
    found = stage(sets(shared(postings(docs, words, n, seed), n), percent), "shingle-sets")
    classes = found.where("kind = 0").select("class", "n", "weight", F.col("class").alias("root"), "hashes")
    links, roots, best, most, open_classes, asked, tried, changed = [], [], BEST, MOST, None, None, None, True
    while True:
        if changed:
            n = parts_of(classes)
            before, open_classes = open_classes, stage(crossing(classes, n, percent), "open-classes")
            discard(before, asked)
            asked = None
            if open_classes.isEmpty():
                break
            # Common hashes of classes in different components are in crossing lists, so these sets do from here on.
            classes = open_classes.select("class", "n", "weight", "root", "hashes")
        pairs = leader_pairs(open_classes, tried) if changed else None
        if tried is not None:  # the first round has votes alone
            asked = asked or stage(requests(open_classes, n, percent), "requests")
            more = candidates(asked, tried, n, best, most)
            pairs, best, most = more if pairs is None else more.unionByName(pairs).distinct(), best * MORE, most * MORE
        pairs = stage(pairs, "pairs")
        new = verified(pairs, classes, percent).select("a", "b")
        new = stage(new.unionByName(vote_links(open_classes)) if changed else new, "links")
        searched, tried = tried is not None, pairs if tried is None else tried.unionByName(pairs)
        if linked := new.count():
            links.append(new)
            roots.append(joined_roots(new, classes))
            classes = follow(classes, roots[-1])
        # After few links the open classes stay as they were: some candidates are in one component by now, none is missed.
        changed = linked * RENEW >= open_classes.count()
        if not linked and searched and pairs.isEmpty():
            break
    discard(open_classes, asked)
    return classes_of(found), links, roots


def component_ids(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, seed: int = 7) -> DataFrame:
    """doc_id, n_shingles, component_id: a row for each row of `docs`."""
    members, _, roots = similar(docs, words, percent, seed)
    least = members.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"), (F.min("other") < F.max("other")).alias("differ"))
    rooted = least.withColumn("root", F.col("class"))
    for mapping in roots:
        rooted = follow(rooted, mapping)
    rooted = stage(rooted, "rooted")
    if not rooted.where("differ").isEmpty():  # two sets have one name
        return component_ids(docs, words, percent, seed + 2)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = stage(rooted.join(smallest, "root").select("class", "component_id"), "class-components")
    discard(rooted)
    joined = members.join(of_class, "class", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return component_ids(documents(spark, sf_dir))


SQL = rf"""
WITH RECURSIVE d AS (
       SELECT doc_id, row_number() OVER () AS r,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
       FROM documents),
     s AS (SELECT DISTINCT r, array_to_string(w[i:i + {WORDS - 1}], ' ') AS g
           FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {WORDS - 2}, least(len(w), 1) + 1)::BIGINT)) AS i FROM d)),
     n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
     o AS (SELECT a.r AS x, b.r AS y, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.r <> b.r GROUP BY a.r, b.r),
     l AS (SELECT x, y FROM o JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * shared >= {PERCENT} * (p.n + q.n - shared)),
     c AS (SELECT r AS x, r AS y FROM d UNION SELECT c.x, l.y FROM c JOIN l ON c.y = l.x),
     m AS (SELECT c.x AS r, min(doc_id) AS component_id FROM c JOIN d ON d.r = c.y GROUP BY c.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n USING (r) JOIN m USING (r)
"""
