"""Suffix-array dedup: a distributed merge sort of suffixes that knows their common prefixes.

A byte is removed when a string of `SIZE` bytes that covers it also starts earlier.

Sampled suffixes. Of the `CORE`-byte strings inside a window of SIZE bytes, the one with the
smallest hash (the leftmost of equals) is the window's anchor. It depends on the window alone,
so equal windows have equal anchors at equal offsets, and sorting the suffixes that start at
anchors, a few in a hundred of all, shows every repeated window. A suffix carries the bytes
that its windows need: up to SIZE forwards, and those before it that they begin with.

1. Anchors whose core occurs nowhere else can't be in a repeated window. Their hashes are
   counted in buckets (as in the substring operator), and only the rest go on: suffixes whose
   distinguishing prefix ends within the core aren't exchanged.
2. Each task sorts its suffixes into runs and sends each run, split by a hash of the core,
   front-coded: for each suffix the length of the prefix it shares with the one before, and
   the rest. Suffixes that are equal in all they carry are sent once, the earliest, and the
   others' windows marked at once; so copies cost a bucket one entry for each run.
3. A bucket merges its runs with a loser tree. Each contender holds the length of the prefix
   it shares with the last winner; of two, the one that shares more is smaller, and only with
   equal lengths are bytes compared, from there on. The merge gives the order and, for free,
   the prefix shared by neighbours, the LCP array of the bucket's part of the suffix array.
   A core that occurs very often (a common line in many contexts) isn't left to one bucket: its
   suffixes are sent window by window, each carrying just that window's bytes and dealt by
   their hash, so that a bucket gets at most one entry of a run for each different window.
4. Suffixes that share 100 - o bytes forwards, which are runs of the LCP array, and o bytes
   backwards have equal windows at offset o. Of those, all but the earliest are marked.
5. Marks meet by document, merge into maximal runs, and the texts lose them.

Results are exact up to the 64-bit hash of step 1, which could only add work. Which cores are
split has no influence on them; the driver reads and tasks get at most `HOT_CORES` hashes of
cores, those that occur most often, and only of cores met `HOT` times or more. Matches don't
cross documents. Earlier is by key, the doc_id, then position; rows that repeat one doc_id
with equal text are the same place, not an earlier one.

Defined results: a null text counts as empty; a text shorter than SIZE loses nothing. A null
doc_id is replaced by a hash of the text, and is early or late by that number. Rows that share
a doc_id with different texts each lose the places that any of them loses. Kept bytes are
bytes: a cut may fall inside a character. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import arrays as A
from tessera.llm.common import buckets, documents, stage
from tessera.llm.removal import intervals, keyed, mark_rows, packed, packed_texts, positions, shortened, unpacked
from tessera.llm.substring_dedup import batch_of, count, postings

SIZE, CORE = 100, 32
RUN_BYTES = 16 << 20
#: Cores met so often are split by window; at most so many of them (8 bytes each).
HOT, HOT_CORES = 1 << 10, 1 << 20
#: Suffixes whose windows are held at once.
APART = 2000
#: What a posting keeps of a hash.
LOW56 = np.uint64((1 << 56) - 1)
MARKS = "bucket int, ids binary, runs binary, pos binary"
#: kind 0: a front-coded run of suffixes; 1: marks.
RUNS = "bucket int, kind int, keys binary, runs binary, pos binary, shared binary, lengths binary, tails binary, before binary, first binary"


def anchors(data: np.ndarray, offsets: np.ndarray, size: int, core: int) -> tuple[np.ndarray, ...]:
    """For each anchor, in order: text, position, first and last window start, and hash of the core.

    Positions are within the text. Consecutive windows with one anchor are one entry.
    """
    none = np.zeros(0, np.int64)
    n_windows = np.maximum(np.diff(offsets) - size + 1, 0)
    total = len(data) - core + 1
    if not n_windows.any():
        return none, none, none, none, none.astype(np.uint64)
    at = np.arange(total)
    hashes = A.range_hashes(A.BYTE[data], at, at + core)
    # The smallest of 40 bits, then the leftmost, as one number.
    assert total < 1 << 24
    order = (hashes >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)
    width = size - core + 1
    smallest = sliding_min(order, width)
    text = A.owners(n_windows)
    start = offsets[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    anchor = (smallest[start] & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(first[1:], len(anchor)) - 1
    base = offsets[text[first]]
    return text[first], anchor[first] - base, start[first] - base, start[last] - base, hashes[anchor[first]]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values: of a block's tail and the next one's head."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    heads = np.minimum.accumulate(blocks, axis=1).ravel()
    tails = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tails[:n], heads[width - 1 : width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, size: int, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts as they are, and a text over the limit in pieces that overlap by a window: (first text, shift, bytes, offsets)."""
    if len(data) <= limit:
        yield 0, 0, data, offsets
        return
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for at in range(a, max(b - size + 1, a + 1), limit):
            stop = min(b, at + limit + size - 1)
            yield i, at - a, data[at:stop], np.array([0, stop - at])


def all_anchors(data: np.ndarray, offsets: np.ndarray, size: int, core: int) -> tuple[np.ndarray, ...]:
    """`anchors` for chunks of any size."""
    parts = []
    for i, shift, piece, ends in segments(data, offsets, size, A.CHUNK_BYTES):
        text, at, first, last, hashes = anchors(piece, ends, size, core)
        parts.append((text + i, at + shift, first + shift, last + shift, hashes))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def core_hash(hashes: np.ndarray) -> np.ndarray:
    """The hash by which cores are counted."""
    return A.mix(hashes + np.uint64(1))


def repeated_cores(docs: DataFrame, size: int, core: int, n_buckets: int, hot: int) -> tuple[DataFrame, np.ndarray]:
    """(key, pos): the anchors of each document whose core occurs elsewhere too; hashes of the hot cores."""

    def places(data, offsets):
        text, at, _, _, hashes = all_anchors(data, offsets, size, core)
        return core_hash(hashes), text, at

    counted = stage(count(postings(keyed(docs), places, n_buckets, often=max(2, hot >> 6)), n_buckets, hot), "repeated-cores")
    most = counted.where("bucket < 0").orderBy(F.desc("times"), "hash").limit(HOT_CORES).select("hash").toPandas()
    return positions(counted.where("bucket >= 0")), np.sort(most["hash"].to_numpy(np.int64).view(np.uint64))


def suffixes(raw: bytes, chosen: np.ndarray, size: int, core: int):
    """(position, first and last window start, bytes from the anchor on, bytes before it, core's hash) of chosen anchors."""
    data = np.frombuffer(raw, np.uint8)
    _, at, first, last, hashes = all_anchors(data, np.array([0, len(data)]), size, core)
    keep = np.isin(at, chosen)
    for a, p, q, h in zip(at[keep].tolist(), first[keep].tolist(), last[keep].tolist(), hashes[keep].tolist(), strict=True):
        yield a, p, q, raw[a : q + size], raw[p:a][::-1], h


def sorted_runs(rows: DataFrame, size: int, core: int, n_buckets: int, hot: np.ndarray) -> DataFrame:
    """Front-coded runs by bucket from rows (key, size, body, pos), and the marks of what runs hold twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for batch in batches:
            for key, n, body, pos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for a, p, q, ahead, before, h in suffixes(unpacked(n, body), A.unpack(pos).astype(np.int64), size, core):
                    held.append((ahead, before, q - a, key, a, p, h))
                    weight += len(ahead) + len(before) + 200
                    if weight > RUN_BYTES:
                        yield from (batch_of(rows, RUNS) for rows in encoded(held, n_buckets, size, hot))
                        held, weight = [], 0
        if held:
            yield from (batch_of(rows, RUNS) for rows in encoded(held, n_buckets, size, hot))

    return rows.mapInArrow(run, RUNS)


def met_once(held: list[tuple], marked: list[tuple[int, int]]) -> list[tuple]:
    """In order, one of the suffixes that are equal in all that they carry; the others' windows are marked."""
    held.sort()
    out: list[tuple] = []
    for x in held:
        # Equal: the later one's windows all start earlier in the first.
        if out and x[:3] == out[-1][:3]:
            if x[3:5] != out[-1][3:5]:
                marked += [(x[3], s) for s in range(x[5], x[4] + x[2] + 1)]
        else:
            out.append(x)
    return out


def by_window(suffix: tuple, size: int) -> Iterator[tuple]:
    """A suffix for each of a suffix's windows, to be dealt by all the window's bytes."""
    ahead, before, last, key, a, first, _ = suffix
    for s in range(first, a + last + 1):
        x, y = ahead[: size - (a - s)], before[: a - s]
        yield x, y, s - a, key, a, s, int.from_bytes(blake2b(y + x, digest_size=8).digest())


def encoded(held: list[tuple], n_buckets: int, size: int, hot: np.ndarray) -> Iterator[list[tuple]]:
    """The rows of one run, and of further ones of `APART` split suffixes each."""
    marked: list[tuple[int, int]] = []
    held = met_once(held, marked)
    split = np.isin(core_hash(np.array([x[6] for x in held], np.uint64)) & LOW56, hot).tolist() if len(hot) else [False] * len(held)
    yield run_rows([x for x, s in zip(held, split, strict=True) if not s], marked, n_buckets)
    apart = [x for x, s in zip(held, split, strict=True) if s]
    for i in range(0, len(apart), APART):
        marked = []
        held = met_once([y for x in apart[i : i + APART] for y in by_window(x, size)], marked)
        yield run_rows(held, marked, n_buckets)


def run_rows(held: list[tuple], marked: list[tuple[int, int]], n_buckets: int) -> list[tuple]:
    by_bucket: dict[int, list] = {}
    where = A.bucket_of(A.mix(np.array([x[6] for x in held], np.uint64) + np.uint64(3)), n_buckets).tolist()
    for x, b in zip(held, where, strict=True):
        by_bucket.setdefault(b, []).append(x)
    rows = []
    for b, part in by_bucket.items():
        shared, tails, last = [], [], b""
        for ahead, *_ in part:
            n = common(last, ahead, 0)
            shared.append(n)
            tails.append(ahead[n:])
            last = ahead
        ints = lambda i: A.pack(np.array([x[i] for x in part], np.int64))  # noqa: B023, E731
        rows.append((
            b, 0, A.pack_keys(np.array([x[3] for x in part], np.int64)), A.pack(np.array([len(x[1]) for x in part])), ints(4),
            A.pack(np.array(shared)), A.pack(np.array([len(t) for t in tails])), packed(b"".join(tails)), packed(b"".join(x[1] for x in part)), A.pack(np.array([x[2] + len(x[1]) for x in part])),
        ))
    if marked:
        marked.sort()
        keys, pos = (np.array(c, np.int64) for c in zip(*marked, strict=True))
        rows += [(b, 1, ids, n, p, None, None, None, None, None) for b, ids, n, p in mark_rows(keys, pos, n_buckets)]
    return rows


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes are known to be common."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x) ^ int.from_bytes(y)
    return known + len(x) - (differ.bit_length() + 7) // 8


class LoserTree:
    """Merges sorted runs of strings; no prefix that is known to be common is compared again."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]]):
        """Runs give (length shared with the one before, string)."""
        self.runs, k = runs, len(runs)
        self.size = 1 << max(0, (k - 1).bit_length())
        self.text: list[bytes | None] = [None] * self.size
        self.shared = [0] * self.size
        for i, r in enumerate(runs):
            self._next(i, r)
        self.loser = [0] * self.size
        players = list(range(self.size))
        at = self.size
        while at > 1:  # a level at a time; all share 0 bytes with what came before
            at //= 2
            players = [self._play(players[2 * i], players[2 * i + 1], at + i) for i in range(at)]
        self.winner = players[0]

    def _next(self, i: int, run) -> None:
        self.shared[i], self.text[i] = next(run, (0, None))

    def _play(self, a: int, b: int, node: int) -> int:
        """The smaller of two; the other stays at the node with the prefix it shares with the winner."""
        x, y, shared = self.text[a], self.text[b], self.shared
        if y is None or (x is not None and shared[a] > shared[b]):
            self.loser[node] = b
            return a
        if x is None or shared[b] > shared[a]:
            self.loser[node] = a
            return b
        n = common(x, y, shared[a])
        if x[n:] <= y[n:]:
            shared[b], self.loser[node] = n, b
            return a
        shared[a], self.loser[node] = n, a
        return b

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        """(run, length shared with the string before, string) in order."""
        w = self.winner
        while self.text[w] is not None:
            yield w, self.shared[w], self.text[w]
            self._next(w, self.runs[w])
            node = (self.size + w) // 2
            while node:
                w = self._play(self.loser[node], w, node)
                node //= 2


def decoded(shared, lengths, tails: bytes) -> Iterator[tuple[int, bytes]]:
    last, at = b"", 0
    for s, n in zip(shared.tolist(), lengths.tolist(), strict=True):
        last = last[:s] + tails[at : at + n]
        at += n
        yield s, last


def repeats(runs: DataFrame, size: int, core: int, n_buckets: int) -> DataFrame:
    """Merge each bucket's runs and mark the windows that start earlier elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        rows, parts = [], []
        for r in table.to_pylist():
            if r["kind"]:
                rows.append((r["bucket"], r["keys"], r["runs"], r["pos"]))
            else:
                parts.append(r)
        if parts:
            tree = LoserTree([decoded(A.unpack(r["shared"]), A.unpack(r["lengths"]), unpacked(int(A.unpack(r["lengths"]).sum(dtype=np.int64)), r["tails"])) for r in parts])
            order, shared, lengths = [], [], []
            for w, s, text in tree:
                order.append(w)
                shared.append(s)
                lengths.append(len(text))
            keys = [A.unpack_keys(r["keys"]) for r in parts]
            into = lambda columns: gathered(columns, order)
            key, pos = into(keys), into([A.unpack(r["pos"]).astype(np.int64) for r in parts])
            back = into([A.unpack(r["runs"]).astype(np.int64) for r in parts])
            least = back - into([A.unpack(r["first"]).astype(np.int64) for r in parts])
            before = backwards(parts, order, back)
            rows += mark(key, pos, np.array(shared), np.array(lengths), before, back, least)
        return pa.Table.from_batches([batch_of(rows, MARKS)])

    def mark(key, pos, shared, lengths, before, most, least):
        rank = np.lexsort((pos, key))
        first = np.ones(len(rank), bool)
        first[1:] = (key[rank][1:] != key[rank][:-1]) | (pos[rank][1:] != pos[rank][:-1])
        place = np.empty(len(rank), np.int64)
        place[rank] = np.cumsum(first)
        back_order = np.lexsort(before.view(">u8").T[::-1])
        sorted_back = before[back_order]
        differ = sorted_back[1:] != sorted_back[:-1]
        back_shared = np.where(differ.any(1), differ.argmax(1), before.shape[1])
        found_key, found_pos = [], []
        for o in range(int(least.min()), int(most.max()) + 1):
            member = (least <= o) & (o <= most)
            if member.sum() < 2:
                continue
            ahead = np.cumsum(np.concatenate([[0], shared[1:] < size - o]))
            behind = np.empty(len(key), np.int64)
            behind[back_order] = np.cumsum(np.concatenate([[0], back_shared < o]))
            some = np.flatnonzero(member)
            group = ahead[some] * len(key) + behind[some]
            by = np.lexsort((place[some], group))
            group, where = group[by], place[some][by]
            new = np.concatenate([[True], group[1:] != group[:-1]])
            earliest = where[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            late = some[by][where > earliest]
            found_key.append(key[late])
            found_pos.append(pos[late] - o)
        if not found_key:
            return []
        key, pos = np.concatenate(found_key), np.concatenate(found_pos)
        order = np.lexsort((pos, key))
        return list(mark_rows(key[order], pos[order], n_buckets))

    def backwards(parts, order, back):
        """Bytes before each suffix, nearest first, padded to one width."""
        width = int(back.max()) // 8 * 8 + 8
        flat = [np.frombuffer(unpacked(int(A.unpack(r["runs"]).sum(dtype=np.int64)), r["before"]), np.uint8) for r in parts]
        blocks = []
        for r, data in zip(parts, flat, strict=True):
            n = A.unpack(r["runs"]).astype(np.int64)
            block = np.zeros((len(n), width), np.uint8)
            block[np.repeat(np.arange(len(n)), n), np.arange(len(data)) - np.repeat(np.cumsum(n) - n, n)] = data
            blocks.append(block)
        return gathered(blocks, order)

    return runs.groupBy("bucket").applyInArrow(run, MARKS)


def gathered(columns: list[np.ndarray], order: list[int]) -> np.ndarray:
    """Entries of several runs, each in its own order, in the order of the merge."""
    order = np.array(order)
    stable = np.argsort(order, kind="stable")
    flat = np.concatenate(columns)
    out = np.empty_like(flat)
    out[stable] = flat
    return out


def repeated_bytes(docs: DataFrame, size: int = SIZE, core: int = CORE, hot: int = HOT) -> DataFrame:
    """key, starts, stops: the maximal runs of bytes of each document to be removed."""
    n = buckets(docs)
    chosen, often = repeated_cores(docs, size, core, n, hot)
    texts = packed_texts(docs, bytes).join(chosen, "key").select("key", "size", "body", "pos")
    return intervals(repeats(sorted_runs(texts, size, core, n, often), size, core, n), size)


def without_repeats(docs: DataFrame, size: int = SIZE, core: int = CORE, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes), starts, stops."""

    def cut(raw: bytes, starts, stops):
        kept, at = [], 0
        for s, e in zip(starts, stops, strict=True):
            kept.append(raw[at:s])
            at = e
        kept = b"".join([*kept, raw[at:]])
        return len(raw), len(raw) - len(kept), len(starts), kept, [int(s) for s in starts], [int(e) for e in stops]

    columns = "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, starts array<bigint>, stops array<bigint>"
    return shortened(docs, repeated_bytes(docs, size, core, hot), bytes, cut, columns)


def op10_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
