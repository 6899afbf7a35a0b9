"""Byte-level BPE by dynamic programming over prefixes.

The encoding of a piece of text has exactly one token that ends each of its prefixes, so it
is enough to keep that token for every prefix: `last[i]` is the one token t, among those that
end at i, such that the encoding of the prefix before t ends in a token that can stand before
t. Whether u can stand before t (no merge would ever have crossed the boundary between them)
follows from the merges that made u and t alone. Following `last` backwards from the end gives
the ids. Since `last[i]` rests on earlier prefixes only, appending bytes leaves all of them as
they are, and after an edit the table is recomputed from the edit until it agrees with the old
one over as many bytes as the longest token has.

Text is split by the tokenizer's pattern first. Most pieces are words that come again and
again, so a task encodes each distinct piece once, many at a time in numpy, and remembers those
met lately in up to `REMEMBERED` bytes, long ones never. Long pieces go through the same recurrence one by one. The
vocabulary (a file of bounded size, checked) is read on the driver and broadcast.

Defined results: a null text counts as empty and has no ids. Special tokens aren't
recognised: their strings are ordinary text. Rows are independent of each other, so ties,
repeats, empty tables and further columns need no rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents
from tessera.llm.tables import WHITE, IntMap, Lately

MAX_FILE, REMEMBERED, PAIRS, LONG, AT_ONCE = 64 << 20, 32 << 20, 100_000, 48, 1 << 19
NEVER = np.int64(1) << 40


class Vocabulary:
    """Tokens by rank, the merges that make them, and a trie of the reachable ones."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        n = len(tokens)
        self.left, self.right = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.merge: dict[tuple[int, int], int] = {}
        self.reachable = np.zeros(n, bool)
        self.pairs: dict[tuple[int, int], bool] = {}
        for i, t in enumerate(tokens):
            if len(t) == 1:
                self.reachable[i] = True
                continue
            for cut in range(1, len(t)):
                a, b = self.rank.get(t[:cut]), self.rank.get(t[cut:])
                # The last merge of t joins two lower tokens that stay as they are beside each other.
                if a is not None and b is not None and a < i and b < i and self.reachable[a] and self.reachable[b] and self.beside(a, b):
                    self.left[i], self.right[i] = a, b
                    self.merge[a, b] = i
                    self.reachable[i] = True
                    break
        self.pairs.clear()
        self.longest = max(map(len, tokens), default=1)
        self.trie: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        for i, t in enumerate(tokens):
            node = 0
            for byte in t:
                key = node * 256 + byte
                node = self.trie.get(key) or self.trie.setdefault(key, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            if self.reachable[i]:
                self.token_at[node] = i
        self.index()

    def index(self) -> None:
        self.merges = IntMap([a * len(self.tokens) + b for a, b in self.merge], list(self.merge.values()))
        self.steps = IntMap(list(self.trie), list(self.trie.values()))
        self.ends = np.array(self.token_at, np.int32)
        self.level = np.where(self.left < 0, -1, np.arange(len(self.tokens))).astype(np.int64)

    def beside(self, u: int, t: int) -> bool:
        """Whether u and t stay two tokens when they meet.

        Going back in time from both tokens whole, at each moment one part touches the boundary
        from the left and one from the right. A merge of the two happens if its rank comes before
        either part is taken into its own parent: strictly before on the left, where an equal rank
        further left is served first, and no later on the right.
        """
        known = self.pairs.get((u, t))
        if known is not None:
            return known
        x, y, over_x, over_y, ok = u, t, NEVER, NEVER, True
        while True:
            r = self.merge.get((x, y))
            if r is not None and r < over_x and r <= over_y:
                ok = False
                break
            x_made, y_made = self.left[x] >= 0, self.left[y] >= 0
            if x_made and (not y_made or x > y):
                over_x, x = x, int(self.right[x])
            elif y_made:
                over_y, y = y, int(self.left[y])
            else:
                break
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        self.pairs[u, t] = ok
        return ok

    def all_beside(self, u: np.ndarray, t: np.ndarray) -> np.ndarray:
        """`beside` for many pairs."""
        ok = np.ones(len(u), bool)
        at, x, y = np.arange(len(u)), u.astype(np.int64), t.astype(np.int64)
        over_x, over_y = np.full(len(u), NEVER), np.full(len(u), NEVER)
        n = len(self.tokens)
        while len(at):
            r = self.merges.get(x * n + y)
            crossed = (r >= 0) & (r < over_x) & (r <= over_y)
            ok[at[crossed]] = False
            lx, ly = self.level[x], self.level[y]
            go = ~crossed & ((lx >= 0) | (ly >= 0))
            at, x, y, over_x, over_y, lx, ly = (a[go] for a in (at, x, y, over_x, over_y, lx, ly))
            back = lx > ly
            over_x, over_y = np.where(back, x, over_x), np.where(back, over_y, y)
            x, y = np.where(back, self.right[x], x), np.where(back, y, self.left[y])
        return ok


class PrefixTable:
    """The last token of every prefix of a piece; grows by appends and mends itself after edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, upto: int) -> None:
        """Prefix by prefix: the longest token that ends there and can stand after the one before it is kept."""
        v, data, last = self.v, self.data, self.last
        for end in range(len(last), upto + 1):
            last.append(self._ending(data, end, v, last))

    @staticmethod
    def _ending(data, end, v, last) -> int:
        for size in range(min(end, v.longest), 0, -1):
            t = v.rank.get(data[end - size : end])
            if t is not None and v.reachable[t] and (size == end or v.beside(last[end - size], t)):
                return t
        raise ValueError("a byte is not in the vocabulary")

    def append(self, data: bytes) -> None:
        self.data += data
        self._fill(len(self.data))

    def edit(self, at: int, removed: int, inserted: bytes) -> int:
        """Replace `removed` bytes at `at`; returns how many prefixes were worked out again."""
        old, shift = self.last, len(inserted) - removed
        self.data = self.data[:at] + inserted + self.data[at + removed :]
        self.last, same = old[: at + 1], 0
        for end in range(at + 1, len(self.data) + 1):
            self._fill(end)
            same = same + 1 if end > at + len(inserted) and old[end - shift] == self.last[end] else 0
            if same >= self.v.longest:
                self.last += old[end - shift + 1 :]
                return end - at
        return len(self.data) - at

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.v.tokens[self.last[end]])
        return out[::-1]


def encode_many(v: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """Ids of each short piece as little-endian uint32, by the recurrence of PrefixTable in step for all."""
    if not pieces:
        return []
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    data = np.frombuffer(b"".join([pieces[i] for i in order]), np.uint8).astype(np.int64)
    start = np.cumsum(sizes) - sizes
    room = np.repeat(sizes, sizes) - (np.arange(len(data)) - np.repeat(start, sizes))
    found: list[np.ndarray] = []  # found[k][s]: the token of k + 1 bytes that starts at s
    at, node = np.arange(len(data)), np.zeros(len(data), np.int64)
    while len(at):
        node = v.steps.get(node * 256 + data[at + len(found)]).astype(np.int64)
        alive = node >= 0
        at, node = at[alive], node[alive]
        tokens = np.full(len(data), -1, np.int32)
        tokens[at] = v.ends[node]
        found.append(tokens)
        more = room[at] > len(found)
        at, node = at[more], node[more]
    last = np.full(len(data), -1, np.int32)
    for end in range(1, int(sizes[0]) + 1):
        here = start[: np.searchsorted(-sizes, -end, side="right")] + end
        for size in range(min(end, len(found)), 0, -1):
            t = found[size - 1][here - size]
            fits = t >= 0
            if size < end:
                some = np.flatnonzero(fits)
                fits[some] = v.all_beside(last[here[some] - size - 1], t[some])
            last[here[fits] - 1] = t[fits]
            here = here[~fits]
            if not len(here):
                break
    lengths = np.fromiter(map(len, v.tokens), np.int64, len(v.tokens))
    columns, end, at = [], start + sizes, np.arange(len(sizes))
    while len(at):
        t = last[end[at] - 1]
        columns.append((at, t))
        end[at] -= lengths[t]
        at = at[end[at] > start[at]]
    rows = np.concatenate([a for a, _ in columns])
    ids = np.concatenate([t for _, t in columns])
    depth = np.concatenate([np.full(len(a), i) for i, (a, _) in enumerate(columns)])
    ids = ids[np.lexsort((-depth, rows))].astype("<u4").tobytes()
    stops = np.cumsum(np.bincount(rows, minlength=len(sizes))) * 4
    out: list[bytes] = [b""] * len(pieces)
    for i, a, b in zip(order.tolist(), [0, *stops.tolist()], stops.tolist(), strict=False):
        out[i] = ids[a:b]
    return out


def splitter(pattern: str):
    """The pattern as the tokenizer's own engine reads it: white space is White_Space."""
    return regex.compile(pattern.replace(r"[^\s", rf"[^{WHITE}").replace(r"\S", rf"[^{WHITE}]").replace(r"\s", rf"[{WHITE}]"))


class Encoder:
    """Encodes texts and remembers pieces; lives in a Python worker."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.v, self.split, self.known = vocabulary, splitter(pattern), Lately(REMEMBERED, LONG)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece."""
        found: dict[str, bytes] = {}
        short: list[str] = []
        for p in pieces:
            raw = p.encode()
            whole = self.v.rank.get(raw)
            if whole is not None:
                found[p] = whole.to_bytes(4, "little")
            elif len(raw) > LONG:
                found[p] = np.array(PrefixTable(self.v, raw).ids(), "<u4").tobytes()
            else:
                short.append(p)
        short.sort(key=len)
        for i in range(0, len(short), 20_000):
            part = short[i : i + 20_000]
            found.update(zip(part, encode_many(self.v, [p.encode() for p in part]), strict=True))
        return [found[p] for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        lists = [self.split.findall(t) for t in texts]
        found = self.known.get(set().union(*lists), self.pieces)
        return [b"".join(map(found.__getitem__, pieces)) for pieces in lists]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.v.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> Vocabulary:
    """A file of `base64 rank` lines with ranks from 0; its size is checked, as it will be broadcast."""
    if Path(path).stat().st_size > MAX_FILE:
        raise ValueError(f"{path} is larger than {MAX_FILE} bytes")
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    ranks = {int(r): base64.b64decode(t) for t, r in pairs}
    return Vocabulary([ranks[i] for i in range(len(ranks))])


_encoders: dict[tuple[int, str], Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    key = (shared.value.key, pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value.vocabulary(), pattern)
    return _encoders[key]


class Packed:
    """What a broadcast carries: plain tables; indexes are made again in each worker."""

    def __init__(self, v: Vocabulary, key: str):
        self.key, self.state = key, {k: getattr(v, k) for k in ("tokens", "left", "right", "merge", "reachable", "longest", "trie", "token_at")}

    def vocabulary(self) -> Vocabulary:
        v = Vocabulary.__new__(Vocabulary)
        v.__dict__.update(self.state, rank={t: i for i, t in enumerate(self.state["tokens"])}, pairs={})
        v.index()
        return v


def groups_of(texts: Iterable[str], at_most: int = AT_ONCE) -> Iterator[list[str]]:
    """Consecutive texts of about `at_most` characters together, a longer one alone."""
    part, n = [], 0
    for t in texts:
        if part and n + len(t) > at_most:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, ids (binary, little-endian uint32) and, if asked for, the decoded bytes."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(Packed(read_vocabulary(path), path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern)
        for batch in batches:
            doc_ids, at = batch.column(0), 0
            for texts in groups_of(batch.column(1).to_pylist()):
                ids = encoder.encode(texts)
                columns = [doc_ids.slice(at, len(texts)), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array([encoder.decode(x) for x in ids], pa.binary()))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["doc_id", "ids", "decoded"]
    rows = docs.select("doc_id", F.coalesce(docs[text], F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded (bytes) from doc_id, ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            out = [b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encode_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return digests(encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True))


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
