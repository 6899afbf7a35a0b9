"""SentencePiece encoding and decoding of merge-type (BPE) models, by backtracking.

The library merges the best-scored neighbours of a text again and again, the leftmost of equals
first. Its result is the one sequence of pieces in which every piece is what its own characters
merge to and every two neighbours, merged again by themselves, stay these two: a merge over a
boundary would be made in the two alone as well, since the order of merges inside them is the same.
So the sequence can be found from the left:

1. An Aho-Corasick automaton gives the longest piece that starts at each position.
2. A piece is taken if it is compatible with the one before it, which is checked by merging both
   again; answers are remembered. Otherwise its next shorter prefix is tried.
3. Where none fits, the position has failed: its bit is cleared for good, the piece before it is
   taken back, and its shorter prefixes are tried. Each position fails at most once.

Text becomes pieces as the model's normaliser says: a space is U+2581, and one is put in front.
Nothing merges over a boundary between two characters that no piece has side by side, so texts are
cut before a U+2581 that follows another character, between letters and others, and beside
characters that no piece has; this is checked against the vocabulary. Most cuts are words that come again, and a task remembers their
ids, up to `REMEMBERED` bytes; cuts over `LONG` characters are never remembered. The model file, of
checked size, is read on the driver and broadcast.

Characters without a piece become the pieces of their UTF-8 bytes. Decoding gives U+2581 back as a
space, so a text with U+2581 of its own comes back with spaces there, as with the library.

Defined results: a null text counts as empty, and an empty one has begin and end ids only. Rows
are independent of each other: ties, repeats, empty tables, a null or repeated doc_id and further
columns (which are ignored, whatever their names) need no rule. Very long texts are encoded whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import digests, groups_of
from tessera.llm.common import documents

MAX_FILE, REMEMBERED, LONG, PAIRS = 64 << 20, 160 << 20, 64, 1 << 20
SPACE = "▁"
#: Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class Pieces:
    """The vocabulary of a merge-type model with byte fallback: scores of what may be merged, ids of all."""

    def __init__(self, names: list[str], scores: list[float], kinds: list[int], begin: int, end: int):
        self.names, self.begin, self.end, self.unknown = names, begin, end, kinds.index(UNKNOWN) if UNKNOWN in kinds else 0
        self.score = {n: s for n, s, k in zip(names, scores, kinds, strict=True) if k == NORMAL}
        self.id = {n: i for i, (n, k) in enumerate(zip(names, kinds, strict=True)) if k == NORMAL}
        self.byte_id = {int(n[1:-1], 16): i for i, (n, k) in enumerate(zip(names, kinds, strict=True)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.silent = {i for i, k in enumerate(kinds) if k == CONTROL}
        inner = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        chars = set("".join(self.score))
        letters = set(regex.findall(r"\p{L}", "".join(chars)))
        alone = regex.escape("".join(chr(c) for c in range(128) if chr(c) not in chars))
        if any(a != SPACE and b == SPACE for a, b in inner):
            self.cut = None  # merges can go over the start of a word: texts stay whole
        elif any(a != SPACE and (a in letters) != (b in letters) for a, b in inner):
            self.cut = rf"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + rf"|[{alone}]+" * bool(alone)
        else:
            self.cut = rf"{SPACE}*(?:\p{{L}}+|[^\p{{L}}{SPACE}{alone}]+)|{SPACE}+" + rf"|[{alone}]+" * bool(alone)
        #: Pieces that their own characters merge to, single characters always; others never occur.
        self.whole = {p for p in self.score if len(p) == 1 or self.merged(p) == [p]} | chars

    def merged(self, text: str) -> list[str]:
        """The merge procedure itself: best score first, then leftmost."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue = [(-s, i, a + b) for i, (a, b) in enumerate(zip(text, text[1:], strict=False)) if (s := self.score.get(a + b)) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, both = heapq.heappop(queue)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(parts) and (s := self.score.get(parts[x] + parts[y])) is not None:
                    heapq.heappush(queue, (-s, x, parts[x] + parts[y]))
        return [p for p in parts if p is not None]


class Pairs:
    """Which neighbours are compatible: keys to 0 or 1 by open addressing, -1 where it isn't known yet."""

    def __init__(self):
        self.bits = (2 * PAIRS).bit_length()
        self.clear()

    def clear(self) -> None:
        self.keys, self.values, self.n = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int8), 0

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._place(keys)
        there = self.keys[at]
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = at[left] + 1 & (1 << self.bits) - 1
            there = self.keys[at[left]]
            left = left[(there != keys[left]) & (there >= 0)]
        return self.values[at]  # an empty place holds -1

    def put(self, key: int, fits: bool) -> None:
        at = int(self._place(np.array([key]))[0])
        while self.keys[at] >= 0:
            at = at + 1 & (1 << self.bits) - 1
        self.keys[at], self.values[at] = key, fits
        self.n += 1


class Encoder:
    """Encodes texts by backtracking; lives in a Python worker and remembers what it met."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.cut = regex.compile(pieces.cut) if pieces.cut else None
        self.list = sorted(pieces.whole)
        self.number = {piece: i for i, piece in enumerate(self.list)}
        self.other = len(self.list)  # stands for a character that no piece has
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.number.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.size = np.array([*map(len, self.list), 1], np.int64)
        prefix = lambda piece: next((self.number[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.number), -1)
        self.shorter = np.array([*map(prefix, self.list), -1], np.int64)
        self.out = np.array([*(self.p.id.get(piece, -1) for piece in self.list), -1], np.int64)
        self.fits = Pairs()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bytes_known = 0

    def compatible(self, before: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """Whether each two, merged again by themselves, stay as they are."""
        keys = before * (self.other + 1) + pieces
        known = self.fits.get(keys)
        unknown = np.flatnonzero(known < 0)
        if len(unknown):
            new, which = np.unique(keys[unknown], return_inverse=True)
            apart = np.array([self.apart(*divmod(key, self.other + 1)) for key in new.tolist()], np.int8)
            known[unknown] = apart[which]
            if self.fits.n + len(new) > PAIRS:
                self.fits.clear()
            for key, fits in zip(new[:PAIRS].tolist(), apart[:PAIRS].tolist(), strict=True):
                self.fits.put(key, fits)
        return known > 0

    def apart(self, a: int, b: int) -> bool:
        if self.other in (a, b):  # what no piece has is never merged
            return True
        return self.p.merged(self.list[a] + self.list[b]) == [self.list[a], self.list[b]]

    def longest(self, text: str) -> np.ndarray:
        """Number of the longest piece that starts at each character."""
        out = np.full(len(text), self.other, np.int64)
        met = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        # Ends ascend, so the last match written for a start is its longest.
        out[met[:, 0] - self.size[met[:, 1]] + 1] = met[:, 1]
        return out

    def pieces(self, parts: list[str]) -> list[np.ndarray]:
        """The numbers of the pieces of each part of at most `LONG` characters, worked out in step."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        first = np.cumsum(sizes) - sizes
        longest = np.full(int(sizes.sum()), self.other, np.int64)
        gap = "\n" if "\n" not in self.number else "\0"
        joined = self.longest(gap.join(parts))
        longest[:] = joined[np.arange(len(longest)) + np.repeat(np.arange(len(parts)), sizes)]
        stacks = np.zeros((len(parts), LONG), np.int32)
        failed = np.zeros(len(parts), np.uint64)  # a bit for each position
        depth, at, piece, row = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), longest[first], np.arange(len(parts))
        depths = np.zeros(len(parts), np.int64)
        one = np.uint64(1)
        while len(row):
            stop = at + self.size[piece]
            takes = (piece >= 0) & ((failed[row] >> (stop & (LONG - 1)).astype(np.uint64) & one == 0) | (stop == sizes[row]))
            ask = np.flatnonzero(takes & (depth > 0))
            takes[ask] = self.compatible(stacks[row[ask], depth[ask] - 1].astype(np.int64), piece[ask])
            back = np.flatnonzero(piece < 0)
            if len(back):
                failed[row[back]] |= one << at[back].astype(np.uint64)
                depth[back] -= 1
                piece[back] = stacks[row[back], depth[back]]
                at[back] -= self.size[piece[back]]
            piece = np.where(takes, piece, self.shorter[piece])
            won = np.flatnonzero(takes)
            stacks[row[won], depth[won]] = piece[won]
            depth[won] += 1
            at[won] = stop[won]
            ended = takes & (at == sizes[row])
            depths[row[ended]] = depth[ended]
            go = won[~ended[won]]
            piece[go] = longest[first[row[go]] + at[go]]
            row, depth, at, piece = (a[~ended] for a in (row, depth, at, piece))
        return [stack[:n] for stack, n in zip(stacks, depths.tolist(), strict=True)]

    def long_pieces(self, text: str) -> list[int]:
        """As `pieces`, for one text of any length."""
        longest, size, shorter = self.longest(text).tolist(), self.size.tolist(), self.shorter
        out: list[int] = []
        failed = bytearray(len(text) // 8 + 1)
        at, piece = 0, longest[0]
        while at < len(text):
            while piece >= 0:
                stop = at + size[piece]
                if not failed[stop >> 3] >> (stop & 7) & 1 and (not out or self.compatible(np.array([out[-1]]), np.array([piece]))[0]):
                    break
                piece = int(shorter[piece])
            if piece >= 0:
                out.append(piece)
                at = stop
                piece = longest[at] if at < len(text) else -1
            else:  # there is always a piece to take back: every text has an encoding
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= size[piece]
                piece = int(shorter[piece])
        return out

    def ids(self, part: str, pieces) -> bytes:
        """Ids of the pieces that a part has; characters without a piece are spelled in bytes."""
        out = self.out[pieces]
        if (out >= 0).all():
            return out.astype("<u4").tobytes()
        ids, at = [], 0
        for piece, known in zip(list(pieces), out.tolist(), strict=True):
            stop = at + int(self.size[piece])
            ids += [known] if known >= 0 else [self.p.byte_id[b] for b in part[at:stop].encode()] if self.p.byte_id else [self.p.unknown]
            at = stop
        return np.array(ids, "<u4").tobytes()

    def remember(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of all parts; what was met lately is kept in two generations, of which the older goes when the newer is full."""
        again = {part: ids for part in parts if (ids := self.older.get(part)) is not None}
        new = [part for part in parts if part not in again and len(part) <= LONG]
        new.sort(key=len)
        for i in range(0, len(new), 20_000):
            some = new[i : i + 20_000]
            again.update((part, self.ids(part, pieces)) for part, pieces in zip(some, self.pieces(some), strict=True))
        size = sum(220 + 2 * len(part) + len(ids) for part, ids in again.items())
        if self.bytes_known + size > REMEMBERED // 2:
            self.older, self.known, self.bytes_known = self.known, {}, 0
        self.bytes_known += size
        self.known.update(again)
        return again | {part: self.ids(part, self.long_pieces(part)) for part in parts if len(part) > LONG}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with begin and end, little-endian uint32."""
        begin, end = (x.to_bytes(4, "little") for x in (self.p.begin, self.p.end))
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        lists = [self.cut.findall(t) if self.cut else [t] * bool(t) for t in marked]
        found = self.known
        long: list[str] = []
        if new := set().union(*lists).difference(found):
            other = self.remember(new)
            found.update(other)  # also where it has become the older generation meanwhile
            long = [part for part in other if len(part) > LONG]
        out = [b"".join([begin, *map(found.__getitem__, parts), end]) for parts in lists]
        for part in long:
            del found[part]
        return out


class Decoder:
    """Ids back to text: control ids are silent, runs of byte pieces are UTF-8, U+2581 is a space but for the first."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.words = [b"" if i in pieces.silent else " ⁇ ".encode() if i == pieces.unknown else n.replace(SPACE, " ").encode() for i, n in enumerate(pieces.names)]
        self.bytes = np.zeros(len(pieces.names), bool)
        self.bytes[list(pieces.byte_of)] = True
        self.quiet = np.zeros(len(pieces.names), bool)
        self.quiet[list(pieces.silent)] = True
        for i, b in pieces.byte_of.items():
            self.words[i] = bytes([b])

    def decode(self, ids: bytes) -> str:
        ids = np.frombuffer(ids, "<u4")
        words, where = self.words, np.flatnonzero(self.bytes[ids])
        out = [words[i] for i in ids.tolist()]
        first = next((k for k, w in enumerate(out) if w), None)
        if first is not None and not self.bytes[ids[first]] and out[first].startswith(b" ") and ids[first] != self.p.unknown:
            out[first] = out[first][1:]
        try:
            if self.quiet[ids[1:-1]].any():
                raise UnicodeError("a control id parts the bytes beside it")
            return b"".join(out).decode()
        except UnicodeError:  # ids that no text has: each wrong byte becomes U+FFFD
            cuts = np.flatnonzero(np.diff(where) != 1) + 1
            for run in np.split(where, cuts) if len(where) else []:
                raw = b"".join(out[k] for k in run.tolist())
                out[run[0]] = _mended(raw)
                for k in run[1:].tolist():
                    out[k] = b""
            return b"".join(out).decode()


def _mended(raw: bytes) -> bytes:
    """UTF-8 in which every byte that belongs to no character has become U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in range(1, 5):
            try:
                raw[at : at + n].decode()
            except UnicodeDecodeError:
                continue
            if at + n <= len(raw):
                out.append(raw[at : at + n])
                at += n
                break
        else:
            out.append("�".encode())
            at += 1
    return b"".join(out)


@lru_cache(maxsize=2)
def read_pieces(path: str) -> Pieces:
    """The vocabulary of a model file; its size is checked, as it will be broadcast."""
    from sentencepiece import sentencepiece_model_pb2

    if Path(path).stat().st_size > MAX_FILE:
        raise ValueError(f"{path} is larger than {MAX_FILE} bytes")
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(Path(path).read_bytes())
    how = model.normalizer_spec
    kinds = [p.type for p in model.pieces]
    if model.trainer_spec.model_type != 2 or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path} is not a merge-type model with white space in front")
    if how.precompiled_charsmap or not how.add_dummy_prefix or how.remove_extra_whitespaces or not how.escape_whitespaces:
        raise ValueError(f"{path} normalises texts otherwise than by marking spaces")
    if not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"{path} has pieces of the user's own or unused ones")
    return Pieces([p.piece for p in model.pieces], [p.score for p in model.pieces], kinds, model.trainer_spec.bos_id, model.trainer_spec.eos_id)


_workers: dict[int, tuple[Encoder, Decoder]] = {}


def _worker(shared) -> tuple[Encoder, Decoder]:
    pieces = shared.value
    if id(pieces) not in _workers:
        _workers.clear()
        _workers[id(pieces)] = (Encoder(pieces), Decoder(pieces))
    return _workers[id(pieces)]


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, ids (binary, little-endian uint32, with begin and end) and, if asked for, the decoded text."""
    shared = docs.sparkSession.sparkContext.broadcast(read_pieces(path))
    names = ["doc_id", "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _worker(shared)
        for batch in batches:
            at = 0
            for texts in groups_of(batch.column(1).to_pylist()):
                ids = encoder.encode(texts)
                columns = [batch.column(0).slice(at, len(texts)), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array(map(decoder.decode, ids), pa.string()))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    rows = docs.select("doc_id", F.coalesce(docs[text], F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded (text) from doc_id, ids; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _worker(shared)
        for batch in batches:
            out = [decoder.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, decoded string")


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), decoded=True))
