"""Texts as numpy arrays inside tasks: words, rolling hashes, and packed columns of postings.

A posting says that some hash occurs in some document. Rows that carry one posting each cost
more than what they carry, so tasks deal their postings into buckets by hash and send one row
for each bucket, with binary columns; Spark shuffles and groups those rows by bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


#: A random-looking value for each byte.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (BASE, INVERSE))
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of values[start:end] for each range, by differences of prefix sums; spread."""
    up, down = POWERS.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: Words over `PLACES` bytes aren't remembered, others up to about `REMEMBERED` bytes in a worker.
PLACES, REMEMBERED = 64, 16 << 20
WORDS_AT_ONCE = 1 << 15


class _Words:
    """The first eight bytes of the BLAKE2 digest of words, remembered for those met lately."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.size = 0

    def get(self, words: list[bytes]) -> np.ndarray:
        new = set(words).difference(self.known)
        self.size += 180 * len(new)
        if self.size > REMEMBERED:
            new, self.known = set(words), {}
            self.size = 180 * len(new)
        found = self.known
        found.update((w, int.from_bytes(blake2b(w, digest_size=8).digest(), "little")) for w in new)
        out = np.fromiter(map(found.__getitem__, words), np.uint64, len(words))
        for w in new:
            if len(w) > PLACES:
                del found[w]
        return out


WORDS = _Words()


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A value for each word data[start:end] that only equal words share: no words are known that collide."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), WORDS_AT_ONCE):  # a word is some 100 bytes as long as it is an object of Python's
        a, b = starts[i : i + WORDS_AT_ONCE], ends[i : i + WORDS_AT_ONCE]
        raw = data[a[0] : b[-1]].tobytes()
        out[i : i + len(a)] = WORDS.get([raw[x:y] for x, y in zip((a - a[0]).tolist(), (b - a[0]).tolist(), strict=True)])
    return out


#: Moduli and bases of the window hashes: primes below 2**31, so that products fit 64 bits.
PRIMES = ((2147483647, 1402946779, 0), (2147483629, 1719614413, 31), (2147483587, 1207959559, 17))


class _PrimePowers:
    """Powers of a base and of its inverse modulo a prime, as many as were needed so far."""

    def __init__(self, prime: int, base: int):
        self.prime, self.bases, self.tables = prime, (base, pow(base, -1, prime)), [np.ones(1, np.uint64)] * 2

    def get(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) < n:  # the upper half is the lower one times the next power
            size = len(self.tables[0])
            self.tables = [np.concatenate([t, t * np.uint64(pow(b, size, self.prime)) % np.uint64(self.prime)]) for b, t in zip(self.bases, self.tables, strict=True)]
        return [t[:n] for t in self.tables]


PRIME_POWERS = [_PrimePowers(p, b) for p, b, _ in PRIMES]


def _rabin_karp(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """Polynomial of words[start:end] modulo a prime, below 2**31, by differences of prefix sums."""
    prime, shift = np.uint64(PRIMES[which][0]), np.uint64(PRIMES[which][2])
    up, down = PRIME_POWERS[which].get(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum((words >> shift & np.uint64((1 << 31) - 1)) % prime * up[:-1] % prime, out=sums[1:])
    return (sums[ends] - sums[starts]) % prime * down[starts] % prime


def window_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of words[start:end] for each range, modulo two primes at once; spread over 64 bits."""
    both = _rabin_karp(words, starts, ends, 0) << np.uint64(31) | _rabin_karp(words, starts, ends, 1)
    return mix(both + ((ends - starts).astype(np.uint64) << np.uint64(62)))


def window_buckets(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each range from a third polynomial, so that it tells apart what `window_hashes` doesn't."""
    return bucket_of(mix(_rabin_karp(words, starts, ends, 2) + np.uint64(1)), buckets)


def cuts(offsets: np.ndarray, at_most: int) -> Iterator[tuple[int, int]]:
    """From and to of consecutive texts of about `at_most` bytes together; a longer one comes alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + at_most, side="right")) - 1)
        yield at, stop
        at = stop


def text_chunks(batches: Iterator[pa.RecordBatch], at_most: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc keys, bytes, offsets) of consecutive rows of (key, text), of about `at_most` bytes."""
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        text = batch.column(1)
        wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
        _, offsets, data = text.buffers()
        n = len(text)
        if not n:
            continue
        offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        for at, stop in cuts(offsets, at_most):
            yield keys[at:stop], data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]


def words_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    blank = IS_BLANK[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = blank[:-1], blank[1:]
    inside = offsets[(offsets > 0) & (offsets < len(data))]
    before[inside] = True
    after[inside - 1] = True
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def owners(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """0 to buckets - 1, rising with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def key_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return bucket_of(mix(keys.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), buckets)


def pack(values: np.ndarray) -> bytes:
    """Integers in the narrowest unsigned type that holds them, its width first."""
    values = np.asarray(values)
    top = int(values.max()) if len(values) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[data[0]], offset=1)


def pack_keys(keys: np.ndarray) -> bytes:
    """Any int64, as differences to the one before."""
    keys = keys.astype(np.int64).view(np.uint64)
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).astype(np.uint64)).view(np.int64)


def pack56(hashes: np.ndarray) -> bytes:
    """The low seven bytes of each hash; the bucket stands for the top one."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def unpack56(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def slices(sorted_ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(id, from, to) of the runs of equal ids."""
    if len(sorted_ids):
        cuts = np.flatnonzero(np.diff(sorted_ids)) + 1
        edges = [0, *cuts.tolist(), len(sorted_ids)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield int(sorted_ids[a]), a, b


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive equal values: each once, with its count."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    first = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return values[first], np.diff(np.append(first, len(values)))


def merged(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by [start, start + size); starts ascend."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(starts[1:] > starts[:-1] + size)
    return starts[np.concatenate([[0], gap + 1])], starts[np.concatenate([gap, [len(starts) - 1]])] + size
