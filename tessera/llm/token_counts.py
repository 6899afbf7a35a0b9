"""Token counts by the whole-token shortcut.

Merging a pre-token is needless when the result is known. Offline, on the driver, every
vocabulary string that stands for a whole pre-token (it has the end-of-word mark) is merged
once; those that come out as one token are the shortcut: a pre-token found among them counts
1. Only the rest are merged, all pre-tokens of one length together in numpy: in each round
the pair of lowest rank (the leftmost of equals) is joined in every row, until no row has a
pair left. A task remembers the counts of pre-tokens met lately, in up to `REMEMBERED` bytes, long ones never.

The tokenizer's steps, as its file states them and checked on reading: special strings are
found in the raw text first and count 1 each; what is between them is put into NFC, lower-cased
character by character, and split by the pattern, white space dropped; bytes become symbols.

Defined results: a null text counts as empty and has 0 tokens. Rows are independent of each
other, so ties, repeats, empty tables and further columns need no rule.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import groups_of
from tessera.llm.common import documents, text_of
from tessera.llm.tables import WHITE, IntMap, Lately

MAX_FILE, REMEMBERED, LONG, LIMIT = 64 << 20, 32 << 20, 48, 2048


#: Lower case by Unicode 16 where Python's tables end at 15; and a capital sigma, which has no context here.
LOWER = {0xA7CB: 0x264, 0xA7DC: 0x19B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, ord("Σ"): ord("σ")}


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it is printable, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Merges:
    """Symbols are numbers; a byte has one inside a word and another at its end."""

    def __init__(self, model: dict):
        vocabulary, mark = model["vocab"], model["end_of_word_suffix"]
        self.size = max(vocabulary.values()) + 1
        symbols = byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], np.int64)
        self.final = np.array([vocabulary[s + mark] for s in symbols], np.int64)
        self.rank_of, self.made = {}, []
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank_of[vocabulary[a], vocabulary[b]] = r
            self.made.append(vocabulary[a + b])
        back = {s: b for b, s in enumerate(symbols)}
        words = [w[: -len(mark)] for w in vocabulary if w.endswith(mark)]
        self.whole = [bytes(back[c] for c in w) for w in words if w and all(c in back for c in w)]
        self.index()

    def index(self) -> None:
        self.ranks = IntMap([a * self.size + b for a, b in self.rank_of], list(self.rank_of.values()))
        self.result = np.array(self.made, np.int64)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("ranks", "result")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.index()

    def count_many(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word."""
        out = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == n)
            if n > LONG:
                out[rows] = [self.count_long(words[i]) for i in rows]
                continue
            data = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(len(rows), n)
            m = self.inner[data]
            m[:, -1] = self.final[data[:, -1]]
            out[rows] = n
            while m.shape[1] > 1:
                r = self.ranks.get((m[:, :-1] * self.size + m[:, 1:]).ravel()).reshape(len(rows), -1)
                r = np.where(r < 0, len(self.made), r)
                at = r.argmin(1)
                best = r[np.arange(len(rows)), at]
                go = best < len(self.made)
                rows, m, at, best = rows[go], m[go], at[go], best[go]
                if not len(rows):
                    break
                m[np.arange(len(rows)), at] = self.result[best]
                columns = np.arange(m.shape[1] - 1)
                m = np.take_along_axis(m, columns + (columns > at[:, None]), 1)
                out[rows] = m.shape[1]
        return out

    def count_long(self, word: bytes) -> int:
        """The same for one long word, with a heap of pairs and links between symbols."""
        ids = self.inner[np.frombuffer(word, np.uint8)].tolist()
        ids[-1] = int(self.final[word[-1]])
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := self.rank_of.get((a, b))) is not None]
        heapify(heap)
        left = len(ids)
        while heap:
            r, i, a, b = heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[r], -1, after[j]
            left -= 1
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (q := self.rank_of.get((ids[x], ids[y]))) is not None:
                    heappush(heap, (q, x, ids[x], ids[y]))
        return left


class Counter:
    """Counts the tokens of texts; made on the driver, where it proves its shortcut."""

    def __init__(self, path: str):
        if Path(path).stat().st_size > MAX_FILE:
            raise ValueError(f"{path} is larger than {MAX_FILE} bytes")
        spec = json.loads(Path(path).read_text())
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        told = (steps, split["behavior"], split["invert"], level["type"], level["use_regex"], level["add_prefix_space"], spec["post_processor"])
        if told != (["NFC", "Replace", "Lowercase"], "Removed", True, "ByteLevel", False, False, None):
            raise ValueError(f"{path} has steps that this operator doesn't know")
        self.path, self.merges = path, Merges(spec["model"])
        self.pattern = split["pattern"]["Regex"].replace(r"[^\s", rf"[^{WHITE}")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.shortcut = frozenset(w.decode() for w, n in zip(self.merges.whole, self.merges.count_many(self.merges.whole), strict=True) if n == 1 and valid(w))
        self.ready()

    def ready(self) -> None:
        self.split = regex.compile(self.pattern)
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known = Lately(REMEMBERED, LONG)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("split", "marks", "known")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ready()

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special strings."""
        parts = self.marks.split(text) if self.marks and any(s in text for s in self.special) else [text]
        out: list[str] = []
        for p in parts:
            p = unicodedata.normalize("NFC", p)
            out += self.split.findall((p if p.isascii() else p.translate(LOWER)).lower())
        return out, len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        lists = [self.pretokens(t) for t in texts]
        met = set().union(*(x for x, _ in lists))
        rest = met.difference(self.shortcut)
        found = self.known.get(rest, lambda words: self.merges.count_many([w.encode() for w in words]).tolist())
        found.update(dict.fromkeys(met - rest, 1))
        return [sum(map(found.__getitem__, x)) + n for x, n in lists]


def valid(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


@lru_cache(maxsize=4)
def read_counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    shared = docs.sparkSession.sparkContext.broadcast(read_counter(path))  # the file's size is checked above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.value
        for batch in batches:
            n = [x for texts in groups_of(batch.column(1).to_pylist()) for x in counter.count(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = text_of(docs)
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
