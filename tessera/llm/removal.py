"""What the two substring operators share: from marked positions to shortened texts.

Positions of a document arrive from many buckets. They are dealt by document, merged into
maximal intervals there, and joined with the texts, which travel compressed and once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import arrays as A
from tessera.llm.common import discard, stage, text_of

MARKS = "bucket int, kind int, ids binary, runs binary, pos binary"
CODEC = "zstd"


def key_of(docs: DataFrame) -> Column:
    """The doc_id; a null one is replaced by a number of its text that no doc_id is, and that no other text has.

    Which number that is depends on the rows alone, so every call for them gives the same.
    """
    ids, text = docs["doc_id"].cast("bigint"), text_of(docs)
    without = docs.where(ids.isNull())
    if without.isEmpty():
        return ids
    for seed in count():
        name = F.xxhash64(F.lit(seed), text)
        names = stage(without.select(name.alias("name"), F.sha2(text, 256).alias("digest")).distinct(), "names")
        taken = docs.where(ids.isNotNull()).select(ids.alias("name")).join(names, "name", "left_semi")
        free = taken.isEmpty() and names.groupBy("name").count().where("count > 1").isEmpty()
        discard(names)
        if free:
            return F.coalesce(ids, name)
    raise AssertionError


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(key_of(docs).alias("key"), text_of(docs).alias("text"))


def mark_rows(keys: np.ndarray, pos: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(bucket of the document, ids, runs, pos) for positions in order of document."""
    where = A.key_bucket(keys, buckets)
    order = np.argsort(where, kind="stable")
    for b, x, y in A.slices(where[order]):
        part = order[x:y]
        ids, n = A.runs(keys[part])
        yield b, A.pack_keys(ids), A.pack(n), A.pack(pos[part])


def _by_key(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each document of a bucket with its marked positions, ascending."""
    keys = np.concatenate([np.repeat(A.unpack_keys(i), A.unpack(n)) for i, n in zip(table["ids"].to_pylist(), table["runs"].to_pylist(), strict=True)])
    pos = np.concatenate([A.unpack(p).astype(np.int64) for p in table["pos"].to_pylist()])
    order = np.lexsort((pos, keys))
    keys, pos = keys[order], pos[order]
    for k, x, y in A.slices(keys):
        yield k, pos[x:y]


def positions(marks: DataFrame) -> DataFrame:
    """key, pos (packed): one row for each document with marked positions."""

    def gather(table: pa.Table) -> pa.Table:
        found = [(k, A.pack(np.unique(pos))) for k, pos in _by_key(table)]
        return pa.table({"key": pa.array([k for k, _ in found], pa.int64()), "pos": pa.array([p for _, p in found], pa.binary())})

    return marks.select("bucket", "ids", "runs", "pos").groupBy("bucket").applyInArrow(gather, "key bigint, pos binary")


def intervals(marks: DataFrame, size: int) -> DataFrame:
    """key, starts, stops (packed): the maximal runs of places that marked windows cover, by document."""

    def merge(table: pa.Table) -> pa.Table:
        found = [(k, *map(A.pack, A.merged(pos, size))) for k, pos in _by_key(table)]
        return pa.table({n: pa.array([f[i] for f in found], t) for i, (n, t) in enumerate((("key", pa.int64()), ("starts", pa.binary()), ("stops", pa.binary())))})

    return marks.select("bucket", "ids", "runs", "pos").groupBy("bucket").applyInArrow(merge, "key bigint, starts binary, stops binary")


def packed_texts(docs: DataFrame, body: Callable[[bytes], bytes]) -> DataFrame:
    """doc_id, key, size, body: the compressed form in which texts travel."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(CODEC, compression_level=3)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                bodies = [body(t.encode()) for t in part.column(2).to_pylist()]
                packed = [codec.compress(b, asbytes=True) for b in bodies]
                sizes = pa.array([len(b) for b in bodies], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), sizes, pa.array(packed, pa.binary())], ["doc_id", "key", "size", "body"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", key_of(docs).alias("key"), text_of(docs).alias("text"))
    return texts.mapInArrow(compress, f"doc_id {kind}, key bigint, size bigint, body binary")


def packed(body: bytes) -> bytes:
    return pa.Codec(CODEC, compression_level=3).compress(body, asbytes=True)


def unpacked(size: int, body: bytes) -> bytes:
    return pa.Codec(CODEC).decompress(body, decompressed_size=size, asbytes=True) if size else b""


def shortened(docs: DataFrame, found: DataFrame, body: Callable[[bytes], bytes], cut: Callable, columns: str) -> DataFrame:
    """doc_id and what `cut(body, starts, stops)` makes of each document, rows without intervals included.

    `body` is applied to the text before it travels. `columns` names and types the results.
    """
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    fields = [pa.field(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rows = []
                for n, b, s, e in zip(*(part.column(i).to_pylist() for i in range(1, 5)), strict=True):
                    rows.append(cut(unpacked(n, b), A.unpack(s).astype(np.int64) if s else [], A.unpack(e).astype(np.int64) if e else []))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True))], ["doc_id", *(f.name for f in fields)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = packed_texts(docs, body).join(found, "key", "left").select("doc_id", "size", "body", "starts", "stops")
    return joined.mapInArrow(apply, f"doc_id {kind}, {columns}")
