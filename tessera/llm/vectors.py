"""Vector code compression: product codes, with each nearest entry found through a VA-file.

Every vector is made of integers, cut into `PARTS` equal parts, and each part is replaced by the
index of the nearest of `ENTRIES` codebook entries. The codebooks are fitted in `ROUNDS` rounds over
all vectors: assign every part, then set each entry to the mean of its parts.

The nearest entry is found by VA-file filtering. The entries' coordinates are quantised to `BITS`
bits: in each dimension they fall into cells, of which the smallest and largest coordinate are
known. For a query, a lookup table holds the least and the greatest squared difference to every
cell of every dimension; sums of it bound the distance to each entry from below and from above. An
entry whose lower bound exceeds another one's upper bound can't be the nearest. The rest, the
overlapping candidates, are refined with integer distances. Bounds are floating point with a margin
well above their rounding, so what is left out is farther for certain and never a tie.

In a round, tasks send sums and counts of each entry alone, at most `PARTS * ENTRIES * (length of a
part + 1)` rows; Spark adds them up, and the driver reads as many numbers. The vectors are staged
once, as integers, and no vector moves after that.

Defined results: rows whose vector is null, or holds null or non-finite components, are dropped.
A null vec_id is allowed and comes after all others; rows that repeat are rows of their own, and of
equal vec_ids the smaller vector (as little-endian bytes) comes first. Fewer vectors than `ENTRIES`
make as many entries; an empty table gives an empty result. Where lengths differ, or aren't a
multiple of `PARTS`, vectors are filled up with zeros at the end. Integers are held within the bound
that keeps all squared distances of a vector within 63 bits (46,340 times `SCALE` for 64 components),
larger ones count as that bound; sums over labels beyond 2^63 - 1 count as that. Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, stage

PARTS, ENTRIES, ROUNDS, SCALE, BITS = 8, 16, 6, 4096, 3
AT_ONCE, MARGIN, LARGEST = 4096, 1e-9, (1 << 63) - 1


class Cells:
    """The VA-file of one codebook: which cell each entry's coordinates are in, and the bounds of the cells."""

    def __init__(self, entries: np.ndarray, bits: int = BITS):
        self.entries = entries
        count, length = entries.shape
        cells = 1 << bits
        rank = np.argsort(np.argsort(entries, axis=0, kind="stable"), axis=0, kind="stable")
        cell = rank * cells // max(count, 1)  # about as many coordinates in each cell
        self.low, self.high = np.zeros((length, cells)), np.zeros((length, cells))
        for d in range(length):
            for c in np.unique(cell[:, d]):
                inside = entries[cell[:, d] == c, d]
                self.low[d, c], self.high[d, c] = inside.min(), inside.max()
        # Summing a table's rows over an entry's cells is a product with this matrix of zeros and ones.
        self.pick = np.zeros((length * cells, count))
        for e in range(count):
            self.pick[np.arange(length) * cells + cell[e], e] = 1

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the squared distance of each query to each entry."""
        q = queries.astype(np.float64)[:, :, None]
        below, above = self.low - q, q - self.high
        n = len(queries)
        far = np.square(np.maximum(-below, -above))  # to the farther end of the cell
        near = np.square(np.maximum(np.maximum(below, above), 0))
        return near.reshape(n, -1) @ self.pick * (1 - MARGIN), far.reshape(n, -1) @ self.pick * (1 + MARGIN)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lower one of ties, and the squared distance, exactly."""
        lower, upper = self.bounds(queries)
        row, entry = np.nonzero(lower <= upper.min(axis=1, keepdims=True))
        exact = np.square(queries[row] - self.entries[entry]).sum(axis=1)
        distance = np.full(lower.shape, LARGEST)
        distance[row, entry] = exact
        best = distance.argmin(axis=1)
        return best, distance[np.arange(len(queries)), best]


@dataclass(frozen=True)
class Codebooks:
    entries: np.ndarray  # int64: part, entry, position

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vector: str) -> str:
    return f"{vector} IS NOT NULL AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"


def integers(table: DataFrame, vector: str, length: int, scale: int) -> DataFrame:
    """vec_id, label, body (little-endian int32 components) of the rows that count, filled up to `length`."""
    most = isqrt(LARGEST // (4 * max(length, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            sizes = np.diff(np.asarray(lists.offsets).astype(np.int64))
            rows, at = np.repeat(np.arange(len(batch)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            body = np.zeros((len(batch), length), "<i4")
            body[rows, at] = np.clip(values, -most, most)
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * length), len(batch), [None, pa.py_buffer(body.tobytes())]).cast(pa.binary()) if length else pa.array([b""] * len(batch), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["vec_id", "label", "body"])

    rows = table.where(usable(f"`{vector}`")).select("vec_id", "label", F.col(vector).cast("array<double>").alias("vector"))
    kinds = [table.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return rows.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, body binary")


def blocks(batch: pa.RecordBatch, column: int, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where a block of rows begins, and its vectors as (row, part, position)."""
    for at in range(0, len(batch), AT_ONCE):
        bodies = batch.column(column).slice(at, AT_ONCE).to_pylist()
        yield at, np.frombuffer(b"".join(bodies), "<i4").astype(np.int64).reshape(len(bodies), parts, -1)


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over all rows."""
    parts, count, length = books.entries.shape
    shared = rows.sparkSession.sparkContext.broadcast(books.entries)  # parts * entries * length integers

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(e) for e in shared.value]
        total = np.zeros((parts, count, length + 1), np.int64)
        for batch in batches:
            for _, vectors in blocks(batch, 0, parts):
                for p in range(parts):
                    best, _ = cells[p].nearest(vectors[:, p])
                    member = np.zeros((count, len(best)))
                    member[best, np.arange(len(best))] = 1
                    # Sums of a block are below 2**53, so they are exact.
                    total[p, :, :length] += (member @ vectors[:, p].astype(np.float64)).astype(np.int64)
                    total[p, :, length] += np.bincount(best, minlength=count)
        at = np.argwhere(np.broadcast_to(total[:, :, length:] > 0, total.shape))
        yield pa.RecordBatch.from_arrays([*(pa.array(at[:, i].astype(np.int32)) for i in range(3)), pa.array(total[tuple(at.T)])], ["part", "entry", "position", "total"])

    found = rows.select("body").mapInArrow(sums, "part int, entry int, position int, total bigint")
    added = found.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {(r.part, r.entry, r.position): int(r.total) for r in added}
    entries = books.entries.copy()
    for (p, e, i), s in total.items():
        if i < length:
            entries[p, e, i] = s // total[p, e, length]
    return Codebooks(entries)


def first_entries(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    found = rows.orderBy(F.col("vec_id").asc_nulls_last(), "body").limit(entries).select("body").collect()
    body = np.frombuffer(b"".join(bytes(r.body) for r in found), "<i4").astype(np.int64)
    if not found:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    return Codebooks(body.reshape(len(found), parts, -1).transpose(1, 0, 2).copy())


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits for each part), error."""
    parts = len(books.entries)
    shared = rows.sparkSession.sparkContext.broadcast(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(e) for e in shared.value]
        for batch in batches:
            codes, errors = [], []
            for _, vectors in blocks(batch, 2, parts):
                found = [cells[p].nearest(vectors[:, p]) for p in range(parts)]
                index = np.stack([best for best, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                codes += [index[i : i + 2 * parts] for i in range(0, len(index), 2 * parts)]
                errors.append(np.sum([distance for _, distance in found], axis=0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(np.concatenate(errors) if errors else [], pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return rows.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error bigint")


def fitted(table: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """The usable rows as staged integers (vec_id, label, body), and codebooks fitted to all of them."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits: from 1 to 256 entries")
    longest = table.where(usable(f"`{vector}`")).agg(F.max(F.size(vector))).first()[0] or 0
    rows = stage(integers(table, vector, -(-longest // parts) * parts, scale), "vectors")
    books = first_entries(rows, parts, entries)
    for _ in range(rounds if books.entries.size else 0):
        books = moved(rows, books)
    return rows, books


def compressed(table: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error), and the codebooks that `expanded` needs to get vectors back."""
    rows, books = fitted(table, vector, parts, entries, rounds, scale)
    codes = stage(coded(rows, books), "vector-codes")
    discard(rows)
    return codes, books


def expanded(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """vec_id, vector: what the codes say of each vector, the middle of an integer's range for each component."""
    shared = codes.sparkSession.sparkContext.broadcast(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            index = np.frombuffer(bytes.fromhex("".join(batch.column(1).to_pylist())), np.uint8).reshape(len(batch), len(books))
            values = (np.concatenate([books[p][index[:, p]] for p in range(len(books))], axis=1) + 0.5) / scale
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(values), pa.list_(pa.float64()))], ["vec_id", "vector"])

    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, vector array<double>")


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    codes, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sums = codes.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST)).cast("bigint").alias("label_error"))
    sums = stage(sums.toDF("_label", "label_error"), "label-errors")
    joined = codes.join(sums, codes["label"].eqNullSafe(sums["_label"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _sql() -> str:
    """The same by brute force: every part against every entry, in each round."""
    square = "list_sum(list_transform(list_zip(x.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    assign = f"SELECT x.r, x.p, min((coalesce({square}, 0)::HUGEINT, c.e)) AS b, any_value(x.q) AS q FROM parts x JOIN c{{0}} c USING (p) GROUP BY x.r, x.p"
    steps = []
    for i in range(ROUNDS):
        steps.append(
            f"""a{i} AS MATERIALIZED ({assign.format(i)}),
     m{i} AS (SELECT p, e, list(m ORDER BY i) AS q FROM (
                SELECT p, e, i, ((s - ((s % n + n) % n)) // n)::BIGINT AS m FROM (
                  SELECT p, b[2] AS e, i, sum(q[i]) AS s, count(*) AS n FROM a{i}, unnest(range(1, len(q) + 1)) AS t(i) GROUP BY ALL)) GROUP BY p, e),
     c{i + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN m{i} m ON c.p = m.p AND c.e = m.e)"""
        )
    return f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     parts AS MATERIALIZED (SELECT r, p, q[p * (len(q) // {PARTS}) + 1:(p + 1) * (len(q) // {PARTS})] AS q FROM v, range({PARTS}) AS t(p)),
     c0 AS MATERIALIZED (SELECT p, r - 1 AS e, q FROM parts WHERE r <= {ENTRIES}),
     {", ".join(steps)},
     last AS ({assign.format(ROUNDS)}),
     codes AS (SELECT r, string_agg(printf('%02x', b[2]), '' ORDER BY p) AS code, sum(b[1])::BIGINT AS error FROM last GROUP BY r),
     books AS (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN codes USING (r), books
"""


SQL = _sql()
