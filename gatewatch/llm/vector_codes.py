"""Product codes of vectors: integer k-means per part over Hilbert-sorted blocks.

Components become integers floor(4096 x); a vector is cut into 8 equal parts. The rows of a
part position are sorted along a Hilbert curve over its components and cut into flat blocks,
each stored with its min/max box and its component sums. In every round a block's box gives
for each codebook entry the least and greatest squared distance any of its rows can have;
entries whose least exceeds the smallest greatest one are out. When one entry is left, the
block's stored sums and count go to it unread; else the short list is evaluated by exact
integer distances. Ties go to the lower entry (it can't be ruled out by an equal one).

Blocks hold about ``BLOCK_BYTES`` and never cross a part. Per round, tasks return partial sums
per (part, entry, component), which Spark adds up; the driver gets 16 * (dimension + 8)
numbers whatever the number of rows, and sends the new codebooks (as small) with the next
pass. Sorting is by (part, Hilbert key, row), so a vector that a third of the rows share is cut over many
blocks, which are boxes of one point.

Dropped: rows whose vector is null or holds null or non-finite components. The dimension is
that of the kept vector with the smallest id (ties by vector). Rows that can't be coded
(another length, a length that 8 does not divide, components beyond the bound that keeps
squared distances in 64 bits: 32,768 for 64 dimensions, 8,192 for 1,024) stay with a
null code and error and take no part in the codebooks. Fewer than 16 rows give fewer entries;
repeated rows count each; null ids come last; an empty table gives no rows. Vectors of length
0 have empty parts and code 00. Columns besides id, vector and label are not looked at."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import broadcast_if_small, materialize, ship_code

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
KEY_BITS = 62
BLOCK_BYTES = 16 * 1024


def largest(dim: int) -> int:
    """Component bound under which a vector's squared distance stays below 2 ** 62."""
    return min(2**31 - 1, isqrt(2**62 // max(1, dim)) // 2)


# ---------------------------------------------------------------- numeric kernels

def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of grid points (n, dims) of ``bits`` bits per axis:
    rotations undone from the top bit, Gray code, then the bits interleaved."""
    x = x.astype(np.int64).copy()
    dims = x.shape[1]
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(dims):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(on, q - 1, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[:, -1] & q, q - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[:, i] >> b & 1
    return key


def _grid(sub: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, int]:
    """Components -> cells of the axes that fit the key (the first KEY_BITS, if there are more)."""
    dims = min(sub.shape[1], KEY_BITS)
    bits = max(1, min(15, KEY_BITS // max(1, dims)))
    span = np.maximum(high[:dims] - low[:dims], 1)
    return (sub[:, :dims] - low[:dims]) * ((1 << bits) - 1) // span, bits


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to some point of the box, ascending."""
    least = (np.maximum(np.maximum(low - book, book - high), 0) ** 2).sum(1)
    most = (np.maximum(np.abs(low - book), np.abs(high - book)) ** 2).sum(1)
    return np.flatnonzero(least <= most.min())


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row (ties: lower) and its squared distance."""
    d = ((rows[:, None, :] - book[None, :, :]) ** 2).sum(2)
    at = d.argmin(1)
    return at, d[np.arange(len(rows)), at]


# ---------------------------------------------------------------- passes over the data

def _int_rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim).astype(np.int64)


def _spans(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each component: 2 * dim numbers."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for b in batches:
            if b.num_rows:
                v = _int_rows(b, dim)
                low = v.min(0) if low is None else np.minimum(low, v.min(0))
                high = v.max(0) if high is None else np.maximum(high, v.max(0))
        if low is not None:
            yield pa.RecordBatch.from_pydict({"at": np.arange(dim, dtype=np.int32), "lo": low, "hi": high})

    found = rows.select("v").mapInArrow(per_task, "at int, lo long, hi long").groupBy("at").agg(F.min("lo"), F.max("hi")).collect()
    low, high = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
    for at, lo, hi in found:
        low[at], high[at] = lo, hi
    return low, high


_BLOCK = "part int, n int, refs binary, flat binary, low binary, high binary, sums binary"


def blocks(rows: DataFrame, dim: int) -> DataFrame:
    """(ref, v) -> Hilbert-sorted flat blocks of every part position."""
    d = dim // PARTS
    low, high = _spans(rows, dim)
    wide = np.int16 if max(-low.min(initial=0), high.max(initial=0)) < 2**15 else np.int32
    size = max(16, BLOCK_BYTES // max(1, 4 * d))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v, ref = _int_rows(b, dim), b.column("ref")
                for p in range(PARTS):
                    at = slice(p * d, (p + 1) * d)
                    sub = v[:, at]
                    key = hilbert_keys(*_grid(sub, low[at], high[at])) if d else np.zeros(len(v), np.int64)
                    raw = sub.astype(wide).tobytes()
                    step = d * np.dtype(wide).itemsize
                    yield pa.RecordBatch.from_pydict({
                        "part": np.full(len(v), p, np.int32), "key": key, "ref": ref,
                        "flat": pa.array([raw[i * step:(i + 1) * step] for i in range(len(v))], pa.binary())})

    def block(part: int, refs: list, flat: list) -> dict:
        x = np.frombuffer(b"".join(flat), wide).reshape(len(refs), d).astype(np.int64)
        ints = {"low": x.min(0), "high": x.max(0), "sums": x.sum(0)}
        return {"part": part, "n": len(refs), "refs": np.array(refs, np.int64).tobytes(),
                "flat": x.astype(np.int32).tobytes(), **{k: z.tobytes() for k, z in ints.items()}}

    schema = pa.schema([("part", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("refs", "flat", "low", "high", "sums")]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, refs, flat = None, [], []
        for b in batches:
            full = []
            for p, r, f in zip(b.column("part").to_pylist(), b.column("ref").to_pylist(), b.column("flat").to_pylist(), strict=True):
                if p != part or len(refs) == size:
                    if refs:
                        full.append(block(part, refs, flat))
                    part, refs, flat = p, [], []
                refs.append(r)
                flat.append(f)
            if full:
                yield pa.RecordBatch.from_pylist(full, schema)
        if refs:
            yield pa.RecordBatch.from_pylist([block(part, refs, flat)], schema)

    long = rows.select("ref", "v").mapInArrow(parts, "part int, key long, ref long, flat binary")
    dealt = long.repartitionByRange("part", "key", "ref").sortWithinPartitions("part", "key", "ref")
    return dealt.select("part", "ref", "flat").mapInArrow(pack, _BLOCK)


def _ints(raw: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(raw, kind).astype(np.int64)


def _round(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """One assignment and update: codebooks (parts, entries, d) -> the next ones."""
    parts, entries, d = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, d + 1), np.int64)  # the last column counts
        for b in batches:
            for row in b.to_pylist():
                p, book = row["part"], books[row["part"]]
                live = shortlist(_ints(row["low"]), _ints(row["high"]), book)
                if len(live) == 1:
                    total[p, live[0], :d] += _ints(row["sums"])
                    total[p, live[0], d] += row["n"]
                else:
                    x = _ints(row["flat"], np.int32).reshape(-1, d)
                    at = live[nearest(x, book[live])[0]]
                    for e in live:
                        total[p, e, :d] += x[at == e].sum(0)
                    total[p, :, d] += np.bincount(at, minlength=entries)
        p, e, c = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"part": p.astype(np.int32), "entry": e.astype(np.int32), "at": c.astype(np.int32), "s": total[p, e, c]})

    got = (table.select("part", "n", "flat", "low", "high", "sums").mapInArrow(sums, "part int, entry int, at int, s long")
           .groupBy("part", "entry", "at").agg(F.sum(F.col("s").cast("decimal(38,0)"))).collect())
    total = {(p, e, c): int(s) for p, e, c, s in got}
    out = books.copy()
    for p in range(parts):
        for e in range(entries):
            if n := total.get((p, e, d), 0):
                out[p, e] = [total.get((p, e, c), 0) // n for c in range(d)]
    return out


def _assign(table: DataFrame, books: np.ndarray) -> DataFrame:
    """(ref, bits, error): every part's final entry, at its place in the code, and distance."""
    d = books.shape[2]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                book = books[row["part"]]
                live = shortlist(_ints(row["low"]), _ints(row["high"]), book)
                at, error = nearest(_ints(row["flat"], np.int32).reshape(row["n"], d), book[live])
                yield pa.RecordBatch.from_pydict({"ref": _ints(row["refs"]), "bits": live[at] << 8 * (PARTS - 1 - row["part"]), "error": error})

    return table.mapInArrow(codes, "ref long, bits long, error long")


# ---------------------------------------------------------------- the operator

def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Kept rows (id, label, v): integer components floor(4096 x)."""
    x = F.col(vector).cast("array<double>")
    odd = F.exists(x, lambda a: a.isNull() | F.isnan(a) | (F.abs(a) == float("inf")))
    return (df.select(F.col(key).alias("id"), F.col(label).alias("label"), x.alias("x"))
            .where(x.isNotNull() & ~odd).select("id", "label", F.transform("x", lambda a: F.floor(a * SCALE).cast("long")).alias("v")))


def _codable(v: Column, dim: int) -> Column:
    bound = largest(dim)
    return (F.size(v) == dim) & F.lit(dim % PARTS == 0) & ~F.exists(v, lambda a: (a > bound) | (a < -bound))


class Codes:
    """Result of ``encode``: ``rows`` (id, label, code, error) and ``books`` (parts, entries, d)."""

    def __init__(self, rows: DataFrame, books: np.ndarray):
        self.rows, self.books = rows, books

    def books_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def encode(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> Codes:
    """Learns the codebooks from all rows and codes all rows."""
    ship_code(df.sparkSession)
    kept = materialize(integer_vectors(df, key, vector, label).withColumn("ref", F.monotonically_increasing_id()), "vectors")
    smallest = lambda rows, n: rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(n).collect()
    head = smallest(kept, 1)
    dim = len(head[0][0]) if head else 0
    rows = kept.where(_codable(F.col("v"), dim))
    seeds = smallest(rows, ENTRIES)
    d = dim // PARTS
    books = np.array([[s[0][p * d:(p + 1) * d] for s in seeds] for p in range(PARTS)], np.int64).reshape(PARTS, len(seeds), d)
    names = kept.select("ref", "id", "label", F.lit(None).cast("long").alias("bits"), F.lit(None).cast("long").alias("error"))
    if not seeds:
        out = names.select("id", "label", F.lit(None).cast("string").alias("code"), "error")
        return Codes(out, books)
    table = materialize(blocks(rows, dim), "vector_blocks")
    for _ in range(rounds):
        books = _round(table, books)
    found = _assign(table, books).select("ref", F.lit(None).cast(names.schema["id"].dataType).alias("id"),
                                         F.lit(None).cast(names.schema["label"].dataType).alias("label"), "bits", "error")
    # a vector's eight parts and its id meet by row number
    met = names.unionByName(found).groupBy("ref").agg(F.max("id").alias("id"), F.max("label").alias("label"), F.bit_or("bits").alias("bits"), F.sum("error").alias("error"))
    return Codes(met.select("id", "label", F.lower(F.lpad(F.hex("bits"), 2 * PARTS, "0")).alias("code"), "error"), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds the error summed over equal labels, nulls together: sums per task and label
    first, then joined back to the rows."""
    rows = materialize(rows, "vector_codes")
    total = rows.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return rows.join(broadcast_if_small(total), F.col("label").eqNullSafe(F.col("__label")), "left").drop("__label")
