"""SimHash near-dedup with bit-sliced comparison.

Fingerprints: XXH64 (seed 42) of 4-word shingles, a bit set where over half the hashes
have it. Rows with one fingerprint collapse before anything is compared. Candidates of
the others come from the pigeonhole principle: of ``BLOCKS`` blocks of the 64 bits, two
fingerprints at most ``radius`` bits apart agree in at least ``BLOCKS - radius``, so each
fingerprint goes to one bucket per choice of that many blocks (6 blocks, radius 4: 15
buckets of about 21 bits). Nothing is missed and no bucket has a cap.

In a bucket, fingerprints are stored as 64 bit planes, 64 fingerprints to a word. A
query's bit is xored with a whole word, and 64 distances at once are summed by
carry-save adders; a word is abandoned once all its lanes exceed the radius. Buckets of
more than ``CHUNK`` fingerprints are cut into chunks, one group per pair of chunks, so a
hot bucket spreads over tasks. What a batch finds leaves it as a spanning forest (at most
one link a fingerprint), never as all pairs; components are joined up by ``graph``.

Null text and text without words have fingerprint zero and are linked like any other.
Null ids are ignored when the smallest id is sought. Empty tables give no rows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import broadcast_if_small, materialize, row_key, ship_code
from gatewatch.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCKS = 6
CHUNK = 4096
#: Bits of each byte value, lowest first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
#: Words (of 64 candidate lanes) compared at once.
SLICE = 1 << 15


def fingerprint(raw: bytes | None, k: int = SHINGLE) -> int:
    """SimHash of the text's UTF-8 bytes as an unsigned 64-bit number."""
    words = (raw or b"").lower().split()  # ASCII case, ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    shingles = map(b" ".join, zip(*(words[i:i + n] for i in range(min(k, len(words)))), strict=True))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    by = h.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(by[:, j], minlength=256) @ BYTE_BITS for j in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, k: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def fp(raw: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, k) for x in raw], np.uint64).view(np.int64))
    return fp(F.coalesce(text, F.lit("")).cast("binary"))


# -- bit-sliced comparison ---------------------------------------------------

def planes_of(fp: np.ndarray) -> np.ndarray:
    """64 x words: bit b of fingerprint i is bit i % 64 of planes[b, i // 64]."""
    words = (len(fp) + 63) // 64
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[:len(fp)] = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _csa(a, b, c):
    """Carry-save adder: three bit vectors to sum and carry."""
    x = a ^ b
    return x ^ c, (a & b) | (x & c)


def _over(ones, twos, fours, more, radius: int):
    """Lanes whose counter is above the radius (at most 7)."""
    gt, eq = more.copy(), ~more
    for k, plane in ((2, fours), (1, twos), (0, ones)):
        if radius >> k & 1:
            eq &= plane
        else:
            gt |= eq & plane
            eq &= ~plane
    return gt


def close_pairs(fp: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), first[i] <= j < last[i], of fingerprints at most ``radius`` bits apart."""
    planes, base = planes_of(fp), np.arange(len(fp))
    w0 = first // 64
    many = np.where(last > first, (last + 63) // 64 - w0, 0)
    upto = np.cumsum(many)
    total = int(upto[-1]) if len(upto) else 0
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for at in range(0, total, SLICE):
        t = np.arange(at, min(at + SLICE, total))
        q = np.searchsorted(upto, t, side="right")
        w = w0[q] + (t - (upto[q] - many[q]))
        lo = np.clip(first[q] - w * 64, 0, 64).astype(np.uint64)
        hi = np.clip(last[q] - w * 64, 0, 64).astype(np.uint64)
        low_mask = np.where(lo < 64, full << np.minimum(lo, np.uint64(63)), np.uint64(0))
        high_mask = np.where(hi < 64, ~(full << np.minimum(hi, np.uint64(63))), full)
        alive = low_mask & high_mask
        mine = fp[q]
        ones, twos, fours, more = (np.zeros(len(t), np.uint64) for _ in range(4))
        for b in range(0, 64, 8):
            x = [planes[b + k][w] ^ (np.uint64(0) - (mine >> np.uint64(b + k) & np.uint64(1))) for k in range(8)]
            ones, ta = _csa(ones, x[0], x[1])
            ones, tb = _csa(ones, x[2], x[3])
            twos, fa = _csa(twos, ta, tb)
            ones, ta = _csa(ones, x[4], x[5])
            ones, tb = _csa(ones, x[6], x[7])
            twos, fb = _csa(twos, ta, tb)
            fours, eights = _csa(fours, fa, fb)
            more |= eights
            alive = alive & ~_over(ones, twos, fours, more, radius)
            keep = alive != 0
            if not keep.all():  # abandoned: all lanes exceed the radius
                q, w, mine, alive, ones, twos, fours, more = (z[keep] for z in (q, w, mine, alive, ones, twos, fours, more))
            if not len(q):
                break
        if len(q):
            r, lane = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield base[q[r]], w[r] * 64 + lane


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest row reachable from each of n rows over the pairs, ``label`` being known."""
    label = np.arange(n) if label is None else label
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(label, up := label[label]):
            label = up
    return label


def block_links(fp: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between the rows of each group (equal ``group``, adjacent). Rows of side
    0 are compared with those of side 1 if there are any in the group, else with each other."""
    n = len(fp)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[starts, n])
    start, end = np.repeat(starts, size), np.repeat(starts + size, size)
    ones = np.add.reduceat(side.astype(np.int64), starts)
    cross = np.repeat(ones > 0, size)
    first = np.where(cross, end - np.repeat(ones, size), np.arange(n) + 1)
    last = np.where(cross & (side == 1), 0, end)
    del start
    label = np.arange(n)
    for a, b in close_pairs(fp, first, last, radius):
        label = forest(n, a, b, label)
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def _compare(radius: int):
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def links(cols):
            key, lo, hi, side, fp = cols
            change = np.r_[True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
            member, root = block_links(fp.view(np.uint64), np.cumsum(change), side, radius)
            return pa.RecordBatch.from_arrays([pa.array(fp[member]), pa.array(fp[root])], schema=out)

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            if not len(cols[0]):
                continue
            same = np.ones(len(cols[0]), bool)
            for c in cols[:3]:
                same &= c == c[-1]
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = [c[cut:] for c in cols]
            if cut:
                yield links([c[:cut] for c in cols])
        if rest is not None and len(rest[0]):
            yield links(rest)

    return run


# -- DataFrame operator ------------------------------------------------------

def bucket_keys(fp: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """One key per choice of ``blocks - radius`` blocks: the choice and the bits in it."""
    if not 0 < radius < blocks:
        raise ValueError("radius must be below the number of blocks")
    edge = [64 * i // blocks for i in range(blocks + 1)]
    out = []
    for i, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(i).cast("long")
        for c in chosen:
            width = edge[c + 1] - edge[c]
            part = F.shiftrightunsigned(fp, edge[c]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        out.append(key)
    return F.array(*out)


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """Distinct fingerprints (column fp) -> links (u, v) that connect all those at most
    ``radius`` bits apart."""
    ship_code(fps.sparkSession)
    keyed = fps.select("fp", F.explode(bucket_keys(F.col("fp"), radius, blocks)).alias("key"))
    many = keyed.groupBy("key").count()
    hot = broadcast_if_small(materialize(
        many.where(F.col("count") > chunk).select("key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "hot_buckets"))
    keyed = keyed.join(hot, "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    keyed = (keyed.withColumn("own", F.pmod(F.hash("fp"), F.col("chunks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    pairs = keyed.select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp")
    placed = pairs.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "side")
    return placed.mapInArrow(_compare(radius), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; others are not looked at): doc_id, fp, the
    fingerprint that stands for its group (root), component_id and the row key."""
    ship_code(docs.sparkSession)
    rows = materialize(docs.select("doc_id", fingerprint_column(F.col("text"), k).alias("fp"), *row_key(F.col("doc_id"), F.col("text"))), "fingerprints")
    reps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct_fingerprints")
    roots = components(fingerprint_links(reps, radius, blocks, chunk))
    named = reps.join(roots, reps.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "root", "component_id", "__k1", "__k2")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row per group: the one with the smallest doc_id (nulls last, then by
    the row key); of rows equal in id and text one remains."""
    found = near_duplicates(docs, **options)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__k1", "__k2")
    best = found.groupBy("root").agg(F.min(order).alias("b")).select(F.col("b.__k1").alias("__k1"), F.col("b.__k2").alias("__k2"))
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    kept = docs.select("*", k1, k2).join(best, ["__k1", "__k2"])
    return kept.dropDuplicates(["__k1", "__k2"]).select(docs.columns)
