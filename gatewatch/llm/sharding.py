"""Sharding by extendible hashing.

A row's hash bits come from the md5 of its key and text. A directory maps hash
prefixes to shards; a prefix whose rows exceed the byte limit is split on the next
bits, every other one stays as it is. The texts are read once to store (hash, bytes) per
row; the directory grows on these narrow rows in levels of ``LEVEL_BITS``: one aggregate
per level counts bytes per prefix (map-side combined, at most ``2**LEVEL_BITS`` cells under
every prefix that is still too large), the shallowest prefix that fits becomes a leaf, and
only rows below an oversized prefix go on.

The finished directory holds leaves only: one number per leaf (see ``_directory``), gathered
into an array per ``LEVEL_BITS`` of prefix. A row finds its leaf by those bits and one filter
over the array, so while the directory has at most ``MAX_LEAVES`` leaves (32 MB; counted) it is
broadcast and no text is shuffled; beyond that the same join runs as a shuffle join.

Rows equal in key and text share all their hash bits. When such a group alone exceeds
the limit, its rows are written once with a row number's hash, and split on the stored bits in
the same way. A single row above the limit gets a shard of its own, the one case in which a
shard is over the limit. Null key and null text count as empty; very long texts are hashed
whole; an empty table gives no rows and no shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import BROADCAST_ROWS, broadcast_if_small, materialize

LEVEL_BITS = 12
HASH_BITS = 60  # of the md5
TIE_BITS = 48  # of a row number's hash, for rows that share the md5
#: Leaves a broadcast directory may have, 8 bytes each.
MAX_LEAVES = 4_000_000
#: Production limit of the registered query: 64 MiB of text a shard.
SHARD_BYTES = 64 * 1024 * 1024


def _cells(rows: DataFrame, limit: int) -> DataFrame:
    """Prefixes of a level under each open parent: (parent, depth, prefix) with bytes,
    rows, and whether it fits; only those whose own parent prefix does not fit."""
    keys = ["__g", "__at"]
    fine = rows.groupBy(*keys, "__bits").agg(F.sum("__bytes").alias("b"), F.count(F.lit(1)).alias("n"))
    up = (fine.select(*keys, "b", "n", F.col("__bits").alias("f"), F.explode(F.sequence(F.lit(0), F.lit(LEVEL_BITS))).alias("depth"))
          .withColumn("prefix", F.expr(f"shiftright(f, {LEVEL_BITS} - depth)"))
          .groupBy(*keys, "depth", "prefix").agg(F.sum("b").alias("b"), F.sum("n").alias("n")))
    fits = (F.col("b") <= limit) | (F.col("n") == 1)
    over = up.where(~fits).select(*keys, (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
    root = up.where(F.col("depth") == 0).select(*keys, "depth", "prefix")
    return up.join(root.unionByName(over), [*keys, "depth", "prefix"]).withColumn("fits", fits)


def _grow(rows: DataFrame, width: int, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """rows (__g, __v, __bytes): the leaves (__g, depth, prefix) over the ``width`` bits of __v in
    each group __g, and the whole values (__g, __at) that are too large even so (None: none)."""
    leaves, open_ = [], None
    for used in range(0, width, LEVEL_BITS):
        part = rows.select("__g", "__bytes", F.shiftright("__v", width - used).alias("__at"),
                           F.shiftright("__v", width - used - LEVEL_BITS).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).alias("__bits"))
        if open_ is not None:
            part = part.join(broadcast_if_small(open_), ["__g", "__at"], "left_semi")
        cells = materialize(_cells(part, limit), "shard_cells")
        path = F.expr("shiftleft(__at, depth)") + F.col("prefix")
        leaves.append(cells.where("fits").select("__g", (F.col("depth") + used).alias("depth"), path.alias("prefix")))
        open_ = cells.where(~F.col("fits") & (F.col("depth") == LEVEL_BITS)).select("__g", path.alias("__at"))
        if open_.isEmpty():
            open_ = None
            break
    return reduce(DataFrame.unionByName, leaves), open_


def _directory(leaves: DataFrame, width: int) -> DataFrame:
    """(__g, __top, __leaves): the leaves below or above each value of the first LEVEL_BITS. A leaf
    is the number ``(2 * prefix + 1) << (width - depth)``: its lowest set bit tells the depth, the
    bits above it are the prefix."""
    first = F.expr(f"IF(depth <= {LEVEL_BITS}, shiftleft(prefix, greatest({LEVEL_BITS} - depth, 0)), shiftright(prefix, greatest(depth - {LEVEL_BITS}, 0)))")
    covered = F.expr(f"shiftleft(1L, greatest({LEVEL_BITS} - depth, 0))")
    return (leaves.select("__g", F.expr(f"shiftleft(prefix * 2 + 1, {width} - depth)").alias("leaf"),
                          F.explode(F.sequence(first, first + covered - 1)).alias("__top"))
            .groupBy("__g", "__top").agg(F.sort_array(F.collect_list("leaf")).alias("__leaves")))


def _assign(rows: DataFrame, leaves: DataFrame, width: int) -> DataFrame:
    """``rows`` with ``__path``, the bits of __v down to its leaf; null where no leaf covers it."""
    entries = materialize(_directory(leaves, width), "shard_directory")
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("__leaves")).alias("leaves")).first()
    if size["n"] <= BROADCAST_ROWS and (size["leaves"] or 0) <= MAX_LEAVES:
        entries = F.broadcast(entries)
    low = "(x & -x)"
    found = rows.withColumn("__top", F.shiftright("__v", width - LEVEL_BITS)).join(entries, ["__g", "__top"], "left")
    leaf = F.expr(f"try_element_at(filter(__leaves, x -> (shiftleft(__v, 1) ^ x) < 2 * {low}), 1)")
    return (found.withColumn("__leaf", leaf)
            .withColumn("__path", F.expr(f"substring(lpad(bin(__v), {width}, '0'), 1, {width + 1} - length(bin(__leaf & -__leaf)))"))
            .drop("__top", "__leaves", "__leaf"))


def _hash(key: str, text: str) -> Column:
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def shard(docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with three more columns: ``shard`` (the hash prefix as a bit string, '' when
    everything fits one shard), ``shard_depth`` (bits used) and ``shard_bytes_row`` (UTF-8
    bytes of the row's text). Columns of ``docs`` with these names are replaced."""
    if limit < 1:
        raise ValueError("limit must be positive")
    docs = docs.drop("shard", "shard_depth", "shard_bytes_row")
    n_bytes = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    rows = docs.select("*", F.lit(0).cast("long").alias("__g"), _hash(key, text).alias("__v"), n_bytes.alias("__bytes"))
    leaves, hot = _grow(materialize(rows.select("__g", "__v", "__bytes"), "shard_rows"), HASH_BITS, limit)
    named = _assign(rows, leaves, HASH_BITS)
    if hot is not None:
        groups = broadcast_if_small(materialize(hot.select(F.col("__at").alias("__v")), "shard_hot"))
        tie = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << TIE_BITS) - 1))
        same = materialize(rows.join(groups, "__v", "left_semi").drop("__g").withColumnRenamed("__v", "__g").withColumn("__v", tie), "shard_copies")
        more, rest = _grow(same.select("__g", "__v", "__bytes"), TIE_BITS, limit)
        if rest is not None:  # rows equal in all bits share a shard
            more = more.unionByName(rest.select("__g", F.lit(TIE_BITS).alias("depth"), F.col("__at").alias("prefix")))
        split = _assign(same, more, TIE_BITS).withColumn("__path", F.concat(F.expr(f"lpad(bin(__g), {HASH_BITS}, '0')"), "__path"))
        named = named.where(F.col("__path").isNotNull()).unionByName(split)
    return named.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col("__path").alias("shard"),
        F.length("__path").alias("shard_depth"), F.col("__bytes").alias("shard_bytes_row"))
