"""Line dedup by range-partitioned line hashes; the result is a keep bitmap per document.

A text is split at \\n. A line's key is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends
and A-Z lower-cased, hashed to 128 bits. Hashes with (document, position) go to range
partitions by (hash, document) and are sorted there by (hash, document, position): a line
found in a third of all documents is cut over many partitions, yet a document's copies of it
stay together, so the first occurrence in each document is streamed off the sorted rows. Its
counts per hash, added up map-side first, give the keys found in ``min_docs`` documents.
Their lines are dropped everywhere (``keep="none"``) or but for the corpus's first
occurrence in (document id, position) order (``keep="first"``).

Returned per document with dropped lines: the bitmap of its lines, run-length compressed to
the dropped runs. No text is shuffled for that; ``apply_bitmaps`` reads the texts again.

A document is a distinct (id, text): rows equal in both are one document, and each of them
gets its result. A null id is an id like any other (last in order). Null and empty texts are
one empty line. Keys under ``min_chars`` code points are never dropped. An empty table gives
no rows. Other columns are passed on, whatever their names."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.llm.common import broadcast_if_small, materialize, row_key

MIN_DOCS = 10
MIN_CHARS = 1
BLANKS = " \t\n\x0b\x0c\r"
#: Dropped runs (12 bytes each and at least one a row) up to which bitmaps are broadcast.
BROADCAST_RUNS = 500_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, row key, pos, h1, h2) of every line whose key is long enough."""
    low = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    rows = docs.select(F.col(key).alias("id"), *row_key(F.col(key), F.col(text)), F.posexplode(_lines(low)).alias("pos", "line"))
    line = F.btrim("line", F.lit(BLANKS))
    return rows.where(F.length(line) >= min_chars).select(
        "id", "__k1", "__k2", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def common_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Hashes found in at least ``min_docs`` documents: (h1, h2, n_docs, first), ``first`` the
    place of the corpus's first occurrence."""
    order = ["h1", "h2", "__k1", "__k2", "pos"]
    dealt = lines.repartitionByRange("h1", "h2", "__k1").sortWithinPartitions(*order)
    # the window needs (hash, document) together: the range partitions are that already
    copy = Window.partitionBy("h1", "h2", "__k1", "__k2").orderBy("pos")
    first = dealt.withColumn("nth", F.row_number().over(copy)).where("nth = 1")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "__k1", "__k2", "pos")
    return (first.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min(place).alias("first"))
            .where(F.col("n_docs") >= min_docs))


def _runs(dropped: Column) -> Column:
    """Ascending positions -> runs (at, n) of consecutive ones."""
    starts = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) != x - 1))
    ends = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != x + 1))
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("at"), (e - s + 1).alias("n")))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                 min_chars: int = MIN_CHARS, keep: str = "none", broadcast_rows: int | None = None) -> DataFrame:
    """(row key, runs): the dropped lines of each document that has some."""
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    lines = materialize(line_hashes(docs, key, text, min_chars), "line_hashes")
    common = materialize(common_lines(lines, min_docs), "common_lines")
    side = common.select("h1", "h2", *([F.col("first")] if keep == "first" else []))
    side = broadcast_if_small(side) if broadcast_rows is None else broadcast_if_small(side, broadcast_rows)
    hit = lines.join(side, ["h1", "h2"])
    if keep == "first":
        hit = hit.where(~((F.col("first.__k1") == F.col("__k1")) & (F.col("first.__k2") == F.col("__k2")) & (F.col("first.pos") == F.col("pos"))))
    return hit.groupBy("__k1", "__k2").agg(F.array_sort(F.collect_set("pos")).alias("p")).select("__k1", "__k2", _runs(F.col("p")).alias("runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text",
                  broadcast_runs: int = BROADCAST_RUNS) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text (the other lines joined by \\n); columns
    of these names are replaced. Bitmaps are broadcast when their counted runs are few,
    else they meet the texts by row key."""
    docs = docs.drop("n_lines", "n_dropped", "kept_text")
    bitmaps = materialize(bitmaps, "keep_bitmaps")
    if (bitmaps.agg(F.sum(F.size("runs"))).first()[0] or 0) <= broadcast_runs:
        bitmaps = F.broadcast(bitmaps)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *row_key(F.col(key), F.col(text)), _lines(F.col(text)).alias("__lines"))
    rows = rows.join(bitmaps.withColumnRenamed("runs", "__runs"), ["__k1", "__k2"], "left")
    runs, n = F.col("__runs"), F.size("__lines")

    def kept_run(j):
        before = F.get(runs, j - 1)
        start = F.when(j == 0, F.lit(0)).otherwise(before["at"] + before["n"])
        return F.slice("__lines", start + 1, F.coalesce(F.get(runs, j)["at"], n) - start)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), kept_run)), "\n")
    return rows.select(
        "__row.*", n.cast("long").alias("n_lines"),
        F.coalesce(F.aggregate(runs, F.lit(0), lambda a, r: a + r["n"]), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(runs.isNull(), F.coalesce(F.col(f"__row.{text}"), F.lit(""))).otherwise(kept).alias("kept_text"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text."""
    return apply_bitmaps(docs, keep_bitmaps(docs, key, text, **options), key, text)
