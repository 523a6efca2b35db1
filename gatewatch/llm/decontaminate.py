"""Benchmark decontamination by a prefix-filtered containment join.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. A window is
10 consecutive words of an item (a shorter item, if it has words, is one window). A document
contains a window only if it contains every shingle of it (5 words, or the whole window if
shorter), so it is enough to join on one: shingles are ordered by how often they occur in all
documents, and the window's rarest is its necessary prefix (all must overlap, so the prefix
has length one). A match at word p fixes where the window would start (positional bound) and
end (length bound: inside the document), and the words in between are compared exactly.

Two narrow passes over the texts (shingle counts, then the join) and one shuffle of hits. The
benchmark side is broadcast after a count; beyond that positions and shingles are shuffled to it,
without the words, and the candidates are compared back at their documents. Null and empty
texts have no words. Items with a null id hit words but have no id to report; items that
repeat an id count once. Rows equal in id and text are resolved once and returned as often as
they occur. An empty benchmark contaminates nothing."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import broadcast_if_small, materialize, row_key

WINDOW = 10
SHINGLE = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(df: DataFrame, text: str = "text", out: str = "__w") -> DataFrame:
    """Adds the array of words."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    df = df.withColumn(out, F.split(low, SEPARATORS))
    head, tail = (F.get(out, F.lit(0)) == "").cast("int"), (F.element_at(out, -1) == "").cast("int")
    return df.withColumn(out, F.slice(out, head + 1, F.greatest(F.size(out) - head - tail, F.lit(0))))


def _shingle(words: str, at: Column, k: int) -> Column:
    """Hash of k words from position ``at``, null where the array ends before."""
    parts = [F.get(words, at + i) for i in range(k)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(k), *parts))


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows (ww, the words) of the items with the item ids that have them."""
    n = F.size("__w")
    return (with_words(items).where(n > 0)
            .select(F.col("item_id").cast("string").alias("item"), "__w", F.least(n, F.lit(window)).alias("len"))
            .select("item", "__w", "len", F.explode(F.sequence(F.lit(0), F.size("__w") - F.col("len"))).alias("at"))
            .groupBy(F.slice("__w", F.col("at") + 1, F.col("len")).alias("ww"))
            .agg(F.collect_set("item").alias("items")))


def _window_shingles(win: DataFrame, k: int) -> DataFrame:
    per_length = F.coalesce(*[F.when(F.least(F.size("ww"), F.lit(k)) == j, _shingle("ww", F.col("off"), j)) for j in range(1, k + 1)])
    return (win.withColumn("off", F.explode(F.sequence(F.lit(0), F.size("ww") - F.least(F.size("ww"), F.lit(k)))))
            .withColumn("shingle", per_length))


def _document_shingles(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """Rows (.., pos, shingle) of all documents; pos -1 with a null shingle once per row."""
    at = F.explode(F.sequence(F.lit(-1), F.size("__w") - 1)).alias("pos")
    rows = docs.select("*", at)
    one = [F.when(F.col("pos") >= 0, _shingle("__w", F.col("pos"), j)) for j in lengths]
    if len(one) == 1:
        return rows.withColumn("shingle", one[0])
    # short items: shingles of their own lengths as well; the marker row stays single
    both = F.when(F.col("pos") >= 0, F.array(*one)).otherwise(F.array(F.lit(None).cast("long")))
    return rows.withColumn("shingle", F.explode(both))


def _by_broadcast(base: DataFrame, prefix: DataFrame, lengths: list[int]) -> DataFrame:
    """Documents' shingles meet the broadcast prefixes where they are; one shuffle of hits."""
    rows = _document_shingles(base.select("doc_id", "__k1", "__k2", "__w"), lengths)
    start, length = F.col("pos") - F.col("off"), F.size("ww")
    inside = (start >= 0) & (start + length <= F.size("__w"))
    exact = F.slice("__w", F.greatest(start, F.lit(0)) + 1, length) == F.col("ww")
    hit = rows.join(F.broadcast(prefix), (rows.shingle == prefix.shingle) & inside & exact, "left").where("pos = -1 or off is not null")
    spans = F.when(F.col("pos") >= 0, F.struct(start.alias("s"), (start + length).alias("e")))
    found = hit.groupBy("doc_id", "__k1", "__k2", F.size("__w").alias("n_words")).agg(
        F.count_if(F.col("pos") == -1).alias("rows"), F.array_sort(F.collect_set(spans)).alias("spans"),
        F.flatten(F.collect_set("items")).alias("items"))
    return found.withColumn("__one", F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int")))).drop("__one", "rows")


def _by_shuffle(base: DataFrame, prefix: DataFrame, lengths: list[int]) -> DataFrame:
    """Prefixes too many to broadcast: positions and shingles alone are shuffled to them, the
    candidates go back to their documents, and the words are compared there."""
    rows = _document_shingles(base.select("__k1", "__k2", "__w"), lengths)
    rows = rows.where(F.col("shingle").isNotNull()).select("__k1", "__k2", "pos", F.size("__w").alias("n_words"), "shingle")
    start = F.col("pos") - F.col("off")
    near = rows.join(prefix, "shingle").where((start >= 0) & (start + F.size("ww") <= F.col("n_words")))
    near = near.groupBy("__k1", "__k2").agg(F.collect_set(F.struct(start.alias("s"), "ww", "items")).alias("near"))
    docs = with_words(base.select("doc_id", "__k1", "__k2", "text").join(near, ["__k1", "__k2"], "left"))
    hits = F.filter(F.coalesce("near", F.array()), lambda x: F.slice("__w", x["s"] + 1, F.size(x["ww"])) == x["ww"])
    docs = docs.withColumn("hits", hits)
    spans = F.array_sort(F.array_distinct(F.transform("hits", lambda x: F.struct(x["s"].alias("s"), (x["s"] + F.size(x["ww"])).alias("e")))))
    return docs.select("doc_id", "__k1", "__k2", F.size("__w").alias("n_words"), spans.alias("spans"),
                       F.flatten(F.transform("hits", lambda x: x["items"])).alias("items"))


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = SHINGLE, broadcast_rows: int = 200_000) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; others are not looked at): doc_id, n_words, n_hit
    (words inside occurrences of windows), items (sorted ids with occurring windows) and
    the row key. Up to ``broadcast_rows`` counted windows are broadcast."""
    win = materialize(_window_shingles(windows(items, window), k), "bench_windows")
    # at most k values
    lengths = sorted(r[0] for r in win.select(F.least(F.size("ww"), F.lit(k))).distinct().collect()) or [k]
    base = with_words(docs.select("doc_id", "text", *row_key(F.col("doc_id"), F.col("text"))))
    counts = (_document_shingles(base.select("__w"), lengths).select("shingle")
              .join(broadcast_if_small(win.select("shingle").distinct()), "shingle")
              .groupBy("shingle").count())
    rare = (win.join(counts, "shingle", "left").groupBy("ww", "items")
            .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "shingle", "off")).alias("r"))
            .where("r.n > 0")
            .select("ww", "items", F.col("r.shingle").alias("shingle"), F.col("r.off").alias("off")))
    prefix = materialize(rare, "bench_prefix")
    few = prefix.limit(broadcast_rows + 1).count() <= broadcast_rows
    found = (_by_broadcast if few else _by_shuffle)(base, prefix, lengths)
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["to"]))).alias("n"), F.greatest(a["to"], x["e"]).alias("to")))["n"]
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"), "__k1", "__k2")


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that contain a window of the benchmark."""
    bad = contaminated(docs, items, **options).where("n_hit > 0").select("__k1", "__k2").distinct()
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    return docs.select("*", k1, k2).join(bad, ["__k1", "__k2"], "left_anti").select(docs.columns)
