"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are words ``[^\\x20\\x09-\\x0D]+``. Sources in code-point order (null last) have
weights 5, 2, 1, repeating, and share all words by weight; a target stops at three
times its source's size and the excess goes to the others by weight (solved in closed
form: caps bind in order of size / weight). A source first gives whole epochs (every
document once per epoch); the rest of its target is drawn without replacement by the
exponential keys ``-ln(u) / quality``, u from a hash of the document, so reruns agree.

No source is sorted in one task: keys are cut into even slices per source (``BUCKETS``, more
above ``SLICE_ROWS`` rows each), slice totals are prefix-summed (a bounded table), and rows are ordered inside their slice
only. The document at the border is taken when that brings the source nearer to its
target. Rows equal in id, source and text are taken together. Null text has size 0; a
source of size 0 has target 0; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.llm.common import broadcast_if_small, materialize, row_key

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKETS = 1024
SLICE_ROWS = 100_000
SEED = "mix-1"
#: Quality weight of a document by its label; unlabelled ones are in between.
QUALITY = {1: 1.0, 0: 0.25, None: 0.6}


def targets(by_source: DataFrame) -> DataFrame:
    """(source, source_size) -> the same with ``target``. One row per source: a mixture's
    catalogue of sources is ordered as a whole."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    t = by_source.withColumn("w", w).withColumn("r", MAX_EPOCHS * F.col("source_size") / F.col("w"))
    before = Window.orderBy("r", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = (t.withColumn("left", F.sum("source_size").over(whole) - MAX_EPOCHS * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
         .withColumn("rest_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
         .withColumn("rate", F.col("left") / F.col("rest_w")))
    t = t.withColumn("rate", F.min(F.when(F.col("rate") <= F.col("r"), F.struct("r", "rate"))).over(whole)["rate"])
    return t.select("source", "source_size", F.least(MAX_EPOCHS * F.col("source_size").cast("double"), F.col("rate") * F.col("w")).alias("target"))


def units(docs: DataFrame, quality: DataFrame | None) -> DataFrame:
    """One row per document row: key, source, size, sampling key. Written once, so the
    texts are read once."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), *row_key(F.col("doc_id"), F.col("source"), F.col("text")))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|" + SEED)))
    rows = rows.withColumn("u", (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48))
    if quality is not None:
        q = quality.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("__q"))
        rows = rows.join(q, "doc_id", "left")
    else:
        rows = rows.withColumn("__q", F.lit(None).cast("int"))
    weight = F.when(F.col("__q") == 1, QUALITY[1]).when(F.col("__q") == 0, QUALITY[0]).otherwise(QUALITY[None])
    return rows.withColumn("w", F.lit(1.0) * weight).withColumn("key", -F.log("u") / F.col("w")).drop("u", "__q")


def sliced(rows: DataFrame, least: int = BUCKETS) -> DataFrame:
    """Adds ``slice``: the key's place in the distribution of the source's keys, which is that
    of its quality classes mixed by their shares. It rises with the key, and slices are even
    whatever the weights; their number follows the source's rows."""
    classes = sorted(set(QUALITY.values()))
    share = rows.groupBy("__src").agg(F.count(F.lit(1)).alias("__n"), *[F.avg((F.col("w") == c).cast("double")).alias(f"__share{i}") for i, c in enumerate(classes)])
    rows = rows.join(broadcast_if_small(share), "__src")
    below = sum(F.col(f"__share{i}") * (1 - F.exp(-c * F.col("key"))) for i, c in enumerate(classes))
    number = F.greatest(F.lit(least), F.ceil(F.col("__n") / SLICE_ROWS))
    return rows.withColumn("slice", F.floor(below * number).cast("int")).drop("w", "__n", *[f"__share{i}" for i in range(len(classes))])


def mix(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source; others are not looked at): doc_id, source,
    size, source_size, target, copies (how often the mix takes it), taken = copies * size
    and the row key. ``quality``: (doc_id, quality 0/1), for the sampling weights."""
    rows = materialize(units(docs, quality), "mix_units")
    src = F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s"))
    rows = sliced(rows.withColumn("__src", src))
    per = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    per = (per.withColumn("__src", src).drop("source")
           .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
           .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    per = materialize(per, "mix_targets")
    tot = rows.groupBy("__src", "slice").agg(F.sum("size").alias("s"))
    cum = tot.withColumn("offset", F.sum("s").over(Window.partitionBy("__src").orderBy("slice")) - F.col("s")).drop("s")
    slices = broadcast_if_small(cum.join(broadcast_if_small(per), "__src"))
    inside = Window.partitionBy("__src", "slice")
    order = inside.orderBy("key", "doc_id", "__k1", "__k2")
    same = inside.partitionBy("__src", "slice", "key", "doc_id", "__k1", "__k2")
    rows = rows.join(slices, ["__src", "slice"])
    # rows of one unit sort together; the range frame ends after the unit's last row
    end = F.col("offset") + F.sum("size").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("__end", end).withColumn("__unit", F.sum("size").over(same))
    chosen = (F.col("__unit") > 0) & (F.col("__end") - F.col("__unit") / 2 <= F.col("rest"))
    copies = (F.col("epochs") + F.when(chosen & (F.col("epochs") < MAX_EPOCHS), 1).otherwise(0)).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "__k1", "__k2")


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """``docs``, every row as often as the mix takes it."""
    plan = mix(docs, quality).groupBy("__k1", "__k2").agg(F.max("copies").alias("__copies")).where("__copies > 0")
    k1, k2 = row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    out = docs.select("*", k1, k2).join(plan, ["__k1", "__k2"])
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(docs.columns)
