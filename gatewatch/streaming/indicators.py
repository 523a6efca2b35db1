"""All eight indicators as pure Structured Streaming queries.

Each indicator is a chain of windowed aggregates in append mode, every one over the
``window_time`` of the one before:

* seconds: rows of a key are counted per second (m accesses of a second are m - 1 gaps of 0),
  with the sets of distinct values seen in it;
* panes (tumbling, width = slide): the ordered seconds become (first, last, least gap, fast
  gaps), counts are added, sets united;
* windows (dur / slide): the panes of a window in order; gaps between panes are added.

State follows distinct seconds, panes and values of a key and not its rows, so an address
that sends half of all rows of a second is one row of state. Rows behind the watermark are
dropped by the first aggregate of every chain alike.

``attach_features_stream`` joins the keys to score with these streams: symmetric state on
both sides, matched by (window end, key) and cleared as the watermark passes; a key without
a value gets 0 when the watermark has passed its window, as in the batch form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.config import Tables, WindowSpec
from gatewatch.operators import features as fe
from gatewatch.operators import scoring as S
from gatewatch.sources import rules as R


def _second(records: DataFrame, watermark: str, keys: list[str], *aggs: Column) -> DataFrame:
    return records.withWatermark("ts", watermark).groupBy(F.window("ts", "1 second").alias("sec"), *keys).agg(*aggs)


def _pane(seconds: DataFrame, w: WindowSpec, keys: list[str], *aggs: Column) -> DataFrame:
    return seconds.groupBy(F.window(F.window_time("sec"), w.slide).alias("pane"), *keys).agg(*aggs)


def _window(panes: DataFrame, w: WindowSpec, keys: list[str], *aggs: Column) -> DataFrame:
    return panes.groupBy(F.window(F.window_time("pane"), w.duration, w.slide).alias("win"), *keys).agg(*aggs)


def _steps(ordered: Column, earlier: str, later: str) -> Column:
    """Gaps in ms between neighbours of an ordered array of structs."""
    return F.transform(F.sequence(F.lit(1), F.size(ordered) - 1),
                       lambda i: (F.get(ordered, i)[later] - F.get(ordered, i - 1)[earlier]) * 1000)


def _gap_state(secs: Column, fast_ms: int) -> Column:
    """Ordered (t, m) seconds of a pane -> (first, last, gmin, gfast), null without a second."""
    steps = F.when(F.size(secs) > 1, _steps(secs, "t", "t")).otherwise(F.array().cast("array<long>"))
    same = F.aggregate(secs, F.lit(0).cast("long"), lambda a, x: a + x["m"] - 1)
    least = F.when(same > 0, F.lit(0).cast("long")).otherwise(F.array_min(steps))
    fast = (same if fast_ms > 0 else F.lit(0)) + F.size(F.filter(steps, lambda g: g < fast_ms))
    return F.when(F.size(secs) > 0, F.struct(
        F.get(secs, F.lit(0))["t"].alias("first"), F.element_at(secs, -1)["t"].alias("last"), least.alias("gmin"), fast.cast("long").alias("gfast")))


def _window_gaps(states: Column, fast_ms: int) -> tuple[Column, Column]:
    """Ordered pane states of a window -> (least gap or null, fast gaps)."""
    cross = F.when(F.size(states) > 1, _steps(states, "last", "first")).otherwise(F.array().cast("array<long>"))
    least = F.least(F.array_min(F.transform(states, lambda x: x["gmin"])), F.array_min(cross))
    fast = F.aggregate(states, F.lit(0).cast("long"), lambda a, x: a + x["gfast"]) + F.size(F.filter(cross, lambda g: g < fast_ms))
    return least, fast.cast("long")


def _seconds_list(count: str) -> Column:
    t = F.unix_seconds("sec.start").alias("t")
    return F.collect_list(F.when(F.col(count) > 0, F.struct(t, F.col(count).alias("m"))))


_SETS = ("uas", "trips", "sessions")


def ip_features_stream(records: DataFrame, w: WindowSpec, watermark: str) -> DataFrame:
    """E2-E5, E7, E8 per (window, ip), as ``operators.features.ip_features``; ``wt`` is the
    window's event time for a further stateful step."""
    r = records.withColumn("critical", F.coalesce("critical", F.lit(False)))
    trip, session = fe.trip_key(F.col("dep_city"), F.col("arr_city")), F.when(F.col("critical"), F.col("session_id"))
    per_second = _second(r, watermark, ["ip"], F.count(F.lit(1)).alias("n"), F.sum(F.col("critical").cast("long")).alias("c"),
                         *[F.collect_set(v).alias(s) for s, v in zip(_SETS, (F.col("user_agent"), trip, session), strict=True)])
    per_pane = _pane(per_second, w, ["ip"], F.sum("n").alias("n"), F.sum("c").alias("c"), F.array_sort(_seconds_list("c")).alias("secs"),
                     *[F.array_distinct(F.flatten(F.collect_list(s))).alias(s) for s in _SETS])
    per_pane = per_pane.withColumn("gaps", _gap_state(F.col("secs"), w.fast_repeat_ms))
    per_window = _window(per_pane, w, ["ip"], F.sum("n").alias("ip_count"), F.sum("c").alias("critical_count"),
                         F.array_sort(F.collect_list("gaps")).alias("gaps"),
                         *[F.size(F.array_distinct(F.flatten(F.collect_list(s)))).cast("long").alias(s) for s in _SETS])
    least, _ = _window_gaps(F.col("gaps"), w.fast_repeat_ms)
    return per_window.select(
        F.window_time("win").alias("wt"), F.col("win.end").alias("window_end"), "ip", "ip_count", "critical_count", F.col("uas").alias("ua_distinct"),
        least.alias("min_interval_ms"), F.col("trips").alias("trip_distinct"), F.col("sessions").alias("session_distinct"))


def fast_repeats_stream(records: DataFrame, w: WindowSpec, watermark: str) -> DataFrame:
    """E6 per (window, ip, request), as ``operators.features.fast_repeats``."""
    keys = ["ip", "request"]
    # the watermark is set before the filter, so that every chain drops the same late rows
    r = records.withWatermark("ts", watermark).filter(F.col("critical"))
    per_second = r.groupBy(F.window("ts", "1 second").alias("sec"), *keys).agg(F.count(F.lit(1)).alias("m"))
    per_pane = _pane(per_second, w, keys, F.array_sort(_seconds_list("m")).alias("secs"))
    per_pane = per_pane.withColumn("gaps", _gap_state(F.col("secs"), w.fast_repeat_ms))
    per_window = _window(per_pane, w, keys, F.array_sort(F.collect_list("gaps")).alias("gaps"))
    _, fast = _window_gaps(F.col("gaps"), w.fast_repeat_ms)
    return per_window.select(F.window_time("win").alias("wt"), F.col("win.end").alias("window_end"), *keys, fast.alias("fast_repeats"))


def block_counts_stream(records: DataFrame, w: WindowSpec, watermark: str) -> DataFrame:
    """E1 per (window, address block), as ``operators.features.block_counts``."""
    r = records.withColumn("ip_block", fe.ip_block(F.col("ip"))).withWatermark("ts", watermark)
    per_pane = r.groupBy(F.window("ts", w.slide).alias("pane"), "ip_block").agg(F.count(F.lit(1)).alias("n"))
    per_window = _window(per_pane, w, ["ip_block"], F.sum("n").alias("block_count"))
    return per_window.select(F.window_time("win").alias("wt"), F.col("win.end").alias("window_end"), "ip_block", "block_count")


def score_keys_stream(records: DataFrame, w: WindowSpec, watermark: str) -> DataFrame:
    """(window_end, ip, request) to score: the window that ends with a record's own pane."""
    per_pane = records.withWatermark("ts", watermark).groupBy(F.window("ts", w.slide).alias("pane"), "ip", "request").agg(F.count(F.lit(1)).alias("n"))
    return per_pane.select(F.window_time("pane").alias("wt"), F.col("pane.end").alias("window_end"), "ip", "request")


def _left(keys: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Left outer stream-stream join by (event time of the window, key)."""
    side = side.drop("window_end").withColumnsRenamed({c: f"__{c}" for c in ("wt", *on)})
    same = F.col("wt") == F.col("__wt")
    for c in on:
        same = same & (F.col(c) == F.col(f"__{c}"))
    return keys.join(side, same, "left_outer").drop("__wt", *[f"__{c}" for c in on])


def attach_features_stream(records: DataFrame, w: WindowSpec, watermark: str) -> DataFrame:
    """F1: every key to score with its eight indicators, 0 where there is none, emitted once
    when the watermark has passed its window."""
    keys = score_keys_stream(records, w, watermark).withColumn("ip_block", fe.ip_block(F.col("ip")))
    out = _left(keys, ip_features_stream(records, w, watermark), ["ip"])
    out = _left(out, block_counts_stream(records, w, watermark), ["ip_block"])
    out = _left(out, fast_repeats_stream(records, w, watermark), ["ip", "request"])
    return out.select("window_end", "ip", "request", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in S.FEATURE_COLUMNS])


def scored_stream(records: DataFrame, tables: Tables, w: WindowSpec, watermark: str) -> DataFrame:
    """G1-G4 on the stream: one row per (window_end, ip, request, flow)."""
    return S.flow_scores(attach_features_stream(records, w, watermark), R.flow_config(tables))
