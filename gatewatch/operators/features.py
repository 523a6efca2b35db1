"""Sliding-window behaviour indicators per client address.

Input: processed records with at least ``ip, request, user_agent, session_id,
dep_city, arr_city, ts (timestamp), critical (boolean)``.

Window ends are multiples of the slide (epoch aligned), as Spark's ``window``. A row
at time t belongs to the windows whose end lies in (t, t + dur]. The tumbling pane of
width ``slide`` that holds a row is the grain of all state: a window is ``k = dur/slide``
consecutive panes and is named by its last pane.

No row and no distinct value is expanded to the windows that contain it:

* counts are one aggregate per (pane, key), summed by a RANGE frame over the panes that
  exist for the key;
* a distinct value is +1 at the pane where it enters the window and -1 at the pane where
  it has left it again; the running sum of these changes is the distinct count;
* accesses are first counted per (key, second), as gaps are measured in whole seconds: a
  second with m accesses has m - 1 gaps of 0. Seconds are reduced to (first, last, least
  gap, fast gaps) inside (key, pane), so an address that sends half of all rows is a row
  per second before it is ordered, and a row per pane before its panes are.

State is evaluated at points (key, last pane): for scoring the panes in which the key has
a record, for the window tables every window that holds one of its records. The ``direct``
form of the indicators (``groupBy(window(...))``) is the reference the tests compare with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.config import WindowSpec

US_PER_S = 1_000_000


def duration_us_of(text: str) -> int:
    from gatewatch.config import duration_us
    return duration_us(text)


def trip_key(dep: Column, arr: Column) -> Column:
    """E7 key: the (departure, arrival) pair as one value."""
    return F.concat(F.coalesce(dep, F.lit("")), F.lit("\u0001"), F.coalesce(arr, F.lit("")))


def ip_block(ip: Column) -> Column:
    """``a.b`` of ``a.b.c.d``; an address without a dot (e.g. ``NULL``) stays whole."""
    return F.substring_index(ip, ".", 2)


def _floor_div(col: Column, d: int) -> Column:
    """Floor division of a long by a constant. The numerator is made an exact
    multiple of ``d`` first, so the quotient is exact (values stay below 2**53)."""
    return ((col - F.pmod(col, F.lit(d))) / F.lit(d)).cast("long")


def with_time(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Adds ``t_us`` (event time, micros), ``t_s`` (whole seconds, E9) and ``pane``. Times are
    compared in whole seconds, so the slide is one or more of them."""
    if w.slide_us % US_PER_S:
        raise ValueError("the slide must be whole seconds")
    t_us = F.unix_micros(F.col("ts"))
    return (df.filter(F.col("ts").isNotNull())
            .withColumn("t_us", t_us)
            .withColumn("t_s", _floor_div(F.col("t_us"), US_PER_S))
            .withColumn("pane", _floor_div(F.col("t_us"), w.slide_us)))


def pane_end(ts: Column, w: WindowSpec) -> Column:
    """End of the tumbling pane (width = slide) holding ``ts``: the window a record is
    scored against (the reference scores a record on the window ending with its batch)."""
    t_us = F.unix_micros(ts)
    return F.timestamp_micros((_floor_div(t_us, w.slide_us) + 1) * F.lit(w.slide_us))


_LEAD = "lead(IF({has}, pane, NULL)) IGNORE NULLS OVER (PARTITION BY {keys} ORDER BY pane)"


def _cover(rows: DataFrame, keys: list[str], w: WindowSpec, values: list[str], has: str = "true") -> DataFrame:
    """Rows (keys, pane, values) in the partitions of ``keys`` -> the same plus one row without
    values for every other window that holds a row (with ``has``), named by its last pane:
    those up to the key's next such row, so none twice and without an exchange. ``pt`` is
    true at the windows' rows."""
    nxt = F.expr(_LEAD.format(has=has, keys=", ".join(keys)))
    last = F.least(F.col("pane") + w.panes - 1, F.coalesce(F.col("__next") - 1, F.lit(2**62)))
    points = F.when(F.expr(has), F.sequence(F.col("pane"), last)).otherwise(F.array("pane"))
    rows = rows.withColumn("__next", nxt).withColumn("__at", F.explode(points))
    own = F.col("__at") == F.col("pane")
    return rows.select(*keys, F.col("__at").alias("pane"), *[F.when(own, F.col(c)).alias(c) for c in values],
                       F.expr(has).alias("pt"))


def _frame(keys: list[str], w: WindowSpec):
    """The panes of the window that ends with the row's pane."""
    return Window.partitionBy(*keys).orderBy("pane").rangeBetween(1 - w.panes, 0)


def _end_us(w: WindowSpec) -> Column:
    return ((F.col("pane") + 1) * F.lit(w.slide_us)).alias("we_us")


# ---------------------------------------------------------------- counts

def _counted(per_pane: DataFrame, keys: list[str], sums: list[str], w: WindowSpec, every: bool) -> DataFrame:
    """(keys, pane, sums) -> window sums at the points."""
    if every:
        per_pane = _cover(per_pane, keys, w, sums)
    f = _frame(keys, w)
    return per_pane.select(*keys, "pane", *[F.sum(c).over(f).alias(c) for c in sums])


# ---------------------------------------------------------------- distinct values

def _distinct_changes(values: DataFrame, w: WindowSpec) -> DataFrame:
    """Distinct (ip, kind, v, pane) -> (ip, pane, kind, d): +1 where a value enters the
    window, -1 where it has left it and did not come back before."""
    seen = Window.partitionBy("ip", "kind", "v").orderBy("pane")
    k = w.panes
    x = values.withColumn("prev", F.lag("pane").over(seen)).withColumn("next", F.lead("pane").over(seen))
    enter = F.col("prev").isNull() | (F.col("prev") <= F.col("pane") - k)
    leave = F.col("next").isNull() | (F.col("next") >= F.col("pane") + k)
    change = F.array_compact(F.array(
        F.when(enter, F.struct(F.col("pane").alias("pane"), F.lit(1).cast("long").alias("d"))),
        F.when(leave, F.struct((F.col("pane") + k).alias("pane"), F.lit(-1).cast("long").alias("d")))))
    return x.select("ip", "kind", F.explode(change).alias("c")).select("ip", "kind", "c.pane", "c.d")


# ---------------------------------------------------------------- gaps

def _before(keys: list[str], order: list[str], count: str) -> Column:
    """The second of the access before this row's, in the order given inside (keys, pane)."""
    o = Window.partitionBy(*keys, "pane").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.max(F.when(F.col(count) > 0, F.col("t_s"))).over(o)


def _gap_aggs(count: str, before: str, fast_ms: int, least: str, fast: str) -> list[Column]:
    """Least gap and fast gaps of seconds with ``count`` accesses (m of them: m - 1 gaps of 0)
    and the second before."""
    m, gap = F.col(count), (F.col("t_s") - F.col(before)) * 1000
    zeros = F.sum(F.when(m > 0, m - 1)) if fast_ms > 0 else F.lit(0)
    return [F.min(F.when(m > 1, F.lit(0)).when(m == 1, gap)).cast("long").alias(least),
            (F.coalesce(zeros, F.lit(0)) + F.count_if((m > 0) & (gap < fast_ms))).cast("long").alias(fast)]


def _ends(count: str) -> list[Column]:
    at = F.when(F.col(count) > 0, F.col("t_s"))
    return [F.min(at).alias("first_s"), F.max(at).alias("last_s")]


def _pane_gaps(crit: DataFrame, keys: list[str], fast_ms: int) -> DataFrame:
    """Accesses (keys, pane, t_s) -> (keys, pane): first and last second, least gap, fast gaps."""
    sec = crit.groupBy(*keys, "pane", "t_s").agg(F.count(F.lit(1)).alias("m"))
    sec = sec.withColumn("before", _before(keys, ["t_s"], "m"))
    return sec.groupBy(*keys, "pane").agg(*_ends("m"), *_gap_aggs("m", "before", fast_ms, "gmin", "gfast"))


_CROSS = ["cross", "prev_pane"]


def _with_cross(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the gap from the pane before with an access (``cross``, ``prev_pane``); rows
    without an access (``last_s`` null) are passed over."""
    over = f"IGNORE NULLS OVER (PARTITION BY {', '.join(keys)} ORDER BY pane)"
    return rows.withColumns({
        "cross": F.expr(f"(first_s - lag(last_s) {over}) * 1000"),
        "prev_pane": F.expr(f"IF(first_s IS NULL, NULL, lag(IF(last_s IS NULL, NULL, pane)) {over})")})


def _window_gaps(keys: list[str], w: WindowSpec, fast_ms: int):
    """Columns (least gap or NULL, fast gaps) of the window ending with the row's pane, for
    rows with ``gmin``, ``gfast`` and the gaps across panes. These count if both ends lie in the window."""
    f = _frame(keys, w)
    across = F.collect_list(F.when(F.col("cross").isNotNull(), F.struct("prev_pane", "cross"))).over(f)
    first = F.col("pane") - (w.panes - 1)
    held = F.transform(F.filter(across, lambda x: x["prev_pane"] >= first), lambda x: x["cross"])
    least = F.least(F.min("gmin").over(f), F.array_min(held))
    fast = F.coalesce(F.sum("gfast").over(f), F.lit(0)) + F.size(F.filter(held, lambda g: g < fast_ms))
    return least, fast.cast("long")


def gap_summary(df: DataFrame, keys: list[str], w: WindowSpec, fast_ms: int, every: bool = True) -> DataFrame:
    """Per (window end, keys): ``min_gap_ms`` (NULL under two accesses) and ``fast_count``
    (gaps strictly below ``fast_ms``) over accesses (keys, pane, t_s) truncated to seconds.
    ``every``: at every window that holds an access, else at those ending with a pane that has one."""
    g = _with_cross(_pane_gaps(df, keys, fast_ms), keys)
    if every:
        g = _cover(g, keys, w, ["gmin", "gfast", *_CROSS])
    least, fast = _window_gaps(keys, w, fast_ms)
    return g.select(*keys, "pane", least.alias("min_gap_ms"), fast.alias("fast_count")).select(
        _end_us(w), *keys, "min_gap_ms", "fast_count")


def gap_summary_direct(df: DataFrame, keys: list[str], w: WindowSpec, fast_ms: int) -> DataFrame:
    """Reference form of ``gap_summary``: expand rows into windows, ``lag`` over
    (window, keys) ordered by time, then ``min`` and ``count_if``."""
    x = (df.withColumn("win", F.window("ts", w.duration, w.slide))
         .withColumn("we_us", F.unix_micros(F.col("win.end"))))
    o = Window.partitionBy("we_us", *keys).orderBy("t_s")
    x = x.withColumn("gap", (F.col("t_s") - F.lag("t_s").over(o)) * 1000)
    return x.groupBy("we_us", *keys).agg(
        F.min("gap").alias("min_gap_ms"),
        F.count_if(F.col("gap") < fast_ms).cast("long").alias("fast_count"))


# ---------------------------------------------------------------- indicators

_KINDS = "stack(3, 'u', user_agent, 't', trip, 's', IF(critical, session_id, NULL)) AS (kind, v)"


def _prepared(records: DataFrame, w: WindowSpec) -> DataFrame:
    return with_time(records.select(
        "ip", "request", "user_agent", "session_id", "ts",
        F.coalesce(F.col("critical"), F.lit(False)).alias("critical"),
        trip_key(F.col("dep_city"), F.col("arr_city")).alias("trip")), w)


_DISTINCT = {"ua": "u", "trip": "t", "session": "s"}


def _value_changes(b: DataFrame, w: WindowSpec) -> DataFrame:
    """(ip, pane, ua, trip, session): changes of the distinct counts."""
    values = b.select("pane", "ip", F.expr(_KINDS)).filter(F.col("v").isNotNull()).distinct()
    return _distinct_changes(values, w).select(
        "ip", "pane", *[F.when(F.col("kind") == k, F.col("d")).alias(x) for x, k in _DISTINCT.items()])


def _seconds(b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and critical rows per (keys, pane, second), added up before the exchange."""
    return b.groupBy(*keys, "pane", "t_s").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("critical").cast("long")).alias("c"))


def _upto(c: str) -> Column:
    o = Window.partitionBy("ip").orderBy("pane").rangeBetween(Window.unboundedPreceding, 0)
    return F.coalesce(F.sum(c).over(o), F.lit(0)).alias(f"{c}_distinct")


def _per_ip(b: DataFrame, w: WindowSpec) -> DataFrame:
    """E2-E5, E7, E8 at every window (we_us, ip) that holds a record: counts, gaps and distinct
    changes meet in the partitions of the address, which every later step keeps."""
    sec = _seconds(b, ["ip"]).withColumn("before", _before(["ip"], ["t_s"], "c"))
    panes = sec.groupBy("ip", "pane").agg(F.sum("n").alias("n"), F.sum("c").alias("c"), *_ends("c"),
                                          *_gap_aggs("c", "before", w.fast_repeat_ms, "gmin", "gfast"))
    rows = panes.unionByName(_value_changes(b, w), allowMissingColumns=True).repartition("ip")
    values = ["n", "c", *_DISTINCT, "gmin", "gfast", *_CROSS]
    rows = _cover(_with_cross(rows, ["ip"]), ["ip"], w, values, "n IS NOT NULL")
    f = _frame(["ip"], w)
    least, _ = _window_gaps(["ip"], w, w.fast_repeat_ms)
    out = rows.select(
        "ip", "pane", "pt", F.sum("n").over(f).alias("ip_count"), F.sum("c").over(f).alias("critical_count"),
        least.alias("min_gap_ms"), *[_upto(x) for x in _DISTINCT])
    return out.filter("pt").drop("pt").withColumn("we_us", _end_us(w))


def ip_features(records: DataFrame, w: WindowSpec, form: str = "pane") -> DataFrame:
    """E2, E3, E4, E5, E7, E8 at (window_end, ip) in one pass, for every window that
    holds a record of the address.

    Columns: window_end, ip, ip_count (E2), critical_count (E3), ua_distinct (E4),
    min_interval_ms (E5, NULL under two critical accesses), trip_distinct (E7),
    session_distinct (E8, critical rows only)."""
    b = _prepared(records, w)
    if form == "direct":
        win = F.window("ts", w.duration, w.slide)
        main = b.groupBy(F.unix_micros(win.end).alias("we_us"), "ip").agg(
            F.count(F.lit(1)).alias("ip_count"),
            F.sum(F.col("critical").cast("long")).alias("critical_count"),
            F.count_distinct("user_agent").alias("ua_distinct"),
            F.count_distinct("trip").alias("trip_distinct"),
            F.count_distinct(F.when(F.col("critical"), F.col("session_id"))).alias("session_distinct"))
        gaps = gap_summary_direct(b.filter("critical"), ["ip"], w, w.fast_repeat_ms)
        out = main.join(gaps.select("we_us", "ip", "min_gap_ms"), ["we_us", "ip"], "left")
    else:
        out = _per_ip(b, w)
    return out.select(
        F.timestamp_micros("we_us").alias("window_end"), "ip",
        F.col("ip_count").cast("long").alias("ip_count"),
        F.col("critical_count").cast("long").alias("critical_count"),
        F.coalesce(F.col("ua_distinct"), F.lit(0)).cast("long").alias("ua_distinct"),
        F.col("min_gap_ms").cast("long").alias("min_interval_ms"),
        F.coalesce(F.col("trip_distinct"), F.lit(0)).cast("long").alias("trip_distinct"),
        F.coalesce(F.col("session_distinct"), F.lit(0)).cast("long").alias("session_distinct"))


def min_intervals(records: DataFrame, w: WindowSpec) -> DataFrame:
    """E5: shortest interval between critical accesses per (window, ip) with two or more."""
    b = with_time(records.filter(F.col("critical")).select("ip", "ts"), w)
    g = gap_summary(b, ["ip"], w, w.fast_repeat_ms).filter(F.col("min_gap_ms").isNotNull())
    return g.select(F.timestamp_micros("we_us").alias("window_end"), "ip",
                    F.col("min_gap_ms").cast("long").alias("min_interval_ms"))


def _windowed_count(records: DataFrame, key: str, out: str, w: WindowSpec, form: str) -> DataFrame:
    if form == "direct":
        g = records.groupBy(F.unix_micros(F.window("ts", w.duration, w.slide).end).alias("we_us"), key).agg(
            F.count(F.lit(1)).alias(out))
    else:
        per_pane = records.groupBy("pane", key).agg(F.count(F.lit(1)).alias(out))
        g = _counted(per_pane, [key], [out], w, every=True).withColumn("we_us", _end_us(w))
    return g.select(F.timestamp_micros("we_us").alias("window_end"), key, F.col(out).cast("long").alias(out))


def block_counts(records: DataFrame, w: WindowSpec, form: str = "pane") -> DataFrame:
    """Requests per address block (``a.b``) per window."""
    b = with_time(records.select(ip_block(F.col("ip")).alias("ip_block"), "ts"), w)
    return _windowed_count(b, "ip_block", "block_count", w, form)


def ip_counts(records: DataFrame, w: WindowSpec, form: str = "pane") -> DataFrame:
    """Requests per address per window."""
    return _windowed_count(with_time(records.select("ip", "ts"), w), "ip", "ip_count", w, form)


def fast_repeats(records: DataFrame, w: WindowSpec, form: str = "pane") -> DataFrame:
    """Per (window, ip, request), critical accesses closer than the limit."""
    b = with_time(records.filter(F.col("critical")).select("ip", "request", "ts"), w)
    f = gap_summary_direct if form == "direct" else gap_summary
    g = f(b, ["ip", "request"], w, w.fast_repeat_ms)
    return g.select(F.timestamp_micros("we_us").alias("window_end"), "ip", "request",
                    F.col("fast_count").cast("long").alias("fast_repeats"))


def request_gaps(records: DataFrame, keys=("ip",), bucket: str = "1 minute") -> DataFrame:
    """Gap in ms to the previous access of the same key (whole seconds, E9), over the
    whole history, one row per access.

    Rows are counted per (key, second) first; seconds are ordered inside (key, bucket)
    and buckets by their last second, so no ordering grows with an address's traffic.
    Of the accesses of one second the earliest has the gap to the second before, the
    others have 0."""
    from gatewatch.config import duration_us
    bu_s = max(1, duration_us(bucket) // US_PER_S)
    keys = list(keys)
    b = (records.select(*keys, "ts").filter(F.col("ts").isNotNull())
         .withColumn("t_us", F.unix_micros("ts")).withColumn("t_s", _floor_div(F.unix_micros("ts"), US_PER_S)))
    # equal micros of one second are interchangeable, so they stay counted
    us = b.groupBy(*keys, "t_s", "t_us", "ts").agg(F.count(F.lit(1)).alias("m"))
    sec = us.groupBy(*keys, "t_s").agg(F.min("t_us").alias("first_us"))
    sec = sec.withColumn("bk", _floor_div(F.col("t_s"), bu_s))
    inside = Window.partitionBy(*keys, "bk").orderBy("t_s")
    across = Window.partitionBy(*keys).orderBy("bk")
    last = sec.groupBy(*keys, "bk").agg(F.max("t_s").alias("bl")).withColumn("before", F.lag("bl").over(across))
    sec = sec.withColumn("prev", F.lag("t_s").over(inside)).join(last.select(*keys, "bk", "before"), [*keys, "bk"])
    sec = sec.select(*keys, "t_s", "first_us", ((F.col("t_s") - F.coalesce("prev", "before")) * 1000).alias("gap"))
    rows = us.join(sec, [*keys, "t_s"])
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    first = (F.col("t_us") == F.col("first_us")) & (F.col("i") == 1)
    return rows.select(*keys, "ts", F.when(first, F.col("gap")).otherwise(F.lit(0)).cast("long").alias("gap_ms"))


def window_features(records: DataFrame, w: WindowSpec) -> DataFrame:
    """All eight indicators for every (window_end, ip, request) a record is scored on: the
    window that ends with the record's own pane.

    Records are counted per (ip, request, second) first. These rows meet by (ip, pane) for the gaps
    inside a pane, of the address and of the request, and as one row per (ip, request, pane)
    by address, together with the changes of the distinct counts, for everything that goes
    over panes. Block counts are a small table of their own."""
    b = _prepared(records, w)
    keys = ["ip", "request"]
    sec = _seconds(b, keys).repartition("ip", "pane")
    # rows of one second and several requests are gaps of 0 of the address
    sec = sec.withColumns({"before_ip": _before(["ip"], ["t_s", "request"], "c"), "before": _before(keys, ["t_s"], "c")})
    panes = sec.groupBy(*keys, "pane").agg(
        F.sum("n").alias("n"), F.sum("c").alias("c"), *_ends("c"), *_gap_aggs("c", "before", w.fast_repeat_ms, "gmin_r", "gfast_r"),
        *_gap_aggs("c", "before_ip", w.fast_repeat_ms, "gmin_i", "gfast_i"))
    rows = panes.unionByName(_value_changes(b, w), allowMissingColumns=True).repartition("ip")

    # the address: one of a pane's rows stands for the pane
    ip = Window.partitionBy("ip").orderBy("pane")
    here, earlier, f = ip.rangeBetween(0, 0), ip.rangeBetween(Window.unboundedPreceding, -1), _frame(["ip"], w)
    has = F.when(F.col("last_s").isNotNull(), F.col("pane"))
    one = F.struct("request", "n")
    rows = rows.select(
        "*", F.min("first_s").over(here).alias("first_ip"), F.max("last_s").over(earlier).alias("last_ip"),
        F.max(has).over(earlier).alias("prev_pane"), (F.min(F.when(F.col("n").isNotNull(), one)).over(here) == one).alias("stands"))
    rows = rows.withColumns({
        "cross": F.when(F.col("stands"), (F.col("first_ip") - F.col("last_ip")) * 1000), "gmin": F.col("gmin_i"), "gfast": F.col("gfast_i")})
    least, _ = _window_gaps(["ip"], w, w.fast_repeat_ms)
    rows = rows.select(
        *keys, "pane", "n", "first_s", "last_s", F.col("gmin_r").alias("gmin"), F.col("gfast_r").alias("gfast"),
        F.sum("n").over(f).alias("ip_count"), F.sum("c").over(f).alias("critical_count"), least.alias("min_interval_ms"),
        *[_upto(x) for x in _DISTINCT]).filter("n IS NOT NULL")

    # the request, in the same partitions
    _, fast = _window_gaps(keys, w, w.fast_repeat_ms)
    rows = _with_cross(rows, keys).withColumn("fast_repeats", F.when(F.col("last_s").isNotNull(), fast))

    blocks = b.groupBy(ip_block(F.col("ip")).alias("ip_block"), "pane").agg(F.count(F.lit(1)).alias("block_count"))
    blocks = _counted(blocks, ["ip_block"], ["block_count"], w, every=False)
    out = rows.withColumn("ip_block", ip_block(F.col("ip"))).join(blocks, ["ip_block", "pane"], "left")
    names = ("block_count", "ip_count", "critical_count", "ua_distinct", "min_interval_ms", "trip_distinct", "session_distinct", "fast_repeats")
    return out.select(F.timestamp_micros(_end_us(w)).alias("window_end"), *keys,
                      *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names])
