"""Distinct counts of any window from one stored table of sketches.

The table has a row per (pane, address) with an HLL sketch of each kind of value. Sketches of
panes unite to the sketch of a window without the rows, so one table, written once, serves
every window whose duration and slide are multiples of the pane. A sketch of 2 ** lg_k
registers has a relative standard error of about 1.04 / sqrt(2 ** lg_k), 1.6 % for 12; small
sets are counted exactly. Null values are not counted, and an address without values of a
kind has 0 of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.config import WindowSpec, duration_us
from gatewatch.operators import features as fe

KINDS = {"ua": "ua_distinct", "trip": "trip_distinct", "session": "session_distinct"}
LG_K = 12


def sketch_table(records: DataFrame, pane: str, lg_k: int = LG_K) -> DataFrame:
    """(pane_us, ip, ua, trip, session): sketches of the values in each tumbling pane."""
    us = duration_us(pane)
    t = F.unix_micros("ts")
    session = F.when(F.coalesce(F.col("critical"), F.lit(False)), F.col("session_id"))
    values = {"ua": F.col("user_agent"), "trip": fe.trip_key(F.col("dep_city"), F.col("arr_city")), "session": session}
    return (records.filter(F.col("ts").isNotNull()).groupBy((t - F.pmod(t, F.lit(us))).alias("pane_us"), "ip")
            .agg(*[F.hll_sketch_agg(v, F.lit(lg_k)).alias(k) for k, v in values.items()]))


def _estimate(sketch: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("long")


def window_distincts(table: DataFrame, w: WindowSpec, pane: str) -> DataFrame:
    """E4, E7, E8 of every window that holds a record, from the stored sketches. Panes are
    united to the slide first, so each sketch is handed to dur / slide windows only."""
    us = duration_us(pane)
    if w.slide_us % us or w.dur_us % w.slide_us:
        raise ValueError("slide and duration must be multiples of the pane")
    unite = [F.hll_union_agg(k).alias(k) for k in KINDS]
    start = F.col("pane_us") - F.pmod(F.col("pane_us"), F.lit(w.slide_us))
    slides = table.groupBy(start.alias("slide_us"), "ip").agg(*unite)
    ends = F.sequence(F.col("slide_us") + w.slide_us, F.col("slide_us") + w.dur_us, F.lit(w.slide_us))
    windows = slides.withColumn("we_us", F.explode(ends)).groupBy("we_us", "ip").agg(*unite)
    return windows.select(F.timestamp_micros("we_us").alias("window_end"), "ip", *[_estimate(F.col(k)).alias(c) for k, c in KINDS.items()])
