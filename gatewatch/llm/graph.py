"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import materialize

#: A node of more links than this, and than a ``HUBS``-th of all links, is a hub; so there are
#: at most ``2 * HUBS`` hubs.
HUB_LINKS = 200
HUBS = 100_000


def _with_least(rows: DataFrame, least: Column, links: int) -> DataFrame:
    """(u, v) with ``m``, the least value of each u. The table of hubs, of bounded size, is
    broadcast, so their links stay where they are; the other nodes' links meet by node."""
    low = rows.groupBy("u").agg(least.alias("m"), F.count(F.lit(1)).alias("n"))
    hub = F.col("n") > max(HUB_LINKS, links // HUBS)
    hubs, others = F.broadcast(low.where(hub).drop("n")), low.where(~hub).drop("n")
    return rows.join(hubs, "u").unionByName(rows.join(hubs.select("u"), "u", "left_anti").join(others, "u"))


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(u, v) links of longs -> (node, root), root the smallest node of the component.
    Nodes that are their own root have no row. Each step is two aggregates and joins on
    the links, written to the shared folder; the number of steps grows with the log of
    the largest component's diameter. A hub's links are spread over all tasks. Nothing but two
    counters reaches the driver.

    Links with a null end, links of a node to itself and repeated links change nothing; no
    links give no rows."""
    e = (links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct())
    e = materialize(e, "links")
    seen = None
    while True:
        mark = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen or mark[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, F.least(F.min("v"), F.first("u")), mark[0])
        large = materialize(large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        small = _with_least(large, F.min("v"), mark[0])
        e = materialize(small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct(), "links")
