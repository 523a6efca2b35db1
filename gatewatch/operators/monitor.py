"""Link counts and throughput.

D1-D3 are one ``groupBy(server)``; the per-batch throughput of a stream comes from
``StreamingQuery.lastProgress`` (see streaming.jobs.ThroughputListener); in batch
form it is computed per batch-id column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def link_counts(access: DataFrame) -> DataFrame:
    """Requests per server."""
    return access.groupBy("server_addr").agg(F.count(F.lit(1)).alias("n_requests"))


def link_active_latest(access: DataFrame, order_cols=("ts", "event_id")) -> DataFrame:
    """The latest active-connection count per server (deterministic: the greatest
    (time, id) wins)."""
    cols = [c for c in order_cols if c in access.columns]
    return access.groupBy("server_addr").agg(
        F.max_by("connection_active", F.struct(*cols)).alias("connection_active"))


def link_snapshot(access: DataFrame, order_cols=("ts", "event_id")) -> DataFrame:
    """D3: both maps in one pass and one JSON document (keys sorted)."""
    cols = [c for c in order_cols if c in access.columns]
    per = access.groupBy("server_addr").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("connection_active", F.struct(*cols)).alias("active"))
    entries = F.array_sort(F.collect_list(F.struct("server_addr", "n", "active")))
    return per.agg(entries.alias("e")).select(
        F.to_json(F.map_from_arrays(F.transform("e", lambda x: x["server_addr"]),
                                    F.transform("e", lambda x: x["n"]))).alias("link_counts"),
        F.to_json(F.map_from_arrays(F.transform("e", lambda x: x["server_addr"]),
                                    F.transform("e", lambda x: x["active"]))).alias("active_connections"))


def batch_throughput(access: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """D4 in batch form: rows per batch, event-time span, rows per ms of that span
    (same batch, fix 2.J-38), requests per server inside the batch."""
    per = access.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))
    span_ms = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / 1000
    return per.select(batch_col, "n_rows", F.unix_micros("start_ts").alias("start_us"),
                      F.unix_micros("end_ts").alias("end_us"),
                      F.round(F.try_divide(F.col("n_rows").cast("double"), span_ms), 6).alias("rows_per_ms"))


def batch_server_counts(access: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    return access.groupBy(batch_col, "server_addr").agg(F.count(F.lit(1)).alias("n_requests"))
