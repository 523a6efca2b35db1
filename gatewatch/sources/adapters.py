"""Access-log view over the driver's ``events`` table (FIXTURES.md section 3).

Deterministic, so DuckDB derives exactly the same rows (see plans/oracles.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.config import FIELD_SEP

# Request path per event type - fixed values of the fixture adapter.
REQUEST_PATHS = {
    "view": "/air/search",
    "click": "/air/intl/search",
    "purchase": "/air/book",
    "signup": "/air/intl/book",
    "error": "/static/err.js",
}

RAW_FIELDS = ("time_local", "request", "request_method", "content_type",
              "request_body", "http_referer", "remote_addr", "http_user_agent",
              "time_iso8601", "server_addr", "http_cookie", "connection_active")


def _path(event_type: Column) -> Column:
    expr = None
    for k, v in REQUEST_PATHS.items():
        expr = (F.when(event_type == k, F.lit(v)) if expr is None
                else expr.when(event_type == k, F.lit(v)))
    return expr.otherwise(F.lit("/"))


def access_log(events: DataFrame) -> DataFrame:
    """events -> one access-log row per event (typed columns, not yet a wire line)."""
    e = events
    ts = F.col("ts").cast("timestamp")  # session time zone is UTC (session.prepare)
    eid, uid = F.col("event_id"), F.col("user_id")
    referer = F.when(eid % 5 == 0, F.lit("http://h.example/p")).otherwise(
        F.concat(F.lit("http://h.example/p?go=2024-02-01"),
                 F.when(eid % 2 == 0, F.lit("&back=2024-02-09")).otherwise(F.lit(""))))
    post = eid % 3 == 0
    return e.select(
        eid.alias("event_id"),
        ts.alias("ts"),
        F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss").alias("time_local"),
        F.concat(_path(F.col("event_type")), F.lit("?dep=C"), (uid % 5).cast("string"),
                 F.lit("&arr=C"), (eid % 7).cast("string")).alias("request"),
        F.when(post, F.lit("POST")).otherwise(F.lit("GET")).alias("request_method"),
        F.when(post, F.lit("application/x-www-form-urlencoded"))
         .otherwise(F.lit("text/html")).alias("content_type"),
        F.concat(F.lit("q="), F.col("props")).alias("request_body"),
        referer.alias("http_referer"),
        F.concat(F.lit("10."), (uid % 16).cast("string"), F.lit("."),
                 (uid % 7).cast("string"), F.lit("."), uid.cast("string")).alias("remote_addr"),
        F.concat(F.lit("UA"), (eid % 11).cast("string")).alias("http_user_agent"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("time_iso8601"),
        F.concat(F.lit("192.168.1."), (eid % 4).cast("string")).alias("server_addr"),
        F.concat(F.lit("JSESSIONID=s"), (eid % 13).cast("string"),
                 F.lit(";userId4logCookie=u"), uid.cast("string")).alias("http_cookie"),
        F.floor(F.col("value")).cast("int").alias("connection_active"),
    )


def raw_lines(events: DataFrame) -> DataFrame:
    """Wire form of the access log: ``value`` = 12 fields joined by ``#CS#``.
    Rows with ``event_id % 50 = 0`` lose their last field, feeding the reject path."""
    a = access_log(events)
    cols = [F.col(c).cast("string") for c in RAW_FIELDS]
    full = F.concat_ws(FIELD_SEP, *cols)
    short = F.concat_ws(FIELD_SEP, *cols[:-1])
    return a.select("event_id", F.when(F.col("event_id") % 50 == 0, short)
                    .otherwise(full).alias("value"))
