"""Processed-record wire format (C35, C36): 19 fields joined by ``#CS#``; empty or
missing values are the literal ``NULL``; the query and book structs travel as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.config import FIELD_SEP

# Field order of the processed record on the wire (fixed values).
WIRE_FIELDS = ("source", "request_method", "request", "ip", "user_agent", "time_iso8601",
               "server_addr", "high_freq", "flight_type", "behavior_type", "travel_type",
               "flight_date", "dep_city", "arr_city", "session_hash", "user_hash",
               "query_json", "book_json", "referer")

QUERY_SCHEMA = ("is_empty boolean, flight_type int, depcity string, arrcity string, "
                "flightdate string, adultnum string, childnum string, infantnum string, "
                "country string, travel_type int")
BOOK_SCHEMA = ("flight_type int, travel_type int, flightno array<string>, depcity array<string>, "
               "arrcity array<string>, flightdate array<string>, cabin array<string>, "
               "psgname array<string>, psgtype array<string>, idtype array<string>, "
               "idcard array<string>, contractname string, contractphone string, bookagent string, "
               "bookuserid string, bookunuserid string")


def _text(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull() | (s == ""), F.lit("NULL")).otherwise(s)


def serialize(df: DataFrame) -> DataFrame:
    """Processed records -> ``value`` wire lines (plus behaviour for routing)."""
    cols = []
    for f in WIRE_FIELDS:
        if f == "query_json":
            cols.append(_text(F.to_json("query")))
        elif f == "book_json":
            cols.append(_text(F.to_json("book")))
        elif f == "high_freq":
            cols.append(F.when(F.col("high_freq"), F.lit("true")).otherwise(F.lit("false")))
        else:
            cols.append(_text(F.col(f)))
    return df.select(F.concat_ws(FIELD_SEP, *cols).alias("value"), "behavior_type")


def parse(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Wire lines -> typed records; ``NULL`` -> SQL NULL; JSON -> structs. A missing
    address stays the literal ``NULL``: it is a key of the indicators like any other.
    Lines without exactly 19 fields or with an unreadable time are left out here;
    ``wire_rejects`` lists them with the reason."""
    parts = F.split(F.col(value_col), FIELD_SEP, -1)
    ok = lines.withColumn("__p", parts).filter(F.size("__p") == len(WIRE_FIELDS))
    def field(i):
        v = F.get("__p", F.lit(i))
        return F.when(v == "NULL", F.lit(None).cast("string")).otherwise(v)
    out = []
    for i, f in enumerate(WIRE_FIELDS):
        v = field(i)
        if f == "high_freq":
            v = v == "true"
        elif f == "ip":
            v = F.get("__p", F.lit(i))
        elif f == "query_json":
            v = F.from_json(v, QUERY_SCHEMA)
            f = "query"
        elif f == "book_json":
            v = F.from_json(v, BOOK_SCHEMA)
            f = "book"
        out.append(v.alias(f))
    return ok.select(*out).withColumn("ts", F.try_to_timestamp(F.col("time_iso8601"))).filter("ts IS NOT NULL")


def wire_rejects(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """C36 reject path: wire lines without exactly 19 fields (reason ``width``) or whose time
    cannot be read (reason ``time``), with their field count. A NULL line has no fields."""
    parts = F.split(F.col(value_col), FIELD_SEP, -1)
    n = F.coalesce(F.size(parts), F.lit(0))
    at = F.get(parts, F.lit(WIRE_FIELDS.index("time_iso8601")))
    reason = (F.when(n != len(WIRE_FIELDS), F.lit("width"))
              .when(F.try_to_timestamp(at).isNull(), F.lit("time")))
    return lines.withColumn("n_fields", n).withColumn("reason", reason).filter("reason IS NOT NULL")
