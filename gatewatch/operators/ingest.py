"""Raw log lines -> typed access-log rows, with a reject table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.config import FIELD_SEP
from gatewatch.functions import text
from gatewatch.sources.adapters import RAW_FIELDS


def _split(lines: DataFrame, value_col: str) -> DataFrame:
    return lines.withColumn("__p", F.split(F.col(value_col), FIELD_SEP, -1))


def parse_access_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Split on ``#CS#``; exactly 12 fields; the last is the active-connection
    count (``try_cast``, NULL when not a number). Rows of another width go to
    ``reject_rows`` instead of failing the batch (fix 2.J-1). Adds ``ts`` (event time from
    ``time_iso8601``, NULL if unreadable) and the cookie session / user ids (C5)."""
    s = _split(lines, value_col).filter(F.size("__p") == len(RAW_FIELDS))
    keep = [c for c in lines.columns if c != value_col]
    # get: a later filter on a field may be evaluated before the width is
    cols = [F.get("__p", F.lit(i)).alias(name) for i, name in enumerate(RAW_FIELDS[:-1])]
    cols.append(F.get("__p", F.lit(len(RAW_FIELDS) - 1)).try_cast("int").alias("connection_active"))
    out = s.select(*keep, F.col(value_col).alias("source"), *cols)
    return out.withColumns({
        "ts": F.try_to_timestamp(F.col("time_iso8601")),
        "jsession_id": text.session_id(F.col("http_cookie")),
        "cookie_user_id": text.user_id(F.col("http_cookie")),
    })


def timed(access: DataFrame) -> DataFrame:
    """Rows whose time can be read: the data job takes these, ``reject_rows`` has the others.
    Link counts (D1-D3) need no time and count both."""
    return access.filter("ts IS NOT NULL")


def reject_rows(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """C1 reject path: lines without exactly 12 fields (reason ``width``) or whose time
    cannot be read (reason ``time``), with the field count. Every line is either here
    or in the ``timed`` rows of ``parse_access_log``; a NULL line has no fields."""
    s = _split(lines, value_col)
    n = F.coalesce(F.size("__p"), F.lit(0))
    at = F.get("__p", F.lit(RAW_FIELDS.index("time_iso8601")))
    reason = (F.when(n != len(RAW_FIELDS), F.lit("width"))
              .when(F.try_to_timestamp(at).isNull(), F.lit("time")))
    return s.select(*[c for c in lines.columns], n.alias("n_fields"), reason.alias("reason")).filter("reason IS NOT NULL")
