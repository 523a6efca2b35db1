"""H7: processed records -> indicators -> flow scores -> blacklist (the score job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.config import Tables, WindowSpec
from gatewatch.functions.regex import collect_patterns, matches_any
from gatewatch.operators import features as fe
from gatewatch.operators import scoring as S
from gatewatch.sources import rules as R


#: The columns of the processed records that ``indicator_records`` reads.
INPUT = ("ip", "request", "user_agent", "session_hash", "dep_city", "arr_city", "ts")


def indicator_records(processed: DataFrame, tables: Tables) -> DataFrame:
    """The columns the indicators read, with the critical-page flag (E13) computed
    once as a column from the folded page regexes (refreshable, fix 2.J-29)."""
    from gatewatch.plans.enrich_job import compiled
    pats = compiled(tables)["critical_patterns"]
    # a missing address or request is the literal NULL of the wire format, a key like any other
    def key(c):
        return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("NULL")).alias(c)

    return processed.select(
        key("ip"), key("request"), "user_agent", F.col("session_hash").alias("session_id"),
        "dep_city", "arr_city", "ts",
        F.coalesce(matches_any(F.col("request"), pats), F.lit(False)).alias("critical"))


def scored(processed: DataFrame, tables: Tables, w: WindowSpec, form: str = "pane",
           n: int = 0) -> DataFrame:
    """One row per (window_end, ip, request, flow) with the eight indicators, the flow
    score, the limit, the over-limit flag and the hit rules."""
    recs = indicator_records(processed, tables)
    if form == "pane":
        feats = fe.window_features(recs, w)
    else:
        feats = S.attach_features(S.score_keys(recs, w), recs, w, form)
    return S.flow_scores(feats, R.flow_config(tables, n))


def blacklist(processed: DataFrame, tables: Tables, w: WindowSpec, form: str = "pane",
              n: int = 0) -> DataFrame:
    """Blacklist entries (key, value, expiry) for flows over their limit."""
    return S.blacklist_entries(scored(processed, tables, w, form, n))
