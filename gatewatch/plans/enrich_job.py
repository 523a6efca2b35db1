"""H6: raw access-log lines -> processed records (the data job).

A1 -> C1 -> C6 -> C8/C9 -> C10/C11 -> C12/C13/C21 -> C32 -> C34. Every step is a
column expression over the same rows; the joins are with rule tables that Spark
broadcasts by size, so the whole job is one narrow stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.config import Tables
from gatewatch.functions import classify as C
from gatewatch.functions.masking import ID_PATTERN, PHONE_PATTERN, mask_pii
from gatewatch.functions.regex import collect_patterns, matches_any
from gatewatch.functions.text import md5_upper
from gatewatch.operators import extract as X
from gatewatch.operators.ingest import parse_access_log, timed
from gatewatch.operators.lookup import flag_listed_ip, listed_side
from gatewatch.sources import rules as R


def class_patterns(classify_rule: DataFrame) -> dict:
    """A5, collected: class -> regex list (configuration rows)."""
    rows = classify_rule.collect()
    names = {(0, 0): "nq", (0, 1): "nb", (1, 0): "iq", (1, 1): "ib"}
    out: dict = {}
    for r in rows:
        cls = names.get((r["flight_type"], r["operation_type"]))
        if cls and r["expression"]:
            out.setdefault(cls, []).append(r["expression"])
    return {k: sorted(v) for k, v in out.items()}


def compiled(tables: Tables) -> dict:
    """Rule artifacts derived from one version of the rule tables, built once and kept
    on the Tables object: folded patterns, ordered parse rules and the rule sides of the
    joins. A micro-batch job reuses them until the rule version changes."""
    c = tables.extra.get("compiled")
    if c is None:
        c = {
            "classes": class_patterns(tables.classify_rule),
            "prules": X.collect_parse_rules(tables.parse_rule),
            "url_patterns": collect_patterns(R.url_filter_rules(tables.filter_rule)),
            "critical_patterns": collect_patterns(tables.critical_page),
            "parse_rule_side": X.rule_side(tables.parse_rule),
            "listed_side": listed_side(R.high_frequency_ips(tables.ip_blacklist)),
        }
        tables.extra["compiled"] = c
    return c


def url_filter(df: DataFrame, tables: Tables, col: str = "request") -> DataFrame:
    """Drop rows whose request matches any type-0 filter rule (whole string)."""
    pats = compiled(tables)["url_patterns"]
    return df.filter(~F.coalesce(matches_any(F.col(col), pats), F.lit(False)))


def enrich(access: DataFrame, tables: Tables, id_pattern: str = ID_PATTERN,
           phone_pattern: str = PHONE_PATTERN) -> DataFrame:
    """Parsed access-log rows (``operators.ingest.parse_access_log``) -> processed records."""
    comp = compiled(tables)
    classes, prules = comp["classes"], comp["prules"]
    a = url_filter(timed(access), tables)
    cls = C.classify_request(F.col("request"), classes)
    a = a.withColumns({
        "masked_cookie": mask_pii(F.col("http_cookie"), id_pattern, phone_pattern),
        "flight_type": cls["flight_type"],
        "behavior_type": cls["behavior_type"],
        "travel_type": C.travel_type(F.col("http_referer")),
    })
    flight_id = C.label_to_id(F.col("flight_type"), C.FLIGHT)
    behavior_id = C.label_to_id(F.col("behavior_type"), C.BEHAVIOR)
    travel_id = C.label_to_id(F.col("travel_type"), C.TRAVEL)
    a = a.withColumn("matched_rule", X.matched_rule(prules, F.col("request_method"), behavior_id,
                                                   F.col("request")))
    a = X.attach_rule(a, tables.parse_rule, side=comp["parse_rule_side"])
    if "steps" not in comp:
        comp["steps"] = (X.query_steps(prules, flight_id=flight_id, referer_travel_id=travel_id),
                         X.book_steps(prules, referer_travel_id=travel_id))
    a = X.apply_steps(a, comp["steps"][0])
    a = X.apply_steps(a, comp["steps"][1])
    a = X.drop_rule(a)
    a = flag_listed_ip(a, R.high_frequency_ips(tables.ip_blacklist), "remote_addr", "high_freq",
                       keys=comp["listed_side"])
    passthrough = [c for c in ("event_id",) if c in access.columns]
    return a.select(
        # the reference leaves the source field empty: the raw line itself holds the
        # field separator and would break the wire format
        *passthrough, F.lit(None).cast("string").alias("source"), "request_method", "request",
        F.col("remote_addr").alias("ip"), F.col("http_user_agent").alias("user_agent"),
        "time_iso8601", "ts", "server_addr", "high_freq", "flight_type", "behavior_type",
        "travel_type",
        X.core_field(F.col("query"), F.col("book"), "flightdate").alias("flight_date"),
        X.core_field(F.col("query"), F.col("book"), "depcity").alias("dep_city"),
        X.core_field(F.col("query"), F.col("book"), "arrcity").alias("arr_city"),
        md5_upper(F.col("jsession_id")).alias("session_hash"),
        md5_upper(F.col("cookie_user_id")).alias("user_hash"),
        "query", "book", F.col("http_referer").alias("referer"), "masked_cookie", "matched_rule")


def enrich_lines(lines: DataFrame, tables: Tables, **kw) -> DataFrame:
    """Wire lines (``value``) -> processed records; malformed lines are left to
    ``operators.ingest.reject_rows``."""
    return enrich(parse_access_log(lines), tables, **kw)
