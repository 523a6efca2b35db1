"""Indicator lookup, rule hits, flow scores and blacklist entries.

Score of a flow, for rules i with s_i = the rule's score if hit else 0, n rules,
E = rules with status 0 (enabled):

    score = (sum s / (10 n)) * (min(60, 10 * max_E s) + 40 * sum_E s / sum s)

and 0 when sum s = 0 (the reference yields NaN there, which Spark would order above
every number). n, sum s and the hit list include disabled rules; max over an empty
E is 0.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.config import BLACKLIST_KEY_PREFIX, BLACKLIST_TTL_S, WindowSpec
from gatewatch.operators import features as fe
from gatewatch.sources.rules import ARG1_INDICATOR, INDICATORS

# indicator name -> feature column (fixed mapping of the eight indicator names)
INDICATOR_COLUMNS = {
    "ipBlock": "block_count",
    "ip": "ip_count",
    "criticalPages": "critical_count",
    "userAgent": "ua_distinct",
    "criticalPagesAccTime": "min_interval_ms",
    "flightQuery": "trip_distinct",
    "criticalCookies": "session_distinct",
    "criticalPagesLessThanDefault": "fast_repeats",
}
FEATURE_COLUMNS = tuple(INDICATOR_COLUMNS.values())


def attach_features(keys: DataFrame, records: DataFrame, w: WindowSpec,
                    form: str = "pane") -> DataFrame:
    """left lookups of the eight indicators for ``keys`` (window_end, ip, request),
    defaulting to 0. ``records`` are the rows the indicators are computed over."""
    ipf = fe.ip_features(records, w, form)
    blk = fe.block_counts(records, w, form)
    fast = fe.fast_repeats(records, w, form)
    k = keys.withColumn("ip_block", fe.ip_block(F.col("ip")))
    out = (k.join(ipf, ["window_end", "ip"], "left")
            .join(blk, ["window_end", "ip_block"], "left")
            .join(fast, ["window_end", "ip", "request"], "left"))
    return out.select(*keys.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                                       for c in FEATURE_COLUMNS])


def score_keys(records: DataFrame, w: WindowSpec) -> DataFrame:
    """The (window_end, ip, request) combinations to score: each record is scored on the
    window that ends with its own pane. De-duplicated with map-side partial aggregation,
    so a hot address collapses before the shuffle."""
    return records.select(fe.pane_end(F.col("ts"), w).alias("window_end"), "ip", "request") \
        .filter(F.col("window_end").isNotNull()).distinct()


def unpivot_indicators(features: DataFrame, keys: list[str]) -> DataFrame:
    """F2 helper: wide indicator columns -> (keys..., indicator, value)."""
    pairs = ", ".join(f"'{name}', CAST({col} AS DOUBLE)" for name, col in INDICATOR_COLUMNS.items())
    return features.select(*keys, F.expr(f"stack({len(INDICATOR_COLUMNS)}, {pairs}) AS (indicator, value)"))


def threshold(indicator: Column, arg0: Column, arg1: Column) -> Column:
    """G1: arg1 for the too-fast-repeat indicator, else arg0 (fix 2.J-24)."""
    return F.when(indicator == ARG1_INDICATOR, arg1).otherwise(arg0)


def rule_hits(features: DataFrame, keys: list[str], flow_rules: DataFrame) -> DataFrame:
    """F2 + G1, relational form: indicators unpivoted and joined to the rule table on
    indicator name; hit when value > threshold (strict). A rule with an unknown indicator
    sees the value 0. The rules, configuration, are broadcast whatever size Spark expects:
    a shuffle by the eight names would be eight tasks for rows of any number."""
    long = unpivot_indicators(features, keys).withColumnRenamed("indicator", "__name")
    known = F.col("indicator").isin(*INDICATOR_COLUMNS)
    r = flow_rules.withColumn("__known", known).withColumn(
        "__name", F.when(known, F.col("indicator")).otherwise(next(iter(INDICATOR_COLUMNS))))
    j = long.join(F.broadcast(r), "__name").withColumn("value", F.when(F.col("__known"), F.col("value")).otherwise(0.0))
    thr = threshold(F.col("indicator"), F.col("arg0"), F.col("arg1"))
    return j.select(*keys, "flow_id", "rule_id", "indicator", "value", "rule_status",
                    (F.col("value") > thr).alias("hit"),
                    F.when(F.col("value") > thr, F.col("rule_score")).otherwise(0).alias("s"))


_FLOWS = ("array<struct<flow_id:string, flow_limit:double, rules:array<struct<"
          "rule_id:string, slot:int, thr:double, score:double, enabled:boolean>>>>")


def flow_table(rows: list) -> Column:
    """The flows with their rules as one constant array (rules by id). Rule tables are
    configuration; the plan has the same size for any number of rules."""
    by_flow: dict = {}
    for r in sorted(rows, key=lambda r: (r["flow_id"], r["rule_id"])):
        f = by_flow.setdefault(r["flow_id"], {"flow_id": r["flow_id"], "flow_limit": float(r["flow_limit"]), "rules": []})
        col = INDICATOR_COLUMNS.get(r["indicator"])
        thr = r["arg1"] if r["indicator"] == ARG1_INDICATOR else r["arg0"]
        f["rules"].append({"rule_id": r["rule_id"], "slot": FEATURE_COLUMNS.index(col) if col else -1,
                           "thr": float(thr if thr is not None else 0.0), "score": float(r["rule_score"]),
                           "enabled": r["rule_status"] == 0})
    return F.from_json(F.lit(json.dumps(list(by_flow.values()))), _FLOWS)


def flow_scores(features: DataFrame, flow_config: DataFrame | None = None, rows: list | None = None,
                flows: Column | None = None) -> DataFrame:
    """One row per (input row, flow). The flows are a constant array of their rules,
    so scoring is one narrow projection over the features, without join or shuffle.
    ``flows`` gives that array itself, as an expression over the row."""
    if flows is None:
        flows = flow_table(rows if rows is not None else flow_config.collect())
    keep = [f"`{c}`" for c in features.columns]
    values = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0D)" for c in FEATURE_COLUMNS)
    # one pass over a flow's rules; an unknown indicator (slot -1) has the value 0. The sums
    # are made inside the generator, so nothing above it repeats them.
    hit = "(if(r.slot < 0, 0D, get(__v, greatest(r.slot, 0))) > r.thr)"
    s = f"if({hit}, r.score, 0D)"
    x = features.withColumn("__flows", flows).selectExpr(*keep, "__flows", f"array({values}) AS __v")
    x = x.selectExpr(*keep, f"""explode(transform(__flows, f -> named_struct(
        'flow_id', f.flow_id, 'flow_limit', f.flow_limit, 'n', size(f.rules), 'a', aggregate(f.rules,
          named_struct('tot', 0D, 'esum', 0D, 'emax', CAST(NULL AS DOUBLE), 'hits', CAST(array() AS ARRAY<STRING>)),
          (a, r) -> named_struct(
            'tot', a.tot + {s}, 'esum', a.esum + if(r.enabled, {s}, 0D),
            'emax', if(r.enabled, greatest(a.emax, {s}), a.emax),
            'hits', if({hit}, concat(a.hits, array(r.rule_id)), a.hits)))))) AS __f""")
    x = x.selectExpr(*keep, "__f.flow_id AS flow_id", """if(__f.a.tot = 0, 0D, __f.a.tot / (__f.n * 10D)
        * (least(60D, coalesce(__f.a.emax, 0D) * 10D) + 40D * __f.a.esum / nullif(__f.a.tot, 0D))) AS flow_score""",
                     "__f.flow_limit AS flow_limit", "__f.a.hits AS hit_rules")
    return x.selectExpr(*keep, "flow_id", "flow_score", "flow_limit", "flow_score > flow_limit AS over_limit", "hit_rules")


def flow_scores_relational(hits: DataFrame, keys: list[str], flow_config: DataFrame) -> DataFrame:
    """G2-G4, join form: aggregate ``rule_hits``
    per (keys, flow). n counts the flow's rules from the configuration; this row per flow
    is broadcast, as a shuffle by flow would be a task for each."""
    n = flow_config.groupBy("flow_id").agg(F.count(F.lit(1)).alias("n_rules"),
                                           F.first("flow_limit").alias("flow_limit"))
    g = hits.groupBy(*keys, "flow_id").agg(
        F.sum("s").cast("double").alias("tot"),
        F.coalesce(F.sum(F.when(F.col("rule_status") == 0, F.col("s"))), F.lit(0)).cast("double").alias("esum"),
        F.coalesce(F.max(F.when(F.col("rule_status") == 0, F.col("s"))), F.lit(0)).cast("double").alias("emax"),
        F.array_sort(F.collect_list(F.when(F.col("hit"), F.col("rule_id")))).alias("hit_rules"))
    g = g.join(F.broadcast(n), "flow_id")
    score = F.when(F.col("tot") == 0, F.lit(0.0)).otherwise(
        F.col("tot") / (F.col("n_rules") * 10.0) * (F.least(F.lit(60.0), F.col("emax") * 10.0)
                                                   + F.lit(40.0) * F.col("esum") / F.col("tot")))
    return g.select(*keys, "flow_id", score.alias("flow_score"), "flow_limit",
                    (score > F.col("flow_limit")).alias("over_limit"), "hit_rules")


def blacklist_candidates(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with at least one flow over its limit."""
    return scored.groupBy(*keys).agg(F.bool_or("over_limit").alias("any_over")).filter("any_over").drop("any_over")


def dedupe_hits(scored: DataFrame) -> DataFrame:
    """One row per (window_end, ip, flow) over the limit; the reference keeps an
    arbitrary one, here the highest score then the greatest request (deterministic)."""
    over = scored.filter("over_limit")
    best = F.max_by(F.struct("flow_score", "flow_limit", "hit_rules", "request"),
                    F.struct("flow_score", "request"))
    return over.groupBy("window_end", "ip", "flow_id").agg(best.alias("b")).select(
        "window_end", "ip", "flow_id", "b.flow_score", "b.flow_limit", "b.hit_rules",
        F.col("b.request").alias("request"))


def blacklist_entries(scored: DataFrame, ttl_s: int = BLACKLIST_TTL_S) -> DataFrame:
    """G6 + C37: one entry per (window, ip, flow) over the limit (fix 2.J-28);
    key ``CSANTI_ANTI_BLACK{ip}:{flow}``, value ``score|limit|hitRules|hitTime``,
    expiring ``ttl_s`` after the window end (the hit time, fix 2.J-27)."""
    d = dedupe_hits(scored)
    hit_time = F.date_format("window_end", "yyyy-MM-dd HH:mm:ss")
    return d.select(
        "window_end", "ip", "flow_id", "flow_score", "flow_limit",
        F.array_join("hit_rules", ",").alias("hit_rules"),
        F.concat(F.lit(BLACKLIST_KEY_PREFIX), F.col("ip"), F.lit(":"), F.col("flow_id")).alias("bl_key"),
        F.concat_ws("|", F.format_string("%.6f", "flow_score"), F.format_string("%.6f", "flow_limit"),
                    F.array_join("hit_rules", ","), hit_time).alias("bl_value"),
        (F.col("window_end") + F.expr(f"INTERVAL {int(ttl_s)} SECONDS")).alias("expire_at"))
