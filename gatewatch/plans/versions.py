"""Rules as of event time (H3, H4, A8): a replay scores with the rules of its time.

A rule version is in force from its ``valid_from`` until the next one's. A record's critical flag is
taken from the version in force at its event time, a window's flows from the one in force
at its end; before the first version there are no rules. Versions are configuration: their
patterns and flows are constants of the plan, chosen per row, so a replay over any number
of versions is the one job over the records and no join.

``flag_listed_asof`` is the as-of join for lists whose entries come and go one by one: the
changes of an address become intervals, met by an equi-join on the address."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.config import Tables, WindowSpec
from gatewatch.functions.regex import matches_any
from gatewatch.operators import features as fe
from gatewatch.operators import scoring as S
from gatewatch.plans.enrich_job import compiled
from gatewatch.plans.score_job import indicator_records
from gatewatch.sources import rules as R


@dataclass
class RuleVersion:
    valid_from_us: int
    tables: Tables


def _in_force(at_us: Column, versions: list[RuleVersion], value, before: Column) -> Column:
    """``value(version)`` of the newest version that is valid at ``at_us``; of versions with
    the same time the later in the list."""
    out = None
    for v in sorted(versions, key=lambda v: v.valid_from_us)[::-1]:
        test = at_us >= v.valid_from_us
        out = F.when(test, value(v)) if out is None else out.when(test, value(v))
    return before if out is None else out.otherwise(before)


def records_asof(processed: DataFrame, versions: list[RuleVersion]) -> DataFrame:
    """``indicator_records`` with the critical flag of each record's own time."""
    at = F.unix_micros("ts")
    flag = _in_force(at, versions, lambda v: F.coalesce(matches_any(F.col("request"), compiled(v.tables)["critical_patterns"]), F.lit(False)), F.lit(False))
    return indicator_records(processed, Tables(extra={"compiled": {"critical_patterns": []}})).withColumn("critical", F.coalesce(flag, F.lit(False)))


def scored_asof(processed: DataFrame, versions: list[RuleVersion], w: WindowSpec, n: int = 0) -> DataFrame:
    """G1-G4 with each window's flows as of its end."""
    flows = {id(v): S.flow_table(R.flow_config(v.tables, n).collect()) for v in versions}
    none = S.flow_table([])
    at = F.unix_micros("window_end")
    feats = fe.window_features(records_asof(processed, versions), w)
    return S.flow_scores(feats, flows=_in_force(at, versions, lambda v: flows[id(v)], none))


def blacklist_asof(processed: DataFrame, versions: list[RuleVersion], w: WindowSpec, n: int = 0) -> DataFrame:
    """G5-G6 of a replay: the entries the score job would have made at the time."""
    return S.blacklist_entries(scored_asof(processed, versions, w, n))


def flag_listed_asof(df: DataFrame, changes: DataFrame, ip_col: str = "remote_addr", ts_col: str = "ts", out: str = "listed") -> DataFrame:
    """Adds ``out``: whether the address was listed at the row's time, by ``changes`` (ip_name,
    valid_from, listed). Of changes at the same time the one that lists wins. An address
    has few changes, so a row meets at most one interval and nothing is expanded; rows of a
    hot address are split by adaptive execution, as the other side has one row for each change."""
    one = changes.filter(F.col("ip_name").isNotNull() & F.col("valid_from").isNotNull()).groupBy("ip_name", "valid_from").agg(F.bool_or("listed").alias("__on"))
    until = F.lead("valid_from").over(Window.partitionBy("ip_name").orderBy("valid_from"))
    spans = one.withColumn("__until", until).filter("__on").withColumnsRenamed({"ip_name": "__ip", "valid_from": "__from"})
    at = F.col(ts_col)
    inside = (F.col(ip_col) == F.col("__ip")) & (at >= F.col("__from")) & (F.col("__until").isNull() | (at < F.col("__until")))
    return df.join(spans, inside, "left").withColumn(out, F.col("__ip").isNotNull()).drop("__ip", "__from", "__until", "__on")
