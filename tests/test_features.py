"""Pane form = direct form; gap merge across buckets; E-indicator edge cases."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatewatch.config import WindowSpec
from gatewatch.operators import features as fe

SCHEMA = ("ip string, request string, user_agent string, session_id string, dep_city string, "
          "arr_city string, ts timestamp, critical boolean")
BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _rows(items):
    return [(f"10.0.{i % 3}.{i % 2}", f"/r{r}", f"UA{u}", f"s{s}", "A", f"B{r}",
             BASE + dt.timedelta(seconds=t), bool(c)) for i, (t, r, u, s, c) in enumerate(items)]


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


row = st.tuples(st.integers(0, 400), st.integers(0, 2), st.integers(0, 3), st.integers(0, 3), st.booleans())


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_pane_equals_direct(spark, items):
    w = WindowSpec("60 seconds", "20 seconds", fast_repeat_ms=10_000, gap_bucket="5 seconds")
    df = spark.createDataFrame(_rows(items), SCHEMA)
    assert _sorted(fe.ip_features(df, w, "pane")) == _sorted(fe.ip_features(df, w, "direct"))
    assert _sorted(fe.fast_repeats(df, w, "pane")) == _sorted(fe.fast_repeats(df, w, "direct"))
    assert _sorted(fe.block_counts(df, w, "pane")) == _sorted(fe.block_counts(df, w, "direct"))


def test_min_gap_crosses_buckets(spark):
    w = WindowSpec("9 seconds", "3 seconds", fast_repeat_ms=10_000, gap_bucket="1 second")
    items = [(0, 0, 0, 0, 1), (4, 0, 0, 0, 1), (5, 0, 0, 0, 1)]
    rows = [("1.2.3.4", "/a", "u", "s", "A", "B", BASE + dt.timedelta(seconds=t), True) for t, *_ in items]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["window_end"].timestamp() - BASE.timestamp(): r["min_interval_ms"]
           for r in fe.ip_features(df, w).collect()}
    # window ending at 9 s holds 0, 4, 5 -> gaps 4000, 1000
    assert got[9] == 1000
    # window ending at 3 s holds one access -> no gap
    assert got[3] is None
    # window ending at 12 s holds 4, 5 (0 is out)
    assert got[12] == 1000


def test_non_critical_rows_do_not_enter_gaps(spark):
    # 2.J-19: non-critical rows are not time "0"
    w = WindowSpec("9 seconds", "3 seconds")
    rows = [("1.2.3.4", "/a", "u", "s", None, None, BASE + dt.timedelta(seconds=1), False),
            ("1.2.3.4", "/a", "u", "s", None, None, BASE + dt.timedelta(seconds=2), True)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert all(r["min_interval_ms"] is None for r in fe.ip_features(df, w).collect())


def test_ip_block_without_dot(spark):
    # 2.J-23: 'NULL' and dotless addresses are their own block
    assert spark.range(1).select(fe.ip_block(F.lit("NULL"))).first()[0] == "NULL"
    assert spark.range(1).select(fe.ip_block(F.lit("10.1.2.3"))).first()[0] == "10.1"


def test_request_gaps_across_days(spark):
    rows = [("1.2.3.4", "/a", "u", "s", None, None, BASE + dt.timedelta(hours=h), True) for h in (0, 23, 25)]
    df = spark.createDataFrame(rows, SCHEMA)
    gaps = sorted((r["gap_ms"] for r in fe.request_gaps(df).collect()), key=lambda x: (x is not None, x))
    assert gaps == [None, 2 * 3600 * 1000, 23 * 3600 * 1000]


@settings(max_examples=6, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_shared_window_features_equal_direct(spark, items):
    from gatewatch.operators import scoring as S
    w = WindowSpec("60 seconds", "20 seconds", fast_repeat_ms=10_000, gap_bucket="5 seconds")
    df = spark.createDataFrame(_rows(items), SCHEMA)
    shared = fe.window_features(df, w)
    direct = S.attach_features(S.score_keys(df, w), df, w, "direct")
    cols = ["window_end", "ip", "request", *S.FEATURE_COLUMNS]
    assert _sorted(shared.select(*cols)) == _sorted(direct.select(*cols))
