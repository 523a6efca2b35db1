"""Flow score formula, NaN guard, compiled vs relational scoring, blacklist tables."""

import datetime as dt

from pyspark.sql import functions as F

from gatewatch.operators import blacklist as B
from gatewatch.operators import scoring as S
from gatewatch.sources import rules as R

CFG = "flow_id string, flow_limit double, rule_id string, indicator string, rule_status int, arg0 double, arg1 double, rule_score int"


def _features(spark, **vals):
    cols = {c: 0 for c in S.FEATURE_COLUMNS}
    cols.update(vals)
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} long" for c in cols))


def test_score_hand_checked(spark):
    # scores: 5 (enabled, hit), 7 (enabled, not hit), 8 (disabled, hit) -> 28.3333
    cfg = spark.createDataFrame([
        ("F", 20.0, "a", "ip", 0, 1.0, 0.0, 5),
        ("F", 20.0, "b", "userAgent", 0, 1.0, 0.0, 7),
        ("F", 20.0, "c", "criticalPages", 1, 1.0, 0.0, 8)], CFG)
    f = _features(spark, ip_count=2, ua_distinct=1, critical_count=2)
    r = S.flow_scores(f, cfg).first()
    assert abs(r["flow_score"] - 28.333333) < 1e-5
    assert r["over_limit"] and r["hit_rules"] == ["a", "c"]


def test_score_zero_when_nothing_hits(spark):
    # 2.J-26: no NaN (Spark would order NaN above every limit)
    cfg = spark.createDataFrame([("F", 0.0, "a", "ip", 0, 5.0, 0.0, 5)], CFG)
    r = S.flow_scores(_features(spark, ip_count=1), cfg).first()
    assert r["flow_score"] == 0.0 and not r["over_limit"] and r["hit_rules"] == []


def test_arg1_threshold_for_fast_repeats(spark):
    # 2.J-24: criticalPagesLessThanDefault uses arg1
    cfg = spark.createDataFrame([("F", 1.0, "a", "criticalPagesLessThanDefault", 0, 100.0, 2.0, 9)], CFG)
    r = S.flow_scores(_features(spark, fast_repeats=3), cfg).first()
    assert r["hit_rules"] == ["a"]


def test_compiled_equals_relational(spark):
    cfg = spark.createDataFrame([
        ("F", 10.0, "a", "ip", 0, 1.0, 0.0, 5), ("F", 10.0, "b", "userAgent", 1, 0.0, 0.0, 3),
        ("G", 5.0, "c", "ipBlock", 0, 2.0, 0.0, 4)], CFG)
    feats = spark.createDataFrame(
        [(k, ip, ua, blk) for k, (ip, ua, blk) in enumerate([(0, 0, 0), (2, 1, 3), (5, 0, 1), (1, 2, 9)])],
        "k long, ip_count long, ua_distinct long, block_count long")
    for c in S.FEATURE_COLUMNS:
        if c not in feats.columns:
            feats = feats.withColumn(c, F.lit(0).cast("long"))
    a = S.flow_scores(feats, cfg).select("k", "flow_id", F.round("flow_score", 6).alias("s"), "hit_rules")
    hits = S.rule_hits(feats, ["k"], cfg)
    b = S.flow_scores_relational(hits, ["k"], cfg).select("k", "flow_id", F.round("flow_score", 6).alias("s"),
                                                          "hit_rules")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_hits_of_a_rule_and_scores_of_a_flow_are_many_tasks_work(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "100")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    feats = session.range(4000).repartition(16).select(
        F.col("id").alias("k"), *[((F.col("id") + i) % 50 * 1000000).alias(c) for i, c in enumerate(S.FEATURE_COLUMNS)])
    config = R.flow_config(R.fixture_rules(session))  # a join, whose size Spark doesn't know
    hits = S.rule_hits(feats, ["k"], config)
    rules = config.collect()
    got = hits.filter("hit").withColumn("at", F.spark_partition_id()).collect()
    at = list(S.INDICATOR_COLUMNS)
    want = [(k, r.flow_id, r.rule_id, float(v), r.rule_score) for k in range(4000) for r in rules
            if (v := (k + S.FEATURE_COLUMNS.index(S.INDICATOR_COLUMNS[r.indicator])) % 50 * 1000000)
            > (r.arg1 if r.indicator == at[-1] else r.arg0)]
    assert sorted((h.k, h.flow_id, h.rule_id, h.value, h.s) for h in got) == sorted(want)
    assert min(len({h["at"] for h in got if h.rule_id == r.rule_id}) for r in rules) == 16
    scores = S.flow_scores_relational(hits, ["k"], config).withColumn("at", F.spark_partition_id()).collect()
    assert len(scores) == 4000 * 2
    assert min(len({s["at"] for s in scores if s.flow_id == f}) for f in ("P1", "P2")) > 50


def test_latest_per_key_and_restore(spark):
    t = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    h = spark.createDataFrame([
        (t, "k1", "v1", "2024010111"), (t + dt.timedelta(hours=1), "k1", "v2", "2024010112"),
        (t + dt.timedelta(hours=1), "k1", "v3", "2024010112"), (t, "k2", "w", "2024010111"),
        (t - dt.timedelta(hours=3), "k3", "old", "2024010108")],
        "expire_at timestamp, key string, value string, hour string")
    latest = {r["key"]: r["value"] for r in B.latest_per_key(h).collect()}
    assert latest == {"k1": "v3", "k2": "w", "k3": "old"}  # one row per key, ties -> greatest value
    now = F.lit(t - dt.timedelta(minutes=30))
    store = spark.createDataFrame([("k2",)], "key string")
    assert sorted(r["key"] for r in B.restore(h, store, now).collect()) == ["k1"]
