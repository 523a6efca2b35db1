"""Rule-table operators (A4-A11, F3, F4) and the checked broadcast."""

from gatewatch.sources import rules as R


def test_rules_by_class(spark):
    t = R.fixture_rules(spark)
    got = {r["class"]: list(r["expressions"]) for r in R.rules_by_class(t.classify_rule).collect()}
    assert got == {"nq": ["/air/search.*"], "nb": ["/air/book.*"],
                   "iq": ["/air/intl/search.*"], "ib": ["/air/intl/book.*"]}


def test_flows_use_the_threshold_of_their_kind(spark):
    # 2.J-33: flows of status 1 read the occupancy threshold
    t = R.fixture_rules(spark)
    f0 = {r["flow_id"]: r["flow_limit"] for r in R.flows(t.process_info, t.strategy, 0).collect()}
    f1 = {r["flow_id"]: r["flow_limit"] for r in R.flows(t.process_info, t.strategy, 1).collect()}
    assert f0 == {"P1": 25.0, "P2": 20.0}
    assert f1 == {"P3": 60.0}


def test_flow_rules_join_names_and_crawler_type(spark):
    t = R.fixture_rules(spark)
    fr = R.flow_rules(t.rule, t.rule_name, 0).collect()
    assert {r["rule_id"] for r in fr} == {f"r{i}" for i in range(1, 10)}
    assert {r["indicator"] for r in fr if r["rule_id"] == "r8"} == {"criticalPagesLessThanDefault"}
    cfg = R.flow_config(t, 0).collect()
    assert {(r["flow_id"], r["rule_id"]) for r in cfg if r["flow_id"] == "P2"} == {
        ("P2", "r6"), ("P2", "r7"), ("P2", "r8"), ("P2", "r9")}


def test_url_filter_and_ip_lists(spark):
    t = R.fixture_rules(spark)
    assert [r[0] for r in R.url_filter_rules(t.filter_rule).collect()] == ["/static/.*"]
    assert {r[0] for r in R.high_frequency_ips(t.ip_blacklist).collect()} == {"10.8.1.8", "10.14.4.46", "10.3.3.3"}
    assert R.all_listed_ips(t.ip_blacklist).count() == 4


def test_rules_round_trip_through_files(spark, tmp_path):
    t = R.fixture_rules(spark)
    R.write_rules(t, str(tmp_path / "rules"))
    back = R.read_rules(spark, str(tmp_path / "rules"))
    assert sorted(map(tuple, back.rule.collect())) == sorted(map(tuple, t.rule.collect()))
