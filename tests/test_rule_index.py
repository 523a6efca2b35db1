"""Necessary literals and the rule index built on them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gatewatch.functions.literals import necessary_literals as lits
from gatewatch.operators import lookup as L
from gatewatch.operators import rule_index as RI


@pytest.mark.parametrize("pattern,want", [
    ("/static/.*", ["/static/"]), (r"/a\.b\.html", ["/a.b.html"]), ("/air/(intl|dom)/x", ["/air/"]), ("(?:/book|/search).*", ["/book", "/search"]),
    ("abcd?e", ["abc"]), ("abcd*", ["abc"]), ("abcd+e", ["abcd"]), ("abc{0,2}defg", ["defg"]), ("abc{2}defg", ["defg"]), ("ab|cdef", []),
    ("x[abcd]yyyy", ["yyyy"]), ("x[]abcd]yyyy", ["yyyy"]), ("x[^]a]yyyy", ["yyyy"]), ("[a[bcde]fghi]k", []), ("(?i)abcd", []), ("a(?i:bcde)f", []), (r"\Qabcd\E", []),
    (r"(abcd)\1", []), (r"\dabcd\w+xyz", ["abcd"]), (r"\x61bcd", []), ("(abcd)?efg", ["efg"]), ("(?!nope)abcd", ["abcd"]), ("(?=abcd).*", []),
    ("(?<name>abcd).*", ["abcd"]), ("(?<=abcd)x.*", []), ("(?<!abcd)x.*", []), ("((ab)cde|wxyz)+", ["cde", "wxyz"]), ("(abc", []), ("abc)", []), ("", []), (None, []),
    ("ab.cd", []), ("^abc$", ["abc"]), ("abc??def", ["def"]), ("abcd{1}efg", ["abcdefg"]), ("a|", []), ("été/abc", ["été/abc"]),
])
def test_necessary_literals(pattern, want):
    assert lits(pattern, 3) == want


def test_every_match_contains_a_literal():
    rng = random.Random(1)
    parts = ["ab", "c", "d?", "(ef|gh)", "(i|jk)?", "[xyz]", ".", "a+", "b*", "(?:ab|cd){0,2}", "(a(b|c)d)", r"\.", "(?=a)", "b{2}", "^", "$"]
    for _ in range(4000):
        pattern = "".join(rng.choice(parts + ["|"]) for _ in range(rng.randrange(1, 6)))
        found = lits(pattern, 1)
        if not found:
            continue
        rx = re.compile(pattern)
        for _ in range(12):
            s = "".join(rng.choice("abcdefghijkxyz.") for _ in range(rng.randrange(0, 8)))
            if rx.fullmatch(s):
                assert any(x in s for x in found), (pattern, s, found)


def _values(spark, n):
    return spark.range(n).select(F.concat(F.lit("/site"), F.col("id") % 400, F.lit("/page"), "id", F.when(F.col("id") % 3 == 0, ".html").otherwise("")).alias("request"))


def test_rule_hits_equal_every_rule_tried(spark):
    rules = [(i, f"/site{i}/.*") for i in range(60)] + [(100, r".*\.html"), (101, ".{16,}"), (102, "/site(1|2)[0-9]/.*"), (103, None), (104, ""), (105, "/nothing/here"),
             (106, r"/site(\d)\1/.*"), (107, "(?i)/SITE9/.*"), (108, "/site3/.*"), (109, "(/site7/|/site8/).*")]
    values = [r[0] for r in _values(spark, 900).collect()] + ["", "ab", "é/site3/", "/site3/\n", "/site3/x\n"]
    df = spark.createDataFrame([(v,) for v in values + values[:50] + [None]], "request string")
    got = {(r.value, r.rule_id) for r in RI.rule_hits(df, spark.createDataFrame(rules, "rule_id int, expression string")).collect()}
    want = {(v, i) for v in values for i, p in rules if p and re.fullmatch(p, v)}
    assert got == want


def test_index_anti_join_equals_folded_form(spark):
    rules = spark.createDataFrame([(f"/site{i}/.*",) for i in range(0, 300, 7)] + [(".{17,}",), (None,)], "expression string")
    df = _values(spark, 1500).unionByName(spark.createDataFrame([(None,), ("",)], "request string"))
    a, b = RI.regex_anti_join(df, rules), L.regex_anti_join(df, rules)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and 0 < a.count() < df.count()
    only = spark.createDataFrame([(".{17,}",)], "expression string")
    assert RI.regex_anti_join(df, only).count() == L.regex_anti_join(df, only).count()


def test_ten_thousand_rules_without_a_nested_loop(spark):
    rules = spark.range(10_000).select(F.col("id").alias("rule_id"), F.concat(F.lit("/site[0-9]+/page"), F.col("id") * 3, F.lit(r"(\.html)?")).alias("expression"))
    df = _values(spark, 3000)
    stats = RI.evaluations(df, rules)
    assert stats["rules"] == 10_000 and stats["unindexed"] == 0
    assert stats["evaluated"] < stats["pairs"] / 1000
    hits = RI.rule_hits(df, rules)
    assert hits.count() == 1000
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_many_rules_are_not_broadcast(spark, monkeypatch):
    urls = spark.createDataFrame([(f"/shop/item{i}/x",) for i in range(30)] + [(None,), ("/other",)], "request string")
    rules = spark.createDataFrame([(i, f"/shop/item{i}/.*") for i in range(20)] + [(99, None)], "rule_id long, expression string")
    few = sorted(map(tuple, RI.rule_hits(urls, rules).collect()))
    monkeypatch.setattr(RI, "FEW_RULES", 5)
    hits = RI.rule_hits(urls, rules)
    assert sorted(map(tuple, hits.collect())) == few and len(few) == 20
    assert "BroadcastHashJoin" not in hits._jdf.queryExecution().executedPlan().toString()
