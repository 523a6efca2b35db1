"""Whole-string regex rules against many values by an index of necessary literals.

A folded alternation tries N rules on every row. Here each rule gives the literals one of
which any match must contain; a literal is looked up by the one of its q-grams that is
rarest in the data, and a value's q-grams meet that table in an equi-join. Only the pairs
that meet are tested, first for the literal and then by the rule's own pattern, so the tests
made follow the matches and not values times rules. Rules without a literal of q characters
are folded as before.

Each distinct value is evaluated once, whatever the number of its rows. Of up to ``FEW_RULES``
rules the grams are broadcast by Spark if they are below its byte threshold; those of more rules
meet the values in joins that shuffle by gram, so that nothing which grows with the rules
passes through the driver."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.literals import necessary_literals
from gatewatch.functions.regex import anchored, collect_patterns, matches_any, matches_whole
from gatewatch.session import materialize, ship_code

Q = 4
FEW_RULES = 5_000


def grams(text: Column, q: int = Q) -> Column:
    """Distinct q-grams of a string."""
    chars = F.split(text, "")
    at = F.when(F.size(chars) >= q, F.sequence(F.lit(0), F.size(chars) - q))
    return F.array_distinct(F.transform(at, lambda i: F.concat(*[F.get(chars, i + k) for k in range(q)])))


def _with_literals(rules: DataFrame, rule_id: str, pattern: str, q: int) -> DataFrame:
    """(rule_id, pattern, literals) of the usable rules; no literals: the rule is to be folded."""
    ship_code(rules.sparkSession)

    @F.pandas_udf("array<string>")
    def literals(patterns: pd.Series) -> pd.Series:
        return patterns.map(lambda p: necessary_literals(p, q))

    usable = rules.filter(F.col(pattern).isNotNull() & (F.col(pattern) != ""))
    return usable.select(F.col(rule_id).alias("rule_id"), F.col(pattern).alias("pattern"), literals(F.col(pattern)).alias("literals"))


def candidates(values: DataFrame, rules: DataFrame, q: int = Q) -> DataFrame:
    """Distinct (value, rule_id, pattern) whose value contains the literal's rarest gram and
    the literal. ``values``: distinct ``value``; ``rules``: as from ``_with_literals``, written."""
    few = rules.limit(FEW_RULES + 1).count() <= FEW_RULES

    def side(df: DataFrame) -> DataFrame:
        return df if few else df.hint("merge")

    lit = rules.select("rule_id", "pattern", F.explode("literals").alias("literal"))
    found = values.select("value", F.explode(grams(F.col("value"), q)).alias("gram"))
    mine = lit.select("literal").distinct().select("literal", F.explode(grams(F.col("literal"), q)).alias("gram"))
    seen = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).join(side(mine.select("gram").distinct()), "gram")
    # a gram that no value has rules its literals out: they get no row
    rarest = (mine.join(side(seen), "gram", "left").groupBy("literal").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
              .filter("r.n > 0").select("literal", "r.gram"))
    index = lit.join(side(rarest), "literal")
    near = found.join(side(index), "gram").filter(F.contains(F.col("value"), F.col("literal")))
    return near.select("value", "rule_id", "pattern").distinct()


def rule_hits(df: DataFrame, rules: DataFrame, col: str = "request", rule_id: str = "rule_id", pattern: str = "expression",
              q: int = Q) -> DataFrame:
    """(value, rule_id): every distinct value of ``col`` with the rules it matches as a whole.
    Null values and null or empty patterns match nothing."""
    known = materialize(_with_literals(rules, rule_id, pattern, q), "rule_literals")
    values = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    near = candidates(values, known.filter(F.size("literals") > 0), q)
    hits = near.filter(matches_whole(F.col("value"), F.col("pattern"))).select("value", "rule_id")
    rest = known.filter(F.size("literals") == 0).select("rule_id", "pattern").collect()  # written by people, as all rules
    if rest:
        kind = known.schema["rule_id"].dataType
        tests = [F.when(F.col("value").rlike(anchored(r["pattern"])), F.lit(r["rule_id"]).cast(kind)) for r in rest]
        plain = values.select("value", F.explode(F.array_compact(F.array(*tests))).alias("rule_id"))
        hits = hits.unionByName(plain)
    return hits.distinct()


def regex_anti_join(df: DataFrame, rules: DataFrame, col: str = "request", pattern: str = "expression", q: int = Q) -> DataFrame:
    """Rows of ``df`` that match no rule as a whole: the indexed form of the folded anti-join.
    Rows with a null value stay."""
    known = materialize(_with_literals(rules, pattern, pattern, q), "rule_literals")
    rest = known.filter(F.size("literals") == 0)
    folded = matches_any(F.col("value"), collect_patterns(rest, "pattern"))
    values = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    near = candidates(values, known.filter(F.size("literals") > 0), q)
    hit = near.filter(matches_whole(F.col("value"), F.col("pattern"))).select("value")
    hit = reduce(DataFrame.unionByName, [hit, values.filter(folded)]).distinct().withColumnRenamed("value", "__hit")
    return df.join(hit, F.col(col) == F.col("__hit"), "left_anti")


def evaluations(df: DataFrame, rules: DataFrame, col: str = "request", rule_id: str = "rule_id", pattern: str = "expression", q: int = Q) -> dict:
    """What the index saves: distinct values, rules, and patterns evaluated (candidates, plus
    the unindexed rules on every value) against values times rules."""
    known = materialize(_with_literals(rules, rule_id, pattern, q), "rule_literals")
    values = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    n_values, n_rules, n_rest = values.count(), known.count(), known.filter(F.size("literals") == 0).count()
    near = candidates(values, known.filter(F.size("literals") > 0), q).count()
    return {"values": n_values, "rules": n_rules, "unindexed": n_rest, "evaluated": near + n_rest * n_values, "pairs": n_values * n_rules}
