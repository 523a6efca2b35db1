"""Joins against rule tables: IP membership, regex anti-join.

No broadcast is forced: Spark broadcasts a side below its byte threshold, known from
the files' statistics or measured by adaptive execution, and shuffles beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.regex import collect_patterns, matches_any

def flag_listed_ip(df: DataFrame, listed: DataFrame, ip_col: str = "remote_addr",
                   out: str = "high_freq", keys: DataFrame | None = None) -> DataFrame:
    """Flag rows whose address is listed (value equality, fix 2.J-10).
    ``keys`` may carry the prepared side (ip_name as ``__ip``, ``__hit``)."""
    if keys is None:
        keys = listed_side(listed)
    return (df.join(keys, df[ip_col] == keys["__ip"], "left")
            .withColumn(out, F.coalesce(F.col("__hit"), F.lit(False)))
            .drop("__ip", "__hit"))


def listed_ip_semi(df: DataFrame, listed: DataFrame, ip_col: str = "remote_addr") -> DataFrame:
    """keep only rows whose address is listed."""
    keys = listed.select(F.col("ip_name").alias("__ip"))
    return df.join(keys, df[ip_col] == keys["__ip"], "left_semi")


def listed_side(listed: DataFrame) -> DataFrame:
    """The listed addresses as the right side of ``flag_listed_ip``."""
    return listed.select(F.col("ip_name").alias("__ip")).distinct().withColumn("__hit", F.lit(True))


def regex_anti_join(df: DataFrame, rules: DataFrame, col: str = "request",
                    rule_col: str = "expression") -> DataFrame:
    """Drop rows that match any rule of a table. A join on ``rlike`` could only be a
    nested loop of rows and rules, so the rules' patterns become one expression."""
    hit = matches_any(F.col(col), collect_patterns(rules, rule_col))
    return df.filter(~F.coalesce(hit, F.lit(False)))
