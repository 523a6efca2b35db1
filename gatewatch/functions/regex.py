"""Whole-string regex matching against rule tables.

The reference tests ``String.matches`` (whole string) rule by rule. Spark's
``rlike`` finds a substring, so every rule is anchored with ``\\A(?:...)\\z``
(``^...$`` would still accept a trailing newline). N rules are folded into one
alternation: one compiled pattern per task instead of N passes.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A rule that refers to a group by number or name, or names one, keeps its own pattern:
# in an alternation its groups would be renumbered and names would clash.
_OWN_GROUPS = re.compile(r"\\[1-9k]|\(\?<[A-Za-z]|\\Q")


def anchored(pattern: str) -> str:
    return r"\A(?:" + pattern + r")\z"


def fold(patterns) -> str | None:
    pats = [p for p in patterns if p is not None and p != ""]
    if not pats:
        return None
    return r"\A(?:" + "|".join(f"(?:{p})" for p in pats) + r")\z"


def collect_patterns(rules: DataFrame, column: str = "expression") -> list[str]:
    """Pull a rule column to the driver, where its patterns are compiled: rule tables are
    configuration that people write, and every one of them takes the same path."""
    return sorted({r[0] for r in rules.select(column).distinct().collect() if r[0]})


def matches_any(col: Column, patterns) -> Column:
    """True when ``col`` matches any pattern as a whole string (NULL input -> NULL)."""
    plain = [p for p in patterns if p and not _OWN_GROUPS.search(p)]
    own = [p for p in patterns if p and _OWN_GROUPS.search(p)]
    tests = [col.rlike(anchored(p)) for p in own]
    if plain:
        tests.insert(0, col.rlike(fold(plain)))
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def matches_whole(col: Column, pattern_col: Column) -> Column:
    """Row-wise whole-string match against a pattern held in a column (join form)."""
    return F.call_function("rlike", col, F.concat(F.lit(r"\A(?:"), pattern_col, F.lit(r")\z")))
