"""Quality rules: a bitmask ledger.

Every rule is evaluated once per text. The ledger stores the measurements and one failure
bit per rule; a policy is a versioned set of rules, so applying it is one bitwise AND, and
what a rule alone removes (its ablation) is counted from a table of distinct masks.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words and fail the length rule.
An empty table gives no rows, and repeated rows get equal entries; other columns are kept, but
those named as measurements or ``failed`` are replaced. Texts are measured whole, one at a time,
with a few arrays of one number per word. A measurement equal to a rule's bound does not fail.

Repeated windows are found by doubling: ids of 1, 2, 4 and 8 consecutive words, exact at
each step, so no hash decides; a text with no repeated hash skips it."""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import ship_code

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _rules() -> dict[str, Column]:
    """Name -> true where the text fails. The position in this dict is the rule's bit."""
    n = F.col("n_words")
    return {
        "short": n < 20,
        "repeated": 100 * F.col("n_repeat_words") > 30 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "word_length_low": F.col("word_chars") < 2 * n,
        "word_length_high": F.col("word_chars") > 15 * n,
        "dup_lines": (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")) & (F.col("n_lines") > 0),
    }


RULES = ("short", "repeated", "symbols", "word_length_low", "word_length_high", "dup_lines")
#: Versioned policies: a text is kept if it fails none of the rules.
POLICIES = {
    "base": ("short", "repeated"),
    "v1": ("short", "repeated", "symbols", "word_length_low", "word_length_high"),
    "v2": ("short", "repeated", "symbols", "word_length_low", "word_length_high", "dup_lines"),
}
CURRENT = "v2"


def mask(rules) -> int:
    return sum(1 << RULES.index(r) for r in rules)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more (8: a power of two)."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    h = ids.astype(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = (mixed ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    s = np.sort(mixed)
    if not (s[1:] == s[:-1]).any():
        return 0
    code, width = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while width < window:
        pair = code[:-width] * (int(code.max()) + 1) + code[width:]
        code, width = np.unique(pair, return_inverse=True)[1].astype(np.int64), 2 * width
    start = np.flatnonzero(np.bincount(code)[code] > 1)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(raw: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word)."""
    words = raw.split()  # bytes: ASCII white space
    if not words:
        return 0, 0, sum(raw.count(c) for c in SYMBOLS.encode()), 0, 0, 0
    flat = np.frombuffer(raw, np.uint8)
    # code points: bytes that don't continue one; white space is ASCII
    chars = int(np.count_nonzero((flat & 0xC0) != 0x80)) - int(np.count_nonzero((flat == 32) | ((flat >= 9) & (flat <= 13))))
    symbols = sum(raw.count(c) for c in SYMBOLS.encode())
    lines = Counter(x for x in raw.split(b"\n") if x.strip())
    n_lines = sum(lines.values())
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return len(words), chars, symbols, n_lines - len(lines), repeated_words(ids), n_lines


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failed`` (the bitmask); columns of these names
    are replaced."""
    ship_code(docs.sparkSession)
    kinds = ", ".join(f"{m} long" for m in (*MEASURES, "n_lines"))

    @F.pandas_udf(kinds)
    def measured(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(x) for x in raw], columns=[*MEASURES, "n_lines"], dtype="int64")

    names = (*MEASURES, "n_lines")
    rows = docs.drop(*names, "failed", "__m").withColumn("__m", measured(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = rows.select("*", *[f"__m.{m}" for m in names]).drop("__m")
    rules = _rules()
    bits = [F.when(rules[r], 1 << i).otherwise(0) for i, r in enumerate(RULES)]
    return rows.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits))


def kept(failed: Column, policy: str = CURRENT) -> Column:
    return failed.bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, failing, only, kept_without): rows failing each rule of the policy, rows that no
    other rule of it removes, and rows kept if the rule were left out. Masks are counted first
    (at most 2 ** rules of them), so the ledger is read once and shuffles a few rows."""
    own = F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy])))
    masks = rows.groupBy(own.alias("m")).count()
    each = masks.select("m", "count", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).alias("bit")) for r in POLICIES[policy]])).alias("x"))
    m, bit, n = F.col("m"), F.col("x.bit"), F.col("count")
    add = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    return each.groupBy(F.col("x.rule").alias("rule")).agg(
        add(m.bitwiseAND(bit) != 0).alias("failing"), add(m == bit).alias("only"),
        add(m.bitwiseAND(F.bitwise_not(bit)) == 0).alias("kept_without"))
