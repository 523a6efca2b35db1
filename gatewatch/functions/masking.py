"""Masking personal data by hash.

Each distinct match of a pattern is replaced, everywhere in the string, by the
uppercase MD5 of the match. Native higher-order functions, no UDF:
``aggregate(array_distinct(regexp_extract_all(s, P, 0)), s, (acc, m) -> replace(acc, m, md5(m)))``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatewatch.functions.text import md5_upper

# Mainland mobile numbers and resident id numbers - fixed patterns of the reference,
# with digit lookarounds so a longer digit run is never masked in part (fixes 2.J-3..5, 7).
PHONE_PATTERN = r"(?<![0-9])(?:13[0-9]|14[57]|15[0-35-9]|17[0-9]|18[0-9])[0-9]{8}(?![0-9])"
ID_PATTERN = r"(?<![0-9])(?:[0-9]{18}|[0-9]{17}[Xx]|[0-9]{15})(?![0-9Xx])"


def mask_matches(c: Column, pattern: str) -> Column:
    matches = F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)))
    # the array fold only runs on rows holding a match; the rest pass through
    return F.when(c.rlike(pattern), F.aggregate(matches, c, lambda acc, m: F.replace(acc, m, md5_upper(m)))
                  ).otherwise(c)


def mask_ids(c: Column, pattern: str = ID_PATTERN) -> Column:
    """Id numbers (18 digits, 17 + X, 15 digits)."""
    return mask_matches(c, pattern)


def mask_phones(c: Column, pattern: str = PHONE_PATTERN) -> Column:
    """Mobile numbers."""
    return mask_matches(c, pattern)


def mask_pii(c: Column, id_pattern: str = ID_PATTERN, phone_pattern: str = PHONE_PATTERN) -> Column:
    """C9 then C8: ids first, so an 11-digit run inside an id is not taken for a phone
    (fix 2.J-6)."""
    return mask_phones(mask_ids(c, id_pattern), phone_pattern)


def hash_list(c: Column) -> Column:
    """MD5 of each element of an array (NULL elements stay NULL)."""
    return F.transform(c, lambda x: md5_upper(x))
