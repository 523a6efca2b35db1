"""Scalar column functions: cookies, decoding, hashing, whitespace.

All are native Spark expressions (higher-order functions over arrays), so they stay
inside whole-stage codegen; no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cookie keys of the session id and the user id (fixed values).
SESSION_COOKIE = "JSESSIONID"
USER_COOKIE = "userId4logCookie"


def md5_upper(c: Column) -> Column:
    """Uppercase hex MD5 of the whole UTF-8 string (fix 2.J-9); NULL stays NULL."""
    return F.upper(F.md5(c.cast("string")))


def url_decode(c: Column) -> Column:
    """C4: UTF-8 percent-decoding with ``+`` as space; malformed input -> NULL."""
    return F.try_url_decode(c)


def unescape(c: Column) -> Column:
    """``%uXXXX`` -> that UTF-16 unit, ``%XX`` -> the Latin-1 character, other text
    unchanged. Rewritten into a JSON string literal and decoded by ``from_json``, which is
    told to take control characters as they are."""
    s = F.regexp_replace(c, r"\\", r"\\\\")
    s = F.regexp_replace(s, '"', '\\\\"')
    s = F.regexp_replace(s, r"%u([0-9a-fA-F]{4})", r"\\u$1")
    s = F.regexp_replace(s, r"%([0-9a-fA-F]{2})", r"\\u00$1")
    return F.from_json(F.concat(F.lit('{"v":"'), s, F.lit('"}')), "v string",
                       {"allowUnquotedControlChars": "true"})["v"]


def cookie_pairs(cookie: Column) -> Column:
    """``k=v;k=v`` -> array<struct<k, v>>. A pair needs a non-empty value; the key is
    trimmed; the value is everything after the first ``=`` (fix 2.J-2), decoded with
    ``unescape`` when it holds ``u`` + 4 hex digits, else URL-decoded. A pair whose
    decoding fails is dropped."""
    parts = F.split(cookie, ";")
    pairs = F.transform(parts, lambda p: F.struct(
        F.trim(F.substring_index(p, "=", 1)).alias("k"),
        F.when(F.instr(p, "=") > 0, F.substring(p, F.instr(p, "=") + 1, 1 << 30)).alias("raw")))
    decoded = F.transform(pairs, lambda s: F.struct(
        s["k"].alias("k"), decode_cookie_value(s["raw"]).alias("v")))
    return F.filter(decoded, lambda s: s["v"].isNotNull() & (F.length(s["v"]) > 0))


def lookup(pairs: Column, key) -> Column:
    """Value of ``key`` in an array<struct<k, v>>; the last occurrence wins; NULL if absent."""
    key_col = key if isinstance(key, Column) else F.lit(key)
    hit = F.filter(pairs, lambda s: s["k"] == key_col)
    return F.try_element_at(hit, F.lit(-1))["v"]


def decode_cookie_value(raw: Column) -> Column:
    """C2 value decoding: ``unescape`` when the value holds ``u`` + 4 hex digits,
    else URL-decoding."""
    return F.when(raw.rlike("u[0-9a-fA-F]{4}"), unescape(raw)).otherwise(url_decode(raw))


def cookie_value(cookie: Column, key: str) -> Column:
    """C2 + C5 for one literal key: the value ``lookup`` finds in ``cookie_pairs``. Only the
    parts of that key are decoded."""
    own = F.filter(F.split(cookie, ";"), lambda p: F.trim(F.substring_index(p, "=", 1)) == key)
    return lookup(cookie_pairs(F.array_join(own, ";")), key)


def session_id(cookie: Column) -> Column:
    """JSESSIONID from the cookie (NULL when absent)."""
    return cookie_value(cookie, SESSION_COOKIE)


def user_id(cookie: Column) -> Column:
    """userId4logCookie from the cookie (NULL when absent)."""
    return cookie_value(cookie, USER_COOKIE)


def strip_whitespace(c: Column) -> Column:
    """Remove NUL, spaces, tabs, CR and LF."""
    return F.regexp_replace(c, r"[\x00\s]+", "")
