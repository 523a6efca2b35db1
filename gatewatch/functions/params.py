"""Request parameter and JSON extraction.

Parameter lists are ``array<struct<k, v>>``; a lookup takes the last occurrence of a
key, like the reference's mutable map. Keys may be columns (rule-supplied).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatewatch.functions.text import lookup, url_decode


def query_string(request: Column) -> Column:
    """C14: text between the first ``?`` and the next one; NULL without a ``?``."""
    return F.try_element_at(F.split(request, r"\?"), F.lit(2))


def param_pairs(qs: Column, decode: bool = False) -> Column:
    """``a=1&b=2`` -> array<struct<k, v>>. As Java ``split("=")``: the value is the
    second ``=``-separated part, and a pair needs some non-empty part after the key."""
    parts = F.split(qs, "&")
    kept = F.filter(parts, lambda p: p.rlike("=.*[^=]"))
    def pair(p):
        v = F.try_element_at(F.split(p, "="), F.lit(2))
        return F.struct(F.substring_index(p, "=", 1).alias("k"),
                        (url_decode(v) if decode else v).alias("v"))
    return F.transform(kept, pair)


def get_params(request: Column) -> Column:
    """C14: GET parameters, values not decoded."""
    return param_pairs(query_string(request), decode=False)


def form_params(body: Column) -> Column:
    """Form body parameters, values URL-decoded (C4)."""
    return param_pairs(body, decode=True)


def param(pairs: Column, key) -> Column:
    return lookup(pairs, key)


def json_field(json: Column, path) -> Column:
    """JsonPath read; NULL on bad JSON or a missing path. Non-string values
    come back as their JSON text (fix 2.J-14). ``path`` may be a column."""
    if not isinstance(path, Column):
        return F.get_json_object(json, path) if path else F.lit(None).cast("string")
    return F.when(F.length(path) > 0, F.call_function("get_json_object", json, path))


def json_list(json: Column, path) -> Column:
    """Array read; a scalar becomes a one-element array. A ``[*]`` path that matches
    one node comes back as that node's JSON text (a string still in quotes), so it is
    read as the only element of an array."""
    v = json_field(json, path)
    text = path if isinstance(path, Column) else F.lit(path or "")
    lone = F.from_json(F.concat(F.lit("["), v, F.lit("]")), "array<string>")
    return (F.when(v.startswith("["), F.from_json(v, "array<string>"))
            .when(v.isNotNull() & (F.instr(text, "[*]") > 0), F.coalesce(lone, F.array(v)))
            .when(v.isNotNull(), F.array(v)))


def json_in_form(body: Column, field) -> Column:
    """C17: the form field ``field`` (URL-decoded) of a POST body, holding JSON."""
    return param(form_params(body), field)


def strip_brackets(json: Column) -> Column:
    """One enclosing ``[ ]`` removed; empty text -> NULL (fix 2.J-15)."""
    return F.when(F.length(json) == 0, F.lit(None).cast("string")).otherwise(
        F.regexp_replace(json, r"^\[(.*)\]$", "$1"))


def strip_escaped_quotes(json: Column) -> Column:
    """Literal ``\\x22`` sequences removed before parsing."""
    return F.replace(json, F.lit("\\x22"), F.lit(""))


def json_to_map(json: Column) -> Column:
    """Top-level object -> map<string,string>; empty map on failure."""
    return F.coalesce(F.from_json(json, "map<string,string>"), F.create_map().cast("map<string,string>"))
