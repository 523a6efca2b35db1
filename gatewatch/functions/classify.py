"""Request labels (C10, C11) and the enum encodings (section 1.3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatewatch.functions.regex import matches_any

# Enum labels and ids - fixed values of the reference.
FLIGHT = {"National": 0, "International": 1, "Other": -1}
BEHAVIOR = {"Query": 0, "Book": 1, "Other": -1}
TRAVEL = {"OneWay": 0, "RoundTrip": 1, "Unknown": -1}

# Date form counted in referer query values (month and day 00 accepted, 2.J-39).
REFERER_DATE = r"\A(\d{4})-(0\d{1}|1[0-2])-(0\d{1}|[12]\d{1}|3[01])\z"


def label_to_id(label: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(label == k, F.lit(v)) if expr is None else expr.when(label == k, F.lit(v))
    return expr


def request_class(request: Column, patterns: dict) -> Column:
    """Nq, nb, iq, ib or NULL. Classes are tested in that order and a later match
    overwrites, so priority is ib > iq > nb > nq. ``patterns`` maps class -> list of regexes
    (from ``rules_by_class``)."""
    label = F.lit(None).cast("string")
    for cls in ("nq", "nb", "iq", "ib"):
        label = F.when(matches_any(request, patterns.get(cls, [])), F.lit(cls)).otherwise(label)
    return label


def classify_request(request: Column, patterns: dict) -> Column:
    """struct(flight_type, behavior_type) labels of the class; none -> Other/Other."""
    label = request_class(request, patterns)
    # the class is found once per row (aggregate over a one-element array binds it), then
    # mapped to both labels
    def labels(c):
        flight = F.when(c.startswith("i"), "International").when(c.startswith("n"), "National").otherwise("Other")
        behavior = F.when(c.endswith("b"), "Book").when(c.endswith("q"), "Query").otherwise("Other")
        return F.struct(flight.alias("flight_type"), behavior.alias("behavior_type"))

    return F.get(F.transform(F.array(label), labels), F.lit(0))


def referer_query(referer: Column) -> Column:
    """Query part of a URL (after the first ``?``, before ``#``), NULL when absent."""
    return F.when(F.instr(referer, "?") > 0,
                  F.regexp_extract(referer, r"\?([^#]*)", 1))


def travel_type(referer: Column) -> Column:
    """C11: count referer query values of the form yyyy-MM-dd; 1 -> OneWay,
    2 -> RoundTrip, else Unknown."""
    q = referer_query(referer)
    # a value is the decoded text after a parameter's first '=' up to the next '&'
    def dated(p):
        return (F.instr(p, "=") > 0) & F.coalesce(
            F.try_url_decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))).rlike(REFERER_DATE), F.lit(False))

    n = F.coalesce(F.size(F.filter(F.split(q, "&"), dated)), F.lit(0))
    return F.when(n == 1, F.lit("OneWay")).when(n == 2, F.lit("RoundTrip")).otherwise(F.lit("Unknown"))
