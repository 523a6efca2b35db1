"""XML field extraction.

Spark's ``xpath*`` functions need literal paths, so rule-supplied paths are unrolled
into one ``CASE`` branch per (rule, path), built from the collected parse rules.
Malformed XML would fail the task inside ``xpath``; every read is guarded by a
PERMISSIVE ``from_xml`` parse, and only well-formed documents are evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trip-type codes of the XML segment element (fixed values): S one way, R round trip.
SEGTYPE = {"S": "OneWay", "R": "RoundTrip"}


def well_formed(xml: Column) -> Column:
    """True for text ``from_xml`` parses without a corrupt-record marker."""
    parsed = F.from_xml(xml, "`_c` string, `_corrupt_record` string",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return (F.length(F.trim(xml)) > 0) & F.trim(xml).startswith("<") & parsed.isNotNull() \
        & parsed["_corrupt_record"].isNull()


def from_page(xml: Column) -> Column:
    """C20: the document from the first ``<page>`` element on; NULL when absent (fix 2.J-16)."""
    i = F.instr(xml, "<page>")
    return F.when(i > 0, F.substring(xml, i, 1 << 30))


def document(xml: Column) -> Column:
    """The text if it is well formed, else NULL: tested once for all reads of a document."""
    return F.when(well_formed(xml), xml)


def text_at(doc: Column, path: str) -> Column:
    """Text of the first node at a literal path of a ``document``."""
    return F.xpath_string(doc, F.lit(path))


def nodes_at(doc: Column, path: str) -> Column:
    """Text of every node at a literal path of a ``document``, in document order."""
    return F.xpath(doc, F.lit(path))


def xml_text(xml: Column, path: str) -> Column:
    """C20 / C22 scalar read: text of the first node at a literal path."""
    return F.when(well_formed(xml), text_at(xml, path))


def xml_nodes(xml: Column, path: str) -> Column:
    """Text of every node at a literal path, in document order."""
    return F.when(well_formed(xml), nodes_at(xml, path))


def xml_travel_type(xml: Column) -> Column:
    """//SEGTYPE/text() S -> OneWay, R -> RoundTrip, else Unknown."""
    seg = xml_text(xml, "//SEGTYPE/text()")
    out = F.lit("Unknown")
    for code, label in SEGTYPE.items():
        out = F.when(seg == code, F.lit(label)).otherwise(out)
    return out


def contact_name(v: Column) -> Column:
    """Contact name is the text before the first ``|`` (whole value without one)."""
    return F.substring_index(v, "|", 1)


def contact_phone(v: Column) -> Column:
    """Contact phone is the text before the first ``/``."""
    return F.substring_index(v, "/", 1)


def by_rule(rule_id: Column, rules: list, field: str, read) -> Column:
    """Unroll a rule-supplied literal path: CASE rule_id WHEN r THEN read(path_r) ..."""
    expr = None
    for r in rules:
        path = r[field]
        if not path:
            continue
        branch = read(path)
        expr = F.when(rule_id == r["id"], branch) if expr is None else expr.when(rule_id == r["id"], branch)
    return expr if expr is not None else F.lit(None)
