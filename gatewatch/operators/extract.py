"""Parse-rule match and request extraction.

C12 picks, per record, the last rule (``rule_order``) with the same method (any case),
the same behaviour and a whole-string match of the request. The match is a ``CASE``
over the collected rule rows; the matched rule's row is then joined back as data on its
id, so every extraction below
reads rule-supplied keys and JsonPaths from columns. XPath needs literal paths, so
only XML rules are unrolled into per-rule branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions import params as P
from gatewatch.functions import xml as X
from gatewatch.functions.classify import BEHAVIOR
from gatewatch.functions.masking import hash_list
from gatewatch.functions.regex import anchored
from gatewatch.functions.text import md5_upper
from gatewatch.sources.rules import QUERY_FIELDS

def collect_parse_rules(parse_rule: DataFrame) -> list:
    return sorted(parse_rule.collect(), key=lambda r: (r["rule_order"] if r["rule_order"] is not None else 0, r["id"]))


def matched_rule(rules: list, method: Column, behavior_id: Column, request: Column) -> Column:
    """Id of the last matching rule; NULL when none."""
    groups: dict = {}
    for r in reversed(rules):
        hit = request.rlike(anchored(r["request_match"]))
        key = ((r["request_method"] or "").lower(), r["behavior_type"])
        own = groups.get(key)
        groups[key] = F.when(hit, F.lit(r["id"])) if own is None else own.when(hit, F.lit(r["id"]))
    # one test of method and behaviour picks the rules whose patterns are tried
    expr = None
    for (m, behavior), own in groups.items():
        c = (F.lower(method) == m) & (behavior_id == F.lit(behavior))
        expr = F.when(c, own) if expr is None else expr.when(c, own)
    return expr if expr is not None else F.lit(None).cast("string")


def rule_side(parse_rule: DataFrame) -> DataFrame:
    """The parse-rule table as the right side of ``attach_rule``."""
    return parse_rule.select(*[F.col(c).alias(f"pr_{c}") for c in parse_rule.columns])


def attach_rule(df: DataFrame, parse_rule: DataFrame, rule_col: str = "matched_rule",
                side: DataFrame | None = None) -> DataFrame:
    """Join the matched rule's row (columns prefixed ``pr_``) by id; unmatched records keep
    NULL rule columns."""
    r = side if side is not None else rule_side(parse_rule)
    return df.join(r, df[rule_col] == r["pr_id"], "left")


def _pr(name: str) -> Column:
    return F.col(f"pr_{name}")


def query_branch(content_type: Column, body: Column) -> Column:
    """C13 dispatch for the joined rule: get / form / json_form / xml / json_body."""
    m = F.upper(_pr("request_method"))
    post = m == "POST"
    return (F.when((m == "GET") & _pr("is_normal_get"), F.lit("get"))
            .when(post & _pr("is_normal_form"), F.lit("form"))
            .when(post & ~_pr("is_normal_form") & _pr("is_json") & (F.length(_pr("form_data_field")) > 0),
                  F.lit("json_form"))
            .when(post & (F.lower(content_type) == "text/xml") & _pr("is_text_xml") & _pr("is_xml")
                  & (F.length(body) > 0), F.lit("xml"))
            .when(post & (F.lower(content_type) == "application/json") & _pr("is_application_json")
                  & _pr("is_json"), F.lit("json_body")))


def book_branch(content_type: Column, body: Column) -> Column:
    """C21 dispatch for the joined rule: xml / json_body / json_form."""
    nf = ~_pr("is_normal_form")
    return (F.when((F.lower(content_type) == "text/xml") & _pr("is_text_xml") & _pr("is_xml")
                   & (F.length(body) > 0), F.lit("xml"))
            .when((F.lower(content_type) == "application/json") & nf & _pr("is_application_json")
                  & _pr("is_json") & (F.length(body) > 0), F.lit("json_body"))
            .when(nf & _pr("is_json") & ~_pr("is_application_json")
                  & (F.length(_pr("form_data_field")) > 0), F.lit("json_form")))


def _xml_case(rules: list, behavior: int, field: str, doc: Column, read) -> Column:
    expr = None
    for r in rules:
        if r["behavior_type"] != behavior or not (r["is_text_xml"] and r["is_xml"]) or not r[field]:
            continue
        v = read(doc, r[field])
        expr = F.when(_pr("id") == r["id"], v) if expr is None else expr.when(_pr("id") == r["id"], v)
    return expr if expr is not None else F.lit(None)


def apply_steps(df: DataFrame, steps) -> DataFrame:
    """Apply a list of ``{name: Column}`` projections, then drop helper columns."""
    cols, drop = steps
    for st in cols:
        df = df.withColumns(st)
    return df.drop(*drop)


def query_steps(rules: list, request: str = "request", content_type: str = "content_type",
                body: str = "request_body", flight_id: Column = None,
                referer_travel_id: Column = None, out: str = "query"):
    """The projections of ``with_query_request``; Columns reference input columns by
    name only, so the steps are built once per rule version and reused per batch."""
    ct, b = F.col(content_type), F.col(body)
    qb = F.col("__qb")
    steps = [{"__qb": F.when(_pr("behavior_type") == BEHAVIOR["Query"], query_branch(ct, b))}]
    steps.append({
        "__qpairs": F.when(qb == "get", P.get_params(F.col(request))).when(qb == "form", P.form_params(b)),
        "__qjson": F.when(qb == "json_form", P.json_in_form(b, _pr("form_data_field")))
                    .when(qb == "json_body", b),
        "__qxml": F.when(qb == "xml", X.document(X.from_page(b))),
    })

    def read(f):
        key = _pr(f"query_{f}")
        return (F.when(qb.isin("get", "form"), P.param(F.col("__qpairs"), key))
                .when(qb.isin("json_form", "json_body"), P.json_field(F.col("__qjson"), key))
                .when(qb == "xml",
                      _xml_case(rules, BEHAVIOR["Query"], f"query_{f}", F.col("__qxml"), X.text_at)))

    fields = [f for f in QUERY_FIELDS if f != "traveltype"]
    steps.append({f"__q_{f}": F.coalesce(read(f).cast("string"), F.lit("")) for f in fields})
    tkey = _pr("query_traveltype")
    travel_req = F.when(F.length(F.trim(tkey)) > 0,
                        F.coalesce(F.trim(read("traveltype")).try_cast("int"), F.lit(-1)))
    travel = F.when(travel_req >= 0, travel_req).otherwise(referer_travel_id)
    filled = F.when(qb.isin("get", "form"), F.size(F.col("__qpairs")) > 0).otherwise(F.lit(True))
    any_value = F.greatest(*[F.length(F.col(f"__q_{f}")) for f in fields]) > 0
    st = F.struct((~(filled & any_value)).alias("is_empty"), flight_id.alias("flight_type"),
                  *[F.col(f"__q_{f}").alias(f) for f in fields],
                  travel.cast("int").alias("travel_type"))
    steps.append({out: F.when(qb.isNotNull() | (_pr("behavior_type") == BEHAVIOR["Query"]), st)})
    return steps, ["__qb", "__qpairs", "__qjson", "__qxml", *[f"__q_{f}" for f in fields]]


def with_query_request(df: DataFrame, rules: list, request: str = "request",
                       content_type: str = "content_type", body: str = "request_body",
                       flight_id: Column = None, referer_travel_id: Column = None,
                       out: str = "query") -> DataFrame:
    """C13 + C16/C17/C19/C20 over records joined to their rule (``attach_rule``):
    the query struct; NULL unless a query rule matched (fix 2.J-13)."""
    return apply_steps(df, query_steps(rules, request, content_type, body, flight_id,
                                       referer_travel_id, out))


def book_steps(rules: list, content_type: str = "content_type", body: str = "request_body",
               referer_travel_id: Column = None, out: str = "book"):
    """The projections of ``with_book_request`` (built once per rule version)."""
    ct, b = F.col(content_type), F.col(body)
    bb = F.col("__bb")
    steps = [{"__bb": F.when(_pr("behavior_type") == BEHAVIOR["Book"], book_branch(ct, b))}]
    steps.append({"__bdoc": F.when(bb == "json_body", P.strip_escaped_quotes(b))
                  .when(bb == "json_form", P.strip_escaped_quotes(
                      P.strip_brackets(P.json_in_form(b, _pr("form_data_field")))))
                  .when(bb == "xml", X.document(X.from_page(b)))})
    doc = F.col("__bdoc")

    def read_list(f):
        return (F.when(bb == "xml", _xml_case(rules, BEHAVIOR["Book"], f"book_{f}", doc, X.nodes_at))
                .otherwise(P.json_list(doc, _pr(f"book_{f}"))).cast("array<string>"))

    def read_one(f, post=None):
        x = _xml_case(rules, BEHAVIOR["Book"], f"book_{f}", doc, X.text_at)
        if post is not None:
            x = post(x)
        return F.when(bb == "xml", x).otherwise(P.json_field(doc, _pr(f"book_{f}"))).cast("string")

    lists = ("flightno", "depcity", "arrcity", "flightdate", "cabin", "psgname", "psgfirname",
             "psgtype", "idtype", "idcard")
    steps.append({f"__b_{f}": read_list(f) for f in lists})
    last, first = F.col("__b_psgname"), F.col("__b_psgfirname")
    psgname = F.when(first.isNull(), last).otherwise(
        F.zip_with(first, last, lambda a, c: F.concat(F.coalesce(a, F.lit("")), F.coalesce(c, F.lit("")))))
    flight = F.when(_pr("flight_type").isin(0, 1), _pr("flight_type"))
    st = F.struct(
        flight.cast("int").alias("flight_type"),
        F.when(flight.isNotNull(), referer_travel_id).cast("int").alias("travel_type"),
        *[F.col(f"__b_{f}").alias(f) for f in ("flightno", "depcity", "arrcity", "flightdate", "cabin")],
        psgname.alias("psgname"), F.col("__b_psgtype").alias("psgtype"),
        F.col("__b_idtype").alias("idtype"), hash_list(F.col("__b_idcard")).alias("idcard"),
        read_one("contractname", X.contact_name).alias("contractname"),
        md5_upper(read_one("contractphone", X.contact_phone)).alias("contractphone"),
        read_one("bookagent").alias("bookagent"),
        read_one("bookuserid").alias("bookuserid"), read_one("bookunuserid").alias("bookunuserid"))
    steps.append({out: F.when(_pr("behavior_type") == BEHAVIOR["Book"], st)})
    return steps, ["__bb", "__bdoc", *[f"__b_{f}" for f in lists]]


def with_book_request(df: DataFrame, rules: list, content_type: str = "content_type",
                      body: str = "request_body", referer_travel_id: Column = None,
                      out: str = "book") -> DataFrame:
    """C21-C24 + C33: the book struct; contact phone and id numbers hashed (NULL stays
    NULL, fix 2.J-17); NULL unless a book rule matched."""
    return apply_steps(df, book_steps(rules, content_type, body, referer_travel_id, out))


def core_field(query: Column, book: Column, f: str) -> Column:
    """The query value when non-empty, else the book list concatenated."""
    q = F.nullif(query[f], F.lit(""))
    b = F.nullif(F.array_join(book[f], ""), F.lit(""))
    return F.coalesce(q, b)


def drop_rule(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("pr_")])
