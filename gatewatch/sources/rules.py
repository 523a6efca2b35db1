"""Rule tables.

Rules are ordinary tables. ``fixture_rules`` builds the literal rule set used by the
registered queries (FIXTURES.md); ``read_rules`` loads the same tables from parquet,
CSV or JDBC. All rule tables are small configuration tables; operators that broadcast
or collect them treat them as configuration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.config import Tables

FILTER_RULE_SCHEMA = "type string, value string"
CLASSIFY_RULE_SCHEMA = "flight_type int, operation_type int, expression string"
IP_BLACKLIST_SCHEMA = "ip_name string, ip_frequency int"
CRITICAL_PAGE_SCHEMA = "expression string"
PROCESS_INFO_SCHEMA = "id string, process_name string, status int"
STRATEGY_SCHEMA = "id string, crawler_blacklist_thresholds double, occ_blacklist_thresholds double"
RULE_SCHEMA = ("id string, process_id string, rule_name string, rule_type string, status int, "
               "crawler_type int, arg0 double, arg1 double, score int")
RULE_NAME_SCHEMA = "rule_name string, rule_real_name string"

QUERY_FIELDS = ("depcity", "arrcity", "flightdate", "adultnum", "childnum",
                "infantnum", "country", "traveltype")
# The booking columns of the rule table in its own order; the last one is ours.
BOOK_FIELDS = ("bookuserid", "bookunuserid", "psgname", "psgtype", "idtype", "idcard",
               "contractname", "contractphone", "depcity", "arrcity", "flightdate", "cabin",
               "flightno", "psgfirname", "bookagent")
PARSE_RULE_SCHEMA = (
    "rule_order int, id string, flight_type int, behavior_type int, request_match string, "
    "request_method string, is_normal_get boolean, is_normal_form boolean, "
    "is_application_json boolean, is_text_xml boolean, is_json boolean, is_xml boolean, "
    "form_data_field string, "
    + ", ".join(f"query_{f} string" for f in QUERY_FIELDS) + ", "
    + ", ".join(f"book_{f} string" for f in BOOK_FIELDS))

# Indicator names a rule may refer to (fixed values).
INDICATORS = ("ipBlock", "ip", "criticalPages", "userAgent", "criticalPagesAccTime",
              "flightQuery", "criticalCookies", "criticalPagesLessThanDefault")
# The one indicator whose threshold is arg1 rather than arg0 (fixed value).
ARG1_INDICATOR = "criticalPagesLessThanDefault"

# ---- literal rule rows of the fixtures (ours, FIXTURES.md section 3) ----
FIXTURE_FILTER_RULES = [("0", "/static/.*"), ("1", "/health.*")]
FIXTURE_CLASSIFY_RULES = [
    (0, 0, "/air/search.*"),        # national query
    (0, 1, "/air/book.*"),          # national book
    (1, 0, "/air/intl/search.*"),   # international query
    (1, 1, "/air/intl/book.*"),     # international book
]
FIXTURE_CRITICAL_PAGES = [("/air/(intl/)?search.*",)]
FIXTURE_IP_BLACKLIST = [("10.8.1.8", 0), ("10.14.4.46", 0), ("10.7.0.7", 1), ("10.3.3.3", 0)]
FIXTURE_PROCESS_INFO = [("P1", "crawler", 0), ("P2", "hoarding", 0), ("P3", "offline", 1)]
FIXTURE_STRATEGY = [("P1", 25.0, 40.0), ("P2", 20.0, 30.0), ("P3", 50.0, 60.0)]
FIXTURE_RULE_NAMES = [
    ("R_IPBLOCK", "ipBlock"), ("R_IP", "ip"), ("R_CRIT", "criticalPages"),
    ("R_UA", "userAgent"), ("R_MINGAP", "criticalPagesAccTime"),
    ("R_TRIP", "flightQuery"), ("R_COOKIE", "criticalCookies"),
    ("R_FAST", "criticalPagesLessThanDefault"),
]
FIXTURE_RULES = [
    # id, process_id, rule_name, rule_type, status, crawler_type, arg0, arg1, score
    ("r1", "P1", "R_IP", "0", 0, 0, 3.0, 0.0, 6),
    ("r2", "P1", "R_CRIT", "0", 0, 0, 1.0, 0.0, 5),
    ("r3", "P1", "R_UA", "0", 0, 0, 2.0, 0.0, 4),
    ("r4", "P1", "R_TRIP", "0", 1, 0, 2.0, 0.0, 3),
    ("r5", "P1", "R_COOKIE", "0", 0, 0, 1.0, 0.0, 4),
    ("r6", "P2", "R_IPBLOCK", "0", 0, 0, 20.0, 0.0, 5),
    ("r7", "P2", "R_MINGAP", "0", 0, 0, 3600000.0, 0.0, 6),
    ("r8", "P2", "R_FAST", "0", 0, 0, 0.0, 0.0, 7),
    ("r9", "P2", "R_IP", "0", 1, 0, 2.0, 0.0, 2),
    ("r10", "P1", "R_IP", "0", 0, 1, 5.0, 0.0, 9),
    ("r11", "P3", "R_IP", "0", 0, 1, 1.0, 0.0, 9),
]


def _parse_rule_rows():
    # Query rules read GET parameters or JSON inside the form field ``q``;
    # book rules read JSON inside ``q``. Later rules win (rule_order).
    empty_q = {f: "" for f in QUERY_FIELDS}
    empty_b = {f: "" for f in BOOK_FIELDS}
    rows = []

    def add(order, rid, flight, behavior, match, method, flags, field, q=None, b=None):
        qq = dict(empty_q, **(q or {}))
        bb = dict(empty_b, **(b or {}))
        rows.append((order, rid, flight, behavior, match, method,
                     *flags, field,
                     *[qq[f] for f in QUERY_FIELDS], *[bb[f] for f in BOOK_FIELDS]))

    get = (True, False, False, False, False, False)
    json_in_form = (False, False, False, False, True, False)
    add(1, "q-get", 0, 0, "/air/search.*", "GET", get, "",
        q={"depcity": "dep", "arrcity": "arr", "flightdate": "date", "traveltype": "trip"})
    add(2, "qi-get", 1, 0, "/air/intl/search.*", "get", get, "",
        q={"depcity": "dep", "arrcity": "arr", "country": "arr"})
    add(3, "q-post", 0, 0, "/air/(intl/)?search.*", "POST", json_in_form, "q",
        q={"adultnum": "$.k", "depcity": "$.dep", "arrcity": "$.arr"})
    add(4, "q-get-any", 0, 0, "/air/.*search.*", "GET", get, "",
        q={"depcity": "dep", "arrcity": "arr", "adultnum": "adults"})
    add(5, "b-post", 0, 1, "/air/(intl/)?book.*", "POST", json_in_form, "q",
        b={"flightno": "$.k", "depcity": "$.dep", "arrcity": "$.arr", "contractphone": "$.phone",
           "idcard": "$.ids"})
    return rows


def _sql_literal(v, typ: str) -> str:
    if v is None:
        return f"CAST(NULL AS {typ})"
    if typ == "boolean":
        return "TRUE" if v else "FALSE"
    if typ in ("int", "bigint", "double"):
        return f"CAST({v!r} AS {typ})"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small literal table as a ``VALUES`` relation: it lives in the plan (a local
    relation), so reading, collecting or broadcasting it needs no Python worker and
    no task."""
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    names = [n.strip() for n, _ in fields]
    types = [t.strip() for _, t in fields]
    if not rows:
        return spark.createDataFrame([], schema)
    body = ", ".join("(" + ", ".join(_sql_literal(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def fixture_rules(spark: SparkSession) -> Tables:
    def c(rows, schema):
        return local_table(spark, rows, schema)
    return Tables(
        filter_rule=c(FIXTURE_FILTER_RULES, FILTER_RULE_SCHEMA),
        classify_rule=c(FIXTURE_CLASSIFY_RULES, CLASSIFY_RULE_SCHEMA),
        parse_rule=c(_parse_rule_rows(), PARSE_RULE_SCHEMA),
        ip_blacklist=c(FIXTURE_IP_BLACKLIST, IP_BLACKLIST_SCHEMA),
        critical_page=c(FIXTURE_CRITICAL_PAGES, CRITICAL_PAGE_SCHEMA),
        process_info=c(FIXTURE_PROCESS_INFO, PROCESS_INFO_SCHEMA),
        strategy=c(FIXTURE_STRATEGY, STRATEGY_SCHEMA),
        rule=c(FIXTURE_RULES, RULE_SCHEMA),
        rule_name=c(FIXTURE_RULE_NAMES, RULE_NAME_SCHEMA),
    )


RULE_TABLES = {
    "filter_rule": FILTER_RULE_SCHEMA, "classify_rule": CLASSIFY_RULE_SCHEMA,
    "parse_rule": PARSE_RULE_SCHEMA, "ip_blacklist": IP_BLACKLIST_SCHEMA,
    "critical_page": CRITICAL_PAGE_SCHEMA, "process_info": PROCESS_INFO_SCHEMA,
    "strategy": STRATEGY_SCHEMA, "rule": RULE_SCHEMA, "rule_name": RULE_NAME_SCHEMA,
}


# Table names of the rule database, and the columns named otherwise than ours.
DATABASE_TABLES = {
    "filter_rule": "nh_filter_rule", "classify_rule": "nh_classify_rule", "parse_rule": "analyzerule",
    "ip_blacklist": "nh_ip_blacklist", "critical_page": "nh_query_critical_pages",
    "process_info": "nh_process_info", "strategy": "nh_strategy", "rule": "nh_rule",
    "rule_name": "nh_rules_maintenance_table",
}
DATABASE_COLUMNS = {
    "critical_page": {"expression": "criticalPageMatchExpression"},
    "parse_rule": {
        "request_match": "requestMatchExpression", "request_method": "requestMethod",
        "is_normal_get": "isNormalGet", "is_normal_form": "isNormalForm",
        "is_application_json": "isApplicationJson", "is_text_xml": "isTextXml",
        "is_json": "isJson", "is_xml": "isXML", "form_data_field": "formDataField",
    },
}


def from_database(name: str, df: DataFrame) -> DataFrame:
    """A table of the rule database in our names and types: text booleans and numbers
    are cast, ``query_*`` and ``book_*`` columns match without regard to case, columns that
    the database lacks are empty. Parse rules keep the table's row order (later rules win)."""
    have = {c.lower(): c for c in df.columns}
    if name == "parse_rule":
        df = df.withColumn("rule_order", F.monotonically_increasing_id())
        have["rule_order"] = "rule_order"
    cols = []
    for field in RULE_TABLES[name].split(","):
        ours, kind = field.strip().rsplit(" ", 1)
        theirs = have.get(DATABASE_COLUMNS.get(name, {}).get(ours, ours).lower())
        value = F.trim(F.col(theirs).cast("string")) if theirs and kind != "string" else F.col(theirs) if theirs else F.lit(None)
        value = value.try_cast(kind)
        cols.append((F.coalesce(value, F.lit(False)) if kind == "boolean" else value).alias(ours))
    return df.select(*cols)


def read_rules(spark: SparkSession, base: str, fmt: str = "parquet",
               jdbc: dict | None = None) -> Tables:
    """A3: load every rule table from ``base/<name>`` (parquet / csv), from ``base/<table>`` of
    CSV exports of the rule database (``database_csv``: its own table and column names) or
    from that database over JDBC (``jdbc`` = options with url, user, password)."""
    out = Tables()
    for name, schema in RULE_TABLES.items():
        if jdbc is not None:
            df = from_database(name, spark.read.format("jdbc").options(**jdbc).option("dbtable", DATABASE_TABLES[name]).load())
        elif fmt == "database_csv":
            df = from_database(name, spark.read.option("header", True).csv(f"{base}/{DATABASE_TABLES[name]}"))
        elif fmt == "csv":
            df = spark.read.schema(schema).option("header", True).csv(f"{base}/{name}")
        else:
            df = spark.read.parquet(f"{base}/{name}")
        setattr(out, name, df)
    return out


def write_rules(tables: Tables, base: str) -> None:
    for name in RULE_TABLES:
        getattr(tables, name).write.mode("overwrite").parquet(f"{base}/{name}")


# ---- A4-A11 rule selections ----

def url_filter_rules(filter_rule: DataFrame) -> DataFrame:
    """A4: URL regexes of type '0'."""
    return filter_rule.filter(F.col("type") == "0").select(F.col("value").alias("expression"))


def rules_by_class(classify_rule: DataFrame) -> DataFrame:
    """A5: the four classification rule lists in one read (nq, nb, iq, ib)."""
    label = (F.when((F.col("flight_type") == 0) & (F.col("operation_type") == 0), "nq")
             .when((F.col("flight_type") == 0) & (F.col("operation_type") == 1), "nb")
             .when((F.col("flight_type") == 1) & (F.col("operation_type") == 0), "iq")
             .when((F.col("flight_type") == 1) & (F.col("operation_type") == 1), "ib"))
    return (classify_rule.withColumn("class", label).filter(F.col("class").isNotNull())
            .groupBy("class").agg(F.array_sort(F.collect_list("expression")).alias("expressions")))


def parse_rules(parse_rule: DataFrame, behavior_type: int) -> DataFrame:
    """Parse rules of one behaviour (0 query, 1 book), in rule order."""
    return parse_rule.filter(F.col("behavior_type") == behavior_type)


def high_frequency_ips(ip_blacklist: DataFrame) -> DataFrame:
    """Listed addresses with ``ip_frequency = 0``."""
    return ip_blacklist.filter(F.col("ip_frequency") == 0).select("ip_name").distinct()


def all_listed_ips(ip_blacklist: DataFrame) -> DataFrame:
    """Every listed address."""
    return ip_blacklist.select("ip_name").distinct()


def flows(process_info: DataFrame, strategy: DataFrame, n: int = 0) -> DataFrame:
    """Process join strategy, processes with ``status = n``; the limit is the
    crawler threshold for n = 0 and the occupancy threshold for n = 1."""
    limit = "crawler_blacklist_thresholds" if n == 0 else "occ_blacklist_thresholds"
    return (process_info.filter(F.col("status") == n)
            .join(strategy, "id")
            .select(F.col("id").alias("flow_id"), F.col("process_name").alias("flow_name"),
                    F.col(limit).cast("double").alias("flow_limit"),
                    F.col("id").alias("strategy_code")))


def flow_rules(rule: DataFrame, rule_name: DataFrame, n: int = 0) -> DataFrame:
    """Rule join rule names (real indicator name), crawler type n, all flows at once."""
    return (rule.join(rule_name, "rule_name")
            .filter(F.col("crawler_type") == n)
            .select(F.col("id").alias("rule_id"), F.col("process_id").alias("flow_id"),
                    F.col("rule_real_name").alias("indicator"), "rule_type",
                    F.col("status").alias("rule_status"), "crawler_type",
                    F.col("arg0").cast("double").alias("arg0"),
                    F.col("arg1").cast("double").alias("arg1"),
                    F.col("score").cast("int").alias("rule_score")))


def flow_config(tables: Tables, n: int = 0) -> DataFrame:
    """Flows with their rules, one row per (flow, rule)."""
    return flows(tables.process_info, tables.strategy, n).join(
        flow_rules(tables.rule, tables.rule_name, n), "flow_id")
