"""A second access-log adapter over the driver's ``events``: the irregular lines that the
first one does not hold (cookie errors, escapes, unreadable times, short lines, encoded
dates, missing addresses, JSON and XML bookings of one and two passengers). Which case a
line is follows from its event id, so DuckDB derives the same expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.config import FIELD_SEP, Tables
from gatewatch.sources import rules as R

JSON_RULE = {"bookuserid": "$.u", "bookunuserid": "$.w", "psgname": "$.p[*].l", "psgfirname": "$.p[*].f",
             "idcard": "$.p[*].id", "contractphone": "$.tel"}
XML_RULE = {"bookuserid": "/page/U/text()", "psgname": "//N/text()", "idcard": "//I/text()",
            "contractname": "/page/C/text()", "contractphone": "/page/T/text()"}


def irregular_tables(spark: SparkSession) -> Tables:
    """The fixture rules with two parse rules for bookings: a JSON and an XML body."""
    t = R.fixture_rules(spark)
    flags = {"json": "false, false, true, false, true, false", "xml": "false, false, false, true, false, true"}
    paths = {"json": JSON_RULE, "xml": XML_RULE}
    rows = []
    for i, kind in enumerate(("json", "xml")):
        book = ", ".join(f"'{paths[kind].get(f, '')}'" for f in R.BOOK_FIELDS)
        query = ", ".join("''" for _ in R.QUERY_FIELDS)
        rows.append(f"({i}, '{kind}', 0, 1, '/air/book/{kind}.*', 'POST', {flags[kind]}, '', {query}, {book})")
    names = [c.strip().rsplit(" ", 1)[0] for c in R.PARSE_RULE_SCHEMA.split(",")]
    t.parse_rule = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({', '.join(names)})")
    return t


def irregular_lines(events: DataFrame) -> DataFrame:
    """event_id and ``value``: the raw lines."""
    e = F.col("event_id")
    s, lit = e.cast("string"), F.lit
    cat = F.concat

    def passenger(n):
        return cat(lit('{"f":"A'), lit(n), lit('","l":"B'), lit(n), lit('","id":"x'), s, lit(f'-{n}"}}'))

    cookie = F.when(e % 6 == 0, cat(lit("JSESSIONID=good"), s, lit(";JSESSIONID=%zz")))\
        .when(e % 6 == 1, lit("JSESSIONID=%u4E2Da\tb"))\
        .when(e % 6 == 2, cat(lit(" JSESSIONID = v"), s, lit("=w ;x")))\
        .when(e % 6 == 3, lit("userId4logCookie=a%20b+c"))\
        .when(e % 6 == 4, lit("JSESSIONID=;JSESSIONID")).otherwise(lit(""))
    referer = F.when(e % 5 == 0, lit("http://h.example/p?go=2024%2D02%2D01"))\
        .when(e % 5 == 1, lit("http://h.example/p?go=2024-02-01&back=2024%2d02%2d03#x"))\
        .when(e % 5 == 2, lit("http://h.example/p?go=2024-02-01%zz"))\
        .when(e % 5 == 3, lit("http://h.example/p?go=+2024-02-01"))\
        .otherwise(lit("http://h.example/p?a=2024-02-01&b=2024-02-02&c=2024-02-03"))
    people = F.when(e % 3 == 0, cat(lit(',"p":['), passenger("1"), lit("]")))\
        .when(e % 3 == 1, cat(lit(',"p":['), passenger("1"), lit(","), passenger("2"), lit("]"))).otherwise(lit(""))
    json = cat(lit('{"u":"U'), s, lit('","w":7'), people, lit(',"tel":"123"}'))
    xml_people = F.when(e % 3 == 0, cat(lit("<P><N>B1</N><I>x"), s, lit("-1</I></P>")))\
        .when(e % 3 == 1, cat(lit("<P><N>B1</N><I>x"), s, lit("-1</I></P><P><N>B2</N><I>x"), s, lit("-2</I></P>"))).otherwise(lit("<P>"))
    xml = cat(lit("xml=<page><U>U"), s, lit("</U>"), xml_people, lit("<C>name|x</C><T>123/4</T></page>"))
    is_json = e % 2 == 0
    ts = F.col("ts").cast("timestamp")
    fields = [
        F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"), F.when(is_json, lit("/air/book/json")).otherwise(lit("/air/book/xml")), lit("POST"),
        F.when(is_json, lit("application/json")).otherwise(lit("text/xml")), F.when(is_json, json).otherwise(xml), referer,
        F.when(e % 7 == 0, lit("")).otherwise(cat(lit("10.1.1."), (e % 4).cast("string"))), lit("UA"),
        F.when(e % 11 == 0, lit("yesterday")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")), lit("192.168.1.1"), cookie]
    short = F.concat_ws(FIELD_SEP, *fields)
    return events.select("event_id", F.when(e % 13 == 0, short).otherwise(cat(short, lit(FIELD_SEP + "1"))).alias("value"))
