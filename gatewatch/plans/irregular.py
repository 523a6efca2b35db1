"""Queries over the irregular lines (``sources.irregular``) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.config import FIXTURE_WINDOW
from gatewatch.functions import wire as W
from gatewatch.operators import features as fe
from gatewatch.operators import ingest as I
from gatewatch.plans import enrich_job, score_job
from gatewatch.plans.context import Ctx
from gatewatch.sources.irregular import irregular_lines, irregular_tables


def _lines(c: Ctx) -> DataFrame:
    return irregular_lines(c.dealt_events())


def _booked(c: Ctx) -> DataFrame:
    return enrich_job.enrich_lines(_lines(c), irregular_tables(c.spark))


def irregular_cookies(spark, sf_dir):
    """The last readable pair wins, escapes, control characters, spaces."""
    return I.timed(I.parse_access_log(_lines(Ctx(spark, sf_dir)))).select("event_id", "jsession_id", "cookie_user_id")


def irregular_rejects(spark, sf_dir):
    """Short lines and unreadable times, with the reason."""
    return I.reject_rows(_lines(Ctx(spark, sf_dir))).select("event_id", "n_fields", "reason")


def irregular_trips(spark, sf_dir):
    """C11: percent-encoded dates in the referer."""
    from gatewatch.functions.classify import travel_type
    a = I.timed(I.parse_access_log(_lines(Ctx(spark, sf_dir))))
    return a.select("event_id", travel_type(F.col("http_referer")).alias("travel_type"))


def _booking(kind):
    def q(spark, sf_dir):
        p = _booked(Ctx(spark, sf_dir)).filter(F.col("matched_rule") == kind)
        b = F.col("book")
        return p.select("event_id", b["bookuserid"].alias("user_id"), b["bookunuserid"].alias("un_user_id"),
                        F.array_join(b["psgname"], ",").alias("names"), F.array_join(b["idcard"], ",").alias("id_hashes"),
                        b["contractname"].alias("contact"), b["contractphone"].alias("phone_hash"))
    return q


def unknown_address_counts(spark, sf_dir):
    """C36 + E2: records without an address keep the key NULL through the wire format."""
    p = _booked(Ctx(spark, sf_dir))
    back = W.parse(W.serialize(p).select("value"))
    recs = score_job.indicator_records(back, irregular_tables(spark))
    g = fe.ip_counts(recs, FIXTURE_WINDOW).filter(F.col("ip") == "NULL")
    return g.select(F.unix_micros("window_end").alias("window_end_us"), "ip", "ip_count")


QUERIES = {
    "irregular_cookies": irregular_cookies, "irregular_rejects": irregular_rejects, "irregular_trips": irregular_trips,
    "book_user_ids": _booking("json"), "book_xml_body": _booking("xml"), "unknown_address_counts": unknown_address_counts,
}

_OK = "event_id % 11 <> 0 AND event_id % 13 <> 0"
_H, _K = FIXTURE_WINDOW.slide_us, FIXTURE_WINDOW.panes
ORACLES = {
    "irregular_cookies": f"""SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN 'good' || event_id WHEN 1 THEN chr(20013) || 'a' || chr(9) || 'b'
       WHEN 2 THEN ' v' || event_id || '=w ' END AS jsession_id,
  CASE event_id % 6 WHEN 3 THEN 'a b c' END AS cookie_user_id FROM events WHERE {_OK}""",
    "irregular_rejects": """SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 11 ELSE 12 END AS n_fields,
  CASE WHEN event_id % 13 = 0 THEN 'width' ELSE 'time' END AS reason
  FROM events WHERE event_id % 11 = 0 OR event_id % 13 = 0""",
    "irregular_trips": f"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'OneWay' WHEN 1 THEN 'RoundTrip' ELSE 'Unknown' END
  AS travel_type FROM events WHERE {_OK}""",
    "book_user_ids": f"""SELECT event_id, 'U' || event_id AS user_id, '7' AS un_user_id,
  CASE event_id % 3 WHEN 0 THEN 'A1B1' WHEN 1 THEN 'A1B1,A2B2' END AS names,
  CASE event_id % 3 WHEN 0 THEN upper(md5('x' || event_id || '-1'))
       WHEN 1 THEN upper(md5('x' || event_id || '-1')) || ',' || upper(md5('x' || event_id || '-2')) END AS id_hashes,
  NULL::VARCHAR AS contact, upper(md5('123')) AS phone_hash FROM events WHERE {_OK} AND event_id % 2 = 0""",
    # every third XML body is malformed and gives no fields
    "book_xml_body": f"""SELECT event_id, CASE WHEN event_id % 3 < 2 THEN 'U' || event_id END AS user_id, NULL::VARCHAR AS un_user_id,
  CASE event_id % 3 WHEN 0 THEN 'B1' WHEN 1 THEN 'B1,B2' END AS names,
  CASE event_id % 3 WHEN 0 THEN upper(md5('x' || event_id || '-1'))
       WHEN 1 THEN upper(md5('x' || event_id || '-1')) || ',' || upper(md5('x' || event_id || '-2')) END AS id_hashes,
  CASE WHEN event_id % 3 < 2 THEN 'name' END AS contact, CASE WHEN event_id % 3 < 2 THEN upper(md5('123')) END AS phone_hash
  FROM events WHERE {_OK} AND event_id % 2 = 1""",
    "unknown_address_counts": f"""SELECT (epoch_us(date_trunc('second', ts)) // {_H} + 1 + i.range) * {_H} AS window_end_us,
  'NULL' AS ip, count(*) AS ip_count FROM events, range({_K}) i WHERE {_OK} AND event_id % 7 = 0 GROUP BY ALL""",
}
