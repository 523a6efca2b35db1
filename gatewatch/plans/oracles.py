"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code, in plain SQL over the driver's tables:
the access-log adapter of FIXTURES.md section 3, the fixture rules as VALUES lists,
windows by integer arithmetic on epoch microseconds (``range(k)`` for the k
windows that hold a row) and gaps with ``lag``.
"""

from __future__ import annotations

from gatewatch.config import FIXTURE_WINDOW
from gatewatch.sources import rules as R

H = FIXTURE_WINDOW.slide_us          # 6 hours
K = FIXTURE_WINDOW.panes             # 4 panes per 1-day window
FAST = FIXTURE_WINDOW.fast_repeat_ms
TTL = 3600

ORACLES: dict = {}


def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        return "'" + str(v).replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


FLOW_RULES = f"""
process_info(id, process_name, status) AS (VALUES {_values(R.FIXTURE_PROCESS_INFO)}),
strategy(id, crawler_t, occ_t) AS (VALUES {_values(R.FIXTURE_STRATEGY)}),
rule_t(id, process_id, rule_name, rule_type, status, crawler_type, arg0, arg1, score)
  AS (VALUES {_values(R.FIXTURE_RULES)}),
rule_name_t(rule_name, rule_real_name) AS (VALUES {_values(R.FIXTURE_RULE_NAMES)}),
flow_rules AS (
  SELECT p.id AS flow_id, CAST(s.crawler_t AS DOUBLE) AS flow_limit, r.id AS rule_id,
         n.rule_real_name AS indicator, r.status AS rule_status,
         CAST(r.arg0 AS DOUBLE) AS arg0, CAST(r.arg1 AS DOUBLE) AS arg1, r.score AS rule_score
  FROM process_info p JOIN strategy s ON p.id = s.id
  JOIN rule_t r ON r.process_id = p.id JOIN rule_name_t n ON n.rule_name = r.rule_name
  WHERE p.status = 0 AND r.crawler_type = 0)
"""

# access log of the adapter; lines with event_id % 50 = 0 are rejected by C1; the
# wire form keeps whole seconds of the event time.
ACCESS = """
access AS (
  SELECT event_id,
         date_trunc('second', ts) AS ts,
         CASE event_type WHEN 'view' THEN '/air/search' WHEN 'click' THEN '/air/intl/search'
              WHEN 'purchase' THEN '/air/book' WHEN 'signup' THEN '/air/intl/book'
              WHEN 'error' THEN '/static/err.js' ELSE '/' END
           || '?dep=C' || CAST(user_id % 5 AS VARCHAR) || '&arr=C' || CAST(event_id % 7 AS VARCHAR) AS request,
         CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS request_method,
         CASE WHEN event_id % 3 = 0 THEN 'application/x-www-form-urlencoded' ELSE 'text/html' END AS content_type,
         'q=' || props AS request_body,
         CASE WHEN event_id % 5 = 0 THEN 'http://h.example/p'
              ELSE 'http://h.example/p?go=2024-02-01' || CASE WHEN event_id % 2 = 0 THEN '&back=2024-02-09' ELSE '' END
         END AS referer,
         '10.' || CAST(user_id % 16 AS VARCHAR) || '.' || CAST(user_id % 7 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR) AS ip,
         'UA' || CAST(event_id % 11 AS VARCHAR) AS user_agent,
         '192.168.1.' || CAST(event_id % 4 AS VARCHAR) AS server_addr,
         's' || CAST(event_id % 13 AS VARCHAR) AS jsession_id,
         'u' || CAST(user_id AS VARCHAR) AS cookie_user_id,
         CAST(floor(value) AS INTEGER) AS connection_active,
         props, user_id, event_type
  FROM events WHERE event_id % 50 <> 0)
"""

# processed records: URL filter, classes, and the core fields. With the fixture rules
# only GET queries carry a departure / arrival (GET parameters dep, arr).
PROC = ACCESS + """,
kept AS (SELECT * FROM access WHERE NOT regexp_full_match(request, '/static/.*')),
proc AS (
  SELECT *,
    CASE WHEN regexp_full_match(request, '/air/intl/book.*') OR regexp_full_match(request, '/air/intl/search.*')
         THEN 'International'
         WHEN regexp_full_match(request, '/air/book.*') OR regexp_full_match(request, '/air/search.*')
         THEN 'National' ELSE 'Other' END AS flight_type,
    CASE WHEN regexp_full_match(request, '/air/intl/book.*') THEN 'Book'
         WHEN regexp_full_match(request, '/air/intl/search.*') THEN 'Query'
         WHEN regexp_full_match(request, '/air/book.*') THEN 'Book'
         WHEN regexp_full_match(request, '/air/search.*') THEN 'Query' ELSE 'Other' END AS behavior_type,
    CASE WHEN request_method = 'GET' AND regexp_full_match(request, '/air/(intl/)?search.*')
         THEN regexp_extract(request, '[?&]dep=([^&]*)', 1) END AS dep_city,
    CASE WHEN request_method = 'GET' AND regexp_full_match(request, '/air/(intl/)?search.*')
         THEN regexp_extract(request, '[?&]arr=([^&]*)', 1) END AS arr_city,
    upper(md5(jsession_id)) AS session_hash,
    upper(md5(cookie_user_id)) AS user_hash
  FROM kept),
recs AS (
  SELECT ip, request, user_agent, session_hash AS session_id, dep_city, arr_city, ts,
         regexp_full_match(request, '/air/(intl/)?search.*') AS critical,
         epoch_us(ts) AS t_us, epoch_us(ts) // 1000000 AS t_s,
         coalesce(dep_city, '') || chr(1) || coalesce(arr_city, '') AS trip
  FROM proc)
"""

WIN = PROC + f""",
recs_w AS (SELECT r.*, (r.t_us // {H} + 1 + i.range) * {H} AS we FROM recs r, range({K}) i)
"""

IPF = WIN + f""",
ipf_main AS (
  SELECT we, ip, count(*) AS ip_count,
         CAST(sum(CASE WHEN critical THEN 1 ELSE 0 END) AS BIGINT) AS critical_count,
         count(DISTINCT user_agent) AS ua_distinct,
         count(DISTINCT trip) AS trip_distinct,
         count(DISTINCT CASE WHEN critical THEN session_id END) AS session_distinct
  FROM recs_w GROUP BY we, ip),
ipf_gap AS (
  SELECT we, ip, CAST(min(gap) AS BIGINT) AS min_interval_ms FROM (
    SELECT we, ip, (t_s - lag(t_s) OVER (PARTITION BY we, ip ORDER BY t_s)) * 1000 AS gap
    FROM recs_w WHERE critical) GROUP BY we, ip),
ipf AS (SELECT m.*, g.min_interval_ms FROM ipf_main m LEFT JOIN ipf_gap g USING (we, ip)),
blk AS (SELECT we, split_part(ip, '.', 1) || CASE WHEN strpos(ip, '.') > 0 THEN '.' || split_part(ip, '.', 2) ELSE '' END AS ip_block,
               count(*) AS block_count FROM recs_w GROUP BY ALL),
fast AS (
  SELECT we, ip, request, CAST(count(*) FILTER (WHERE gap < {FAST}) AS BIGINT) AS fast_repeats FROM (
    SELECT we, ip, request, (t_s - lag(t_s) OVER (PARTITION BY we, ip, request ORDER BY t_s)) * 1000 AS gap
    FROM recs_w WHERE critical) GROUP BY ALL)
"""

SCORED = IPF + "," + FLOW_RULES + f""",
keys AS (SELECT DISTINCT (t_us // {H} + 1) * {H} AS we, ip, request FROM recs),
feats AS (
  SELECT k.we, k.ip, k.request,
    coalesce(b.block_count, 0) AS block_count, coalesce(f.ip_count, 0) AS ip_count,
    coalesce(f.critical_count, 0) AS critical_count, coalesce(f.ua_distinct, 0) AS ua_distinct,
    coalesce(f.min_interval_ms, 0) AS min_interval_ms, coalesce(f.trip_distinct, 0) AS trip_distinct,
    coalesce(f.session_distinct, 0) AS session_distinct, coalesce(x.fast_repeats, 0) AS fast_repeats
  FROM keys k
  LEFT JOIN ipf f ON f.we = k.we AND f.ip = k.ip
  LEFT JOIN blk b ON b.we = k.we AND b.ip_block = split_part(k.ip, '.', 1) || '.' || split_part(k.ip, '.', 2)
  LEFT JOIN fast x ON x.we = k.we AND x.ip = k.ip AND x.request = k.request),
feats_long AS (
  UNPIVOT (SELECT we, ip, request,
                  CAST(block_count AS DOUBLE) AS "x_ipBlock", CAST(ip_count AS DOUBLE) AS "x_ip",
                  CAST(critical_count AS DOUBLE) AS "x_criticalPages", CAST(ua_distinct AS DOUBLE) AS "x_userAgent",
                  CAST(min_interval_ms AS DOUBLE) AS "x_criticalPagesAccTime",
                  CAST(trip_distinct AS DOUBLE) AS "x_flightQuery",
                  CAST(session_distinct AS DOUBLE) AS "x_criticalCookies",
                  CAST(fast_repeats AS DOUBLE) AS "x_criticalPagesLessThanDefault" FROM feats)
  ON COLUMNS(* EXCLUDE (we, ip, request)) INTO NAME xname VALUE value),
hits AS (
  SELECT v.we, v.ip, v.request, fr.flow_id, fr.flow_limit, fr.rule_id, fr.rule_status, fr.indicator, v.value,
         v.value > CASE WHEN fr.indicator = 'criticalPagesLessThanDefault' THEN fr.arg1 ELSE fr.arg0 END AS hit
  FROM feats_long v JOIN flow_rules fr ON fr.indicator = substr(v.xname, 3)),
hits_s AS (SELECT *, CAST(CASE WHEN hit THEN rule_score ELSE 0 END AS DOUBLE) AS s
           FROM hits JOIN (SELECT rule_id, rule_score FROM flow_rules) USING (rule_id)),
agg AS (
  SELECT we, ip, request, flow_id, any_value(flow_limit) AS flow_limit, sum(s) AS tot, count(*) AS n,
         coalesce(sum(s) FILTER (WHERE rule_status = 0), 0) AS esum,
         coalesce(max(s) FILTER (WHERE rule_status = 0), 0) AS emax,
         coalesce(string_agg(rule_id, ',' ORDER BY rule_id) FILTER (WHERE hit), '') AS hit_rules
  FROM hits_s GROUP BY we, ip, request, flow_id),
scored AS (
  SELECT *, CASE WHEN tot = 0 THEN 0.0
                 ELSE tot / (10.0 * n) * (least(60.0, emax * 10.0) + 40.0 * esum / tot) END AS flow_score
  FROM agg),
scored2 AS (SELECT *, flow_score > flow_limit AS over_limit FROM scored),
dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY we, ip, flow_id
                                               ORDER BY flow_score DESC, request DESC) AS rn
                 FROM scored2 WHERE over_limit) WHERE rn = 1)
"""


def _with(prefix: str, body: str) -> str:
    return "WITH " + prefix.strip().lstrip(",") + "\n" + body


ORACLES["win_ip_count"] = _with(WIN, "SELECT we AS window_end_us, ip, count(*) AS ip_count FROM recs_w GROUP BY ALL")
ORACLES["win_ipblock_count"] = _with(IPF, "SELECT we AS window_end_us, ip_block, block_count FROM blk")
for q, col in [("win_critical_count", "critical_count"), ("win_ua_distinct", "ua_distinct"),
               ("win_trip_distinct", "trip_distinct"), ("win_session_distinct", "session_distinct")]:
    ORACLES[q] = _with(IPF, f"SELECT we AS window_end_us, ip, {col} FROM ipf")
ORACLES["win_min_interval"] = _with(IPF, "SELECT we AS window_end_us, ip, min_interval_ms FROM ipf "
                                         "WHERE min_interval_ms IS NOT NULL")
ORACLES["win_fast_repeats"] = _with(IPF, "SELECT we AS window_end_us, ip, request, fast_repeats FROM fast")
ORACLES["ip_features"] = _with(IPF, """SELECT we AS window_end_us, ip, ip_count, critical_count, ua_distinct,
  min_interval_ms, trip_distinct, session_distinct FROM ipf""")
ORACLES["ip_features_direct"] = ORACLES["ip_features"]
ORACLES["request_gaps"] = _with(PROC, """SELECT ip, t_us AS ts_us,
  (t_s - lag(t_s) OVER (PARTITION BY ip ORDER BY t_s, t_us)) * 1000 AS gap_ms FROM recs WHERE critical""")
ORACLES["critical_pages"] = _with(PROC, """SELECT request, bool_or(critical) AS critical, count(*) AS n
  FROM recs GROUP BY request""")
ORACLES["attach_features"] = _with(SCORED, """SELECT we AS window_end_us, ip, request, block_count, ip_count,
  critical_count, ua_distinct, min_interval_ms, trip_distinct, session_distinct, fast_repeats FROM feats""")
ORACLES["rule_hits"] = _with(SCORED, """SELECT we AS window_end_us, ip, request, flow_id, rule_id, indicator,
  value, CAST(s AS BIGINT) AS s FROM hits_s WHERE hit""")
ORACLES["flow_scores"] = _with(SCORED, """SELECT we AS window_end_us, ip, request, flow_id,
  round(flow_score, 6) AS flow_score, flow_limit, over_limit, hit_rules FROM scored2""")
ORACLES["blacklist_candidates"] = _with(SCORED, """SELECT DISTINCT we AS window_end_us, ip FROM scored2
  WHERE over_limit""")
ORACLES["dedupe_hits"] = _with(SCORED, """SELECT we AS window_end_us, ip, flow_id,
  round(flow_score, 6) AS flow_score, request FROM dedup""")
ENTRIES = _with(SCORED, f"""SELECT we AS window_end_us, ip, flow_id, round(flow_score, 6) AS flow_score,
  flow_limit, hit_rules, 'CSANTI_ANTI_BLACK' || ip || ':' || flow_id AS bl_key,
  printf('%.6f', flow_score) || '|' || printf('%.6f', flow_limit) || '|' || hit_rules || '|'
    || strftime(make_timestamp(we), '%Y-%m-%d %H:%M:%S') AS bl_value,
  we + CAST({TTL} AS BIGINT) * 1000000 AS expire_at_us FROM dedup""")
ORACLES["blacklist_entries"] = ENTRIES
ORACLES["score_job"] = ENTRIES


# ------------------------------------------------------------------ C: ingest, clean, label, extract

RAW = """
raw AS (
  SELECT event_id, ts, user_id, event_type, props, value,
    concat_ws('#CS#',
      strftime(ts, '%d/%b/%Y:%H:%M:%S'),
      CASE event_type WHEN 'view' THEN '/air/search' WHEN 'click' THEN '/air/intl/search'
           WHEN 'purchase' THEN '/air/book' WHEN 'signup' THEN '/air/intl/book'
           WHEN 'error' THEN '/static/err.js' ELSE '/' END
        || '?dep=C' || CAST(user_id % 5 AS VARCHAR) || '&arr=C' || CAST(event_id % 7 AS VARCHAR),
      CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END,
      CASE WHEN event_id % 3 = 0 THEN 'application/x-www-form-urlencoded' ELSE 'text/html' END,
      'q=' || props,
      CASE WHEN event_id % 5 = 0 THEN 'http://h.example/p'
           ELSE 'http://h.example/p?go=2024-02-01' || CASE WHEN event_id % 2 = 0 THEN '&back=2024-02-09' ELSE '' END END,
      '10.' || CAST(user_id % 16 AS VARCHAR) || '.' || CAST(user_id % 7 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR),
      'UA' || CAST(event_id % 11 AS VARCHAR),
      strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00'),
      '192.168.1.' || CAST(event_id % 4 AS VARCHAR),
      'JSESSIONID=s' || CAST(event_id % 13 AS VARCHAR) || ';userId4logCookie=u' || CAST(user_id AS VARCHAR)
    ) || CASE WHEN event_id % 50 = 0 THEN '' ELSE '#CS#' || CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS line
  FROM events)
"""

ORACLES["src_raw_log"] = _with(RAW, "SELECT event_id, line AS value FROM raw")
ORACLES["reject_rows"] = _with(RAW, """SELECT event_id, CAST(len(string_split(line, '#CS#')) AS INTEGER) AS n_fields
  FROM raw WHERE len(string_split(line, '#CS#')) <> 12""")
ORACLES["archive_union"] = _with(RAW, """SELECT event_id,
  CAST(CASE WHEN len(string_split(line, '#CS#')) <> 12 THEN 2 ELSE 1 END AS BIGINT) AS copies FROM raw""")
ORACLES["parse_access_log"] = _with(ACCESS, """SELECT event_id, request, request_method, content_type,
  ip AS remote_addr, user_agent AS http_user_agent, server_addr, connection_active, epoch_us(ts) AS ts_us FROM access""")
ORACLES["cookie_fields"] = _with(ACCESS, "SELECT event_id, jsession_id, cookie_user_id FROM access")
ORACLES["url_decode_params"] = _with(ACCESS, "SELECT event_id, url_decode(replace(props, '+', ' ')) AS decoded FROM access")
ORACLES["url_clean_filter"] = _with(ACCESS, "SELECT event_id, request FROM access WHERE NOT regexp_full_match(request, '/static/.*')")
ORACLES["url_clean_antijoin"] = ORACLES["url_clean_filter"]

DOC_PHONE = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
DOC_NUMBER = r"[0-9]{16}"


def _mask_sql(pattern: str) -> str:
    p = pattern.replace("'", "''")
    return (f"list_reduce(list_prepend(text, list_distinct(regexp_extract_all(text, '{p}'))), "
            f"lambda acc, m: replace(acc, m, upper(md5(m))))")


ORACLES["mask_phone"] = f"SELECT doc_id, {_mask_sql(DOC_PHONE)} AS masked FROM documents"
ORACLES["mask_id_number"] = f"SELECT doc_id, {_mask_sql(DOC_NUMBER)} AS masked FROM documents"
ORACLES["strip_whitespace"] = r"SELECT doc_id, regexp_replace(text, '[\x00\s]+', '', 'g') AS stripped FROM documents"
ORACLES["hash_ids"] = "SELECT doc_id, upper(md5(text)) AS text_md5 FROM documents"
ORACLES["classify_request"] = _with(PROC.split(",\nkept AS")[0] + """,
proc AS (SELECT * FROM access)""", """SELECT event_id, request,
    CASE WHEN regexp_full_match(request, '/air/intl/book.*') OR regexp_full_match(request, '/air/intl/search.*')
         THEN 'International'
         WHEN regexp_full_match(request, '/air/book.*') OR regexp_full_match(request, '/air/search.*')
         THEN 'National' ELSE 'Other' END AS flight_type,
    CASE WHEN regexp_full_match(request, '/air/intl/book.*') THEN 'Book'
         WHEN regexp_full_match(request, '/air/intl/search.*') THEN 'Query'
         WHEN regexp_full_match(request, '/air/book.*') THEN 'Book'
         WHEN regexp_full_match(request, '/air/search.*') THEN 'Query' ELSE 'Other' END AS behavior_type
  FROM access""")

TRAVEL = """CASE WHEN NOT contains(referer, '?') THEN 'Unknown'
     WHEN len(list_filter(string_split(split_part(referer, '?', 2), '&'),
              lambda p: regexp_full_match(split_part(p, '=', 2), '(\\d{4})-(0\\d{1}|1[0-2])-(0\\d{1}|[12]\\d{1}|3[01])'))) = 1 THEN 'OneWay'
     WHEN len(list_filter(string_split(split_part(referer, '?', 2), '&'),
              lambda p: regexp_full_match(split_part(p, '=', 2), '(\\d{4})-(0\\d{1}|1[0-2])-(0\\d{1}|[12]\\d{1}|3[01])'))) = 2 THEN 'RoundTrip'
     ELSE 'Unknown' END"""
ORACLES["classify_trip"] = _with(ACCESS, f"SELECT event_id, {TRAVEL} AS travel_type FROM access")

LISTED_HF = "('" + "', '".join(ip for ip, f in R.FIXTURE_IP_BLACKLIST if f == 0) + "')"
LISTED_ALL = "('" + "', '".join(ip for ip, _ in R.FIXTURE_IP_BLACKLIST) + "')"
ORACLES["flag_listed_ip"] = _with(ACCESS, f"SELECT event_id, ip AS remote_addr, ip IN {LISTED_HF} AS high_freq FROM access")
ORACLES["listed_ip_semi"] = _with(ACCESS, f"SELECT event_id, ip AS remote_addr FROM access WHERE ip IN {LISTED_ALL}")

ORACLES["get_params"] = """
SELECT page_id, split_part(p, '=', 1) AS k, split_part(p, '=', 2) AS v FROM (
  SELECT page_id, unnest(string_split(split_part(url, '?', 2), '&')) AS p FROM pages WHERE contains(url, '?'))
WHERE regexp_matches(p, '=.*[^=]')"""
ORACLES["form_params"] = _with(ACCESS, "SELECT event_id, 'q' AS k, url_decode(replace(props, '+', ' ')) AS v FROM access")
ORACLES["json_fields"] = "SELECT event_id, json_extract(props, '$.k')::VARCHAR AS k, NULL::VARCHAR AS missing FROM events"
ORACLES["json_to_map"] = """SELECT event_id, key, json_extract(props, '$.' || key)::VARCHAR AS value
  FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)"""
ORACLES["json_in_form"] = _with(ACCESS, """SELECT event_id, url_decode(replace(props, '+', ' ')) AS json,
  json_extract(props, '$.k')::VARCHAR AS k FROM access""")

# processed records with the fixture parse rules: GET queries -> rule q-get-any (GET
# parameters), POST queries -> q-post (JSON in form field q), POST books -> b-post.
PROC2 = PROC + f""",
proc2 AS (
  SELECT *,
    CASE WHEN behavior_type = 'Query' AND request_method = 'GET' THEN 'q-get-any'
         WHEN behavior_type = 'Query' AND request_method = 'POST' THEN 'q-post'
         WHEN behavior_type = 'Book' AND request_method = 'POST' THEN 'b-post' END AS matched_rule,
    {TRAVEL} AS travel_type,
    ip IN {LISTED_HF} AS high_freq
  FROM proc)
"""
ORACLES["match_parse_rule"] = _with(PROC2, "SELECT event_id, matched_rule FROM proc2")
ORACLES["processed_records"] = _with(PROC2, """SELECT event_id, ip, request, request_method, flight_type,
  behavior_type, travel_type, NULL::VARCHAR AS flight_date, dep_city, arr_city, session_hash, user_hash,
  high_freq, matched_rule, epoch_us(ts) AS ts_us FROM proc2""")
ORACLES["enrich_job"] = _with(PROC2, """SELECT event_id, ip, request, flight_type, behavior_type, travel_type,
  dep_city, arr_city, session_hash, high_freq, matched_rule FROM proc2""")
ORACLES["roundtrip_record"] = _with(PROC2, """SELECT request, ip, user_agent, flight_type, behavior_type,
  travel_type, dep_city, arr_city, session_hash, user_hash, high_freq, epoch_us(ts) AS ts_us FROM proc2""")
ORACLES["route_records"] = _with(PROC2, """SELECT event_id, lower(behavior_type) AS topic FROM proc2
  WHERE behavior_type IN ('Query', 'Book')""")
ORACLES["parse_query_request"] = _with(PROC2, """SELECT event_id,
  FALSE AS is_empty,
  CASE flight_type WHEN 'National' THEN 0 WHEN 'International' THEN 1 ELSE -1 END AS flight_type,
  CASE WHEN request_method = 'GET' THEN dep_city ELSE '' END AS depcity,
  CASE WHEN request_method = 'GET' THEN arr_city ELSE '' END AS arrcity,
  '' AS flightdate,
  CASE WHEN request_method = 'POST' THEN json_extract(props, '$.k')::VARCHAR ELSE '' END AS adultnum,
  '' AS childnum, '' AS infantnum, '' AS country,
  CASE travel_type WHEN 'OneWay' THEN 0 WHEN 'RoundTrip' THEN 1 ELSE -1 END AS travel_type
  FROM proc2 WHERE matched_rule IN ('q-get-any', 'q-post')""")
ORACLES["parse_book_request"] = _with(PROC2, """SELECT event_id, 0 AS flight_type,
  CASE travel_type WHEN 'OneWay' THEN 0 WHEN 'RoundTrip' THEN 1 ELSE -1 END AS travel_type,
  json_extract(props, '$.k')::VARCHAR AS flightno, NULL::VARCHAR AS depcity, NULL::VARCHAR AS contractphone, 0 AS n_idcard
  FROM proc2 WHERE matched_rule = 'b-post'""")

# ------------------------------------------------------------------ D: monitoring
ORACLES["link_counts"] = _with(ACCESS, "SELECT server_addr, count(*) AS n_requests FROM access GROUP BY ALL")
ORACLES["link_active_latest"] = _with(ACCESS, """SELECT server_addr, connection_active FROM (
  SELECT server_addr, connection_active, row_number() OVER (PARTITION BY server_addr ORDER BY ts DESC, event_id DESC) rn
  FROM access) WHERE rn = 1""")
ORACLES["batch_throughput"] = _with(ACCESS, f"""SELECT epoch_us(ts) // {H} AS batch_id, count(*) AS n_rows,
  min(epoch_us(ts)) AS start_us, max(epoch_us(ts)) AS end_us,
  round(CASE WHEN max(epoch_us(ts)) = min(epoch_us(ts)) THEN NULL
        ELSE count(*) / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1000.0) END, 6) AS rows_per_ms
  FROM access GROUP BY ALL""")

# ------------------------------------------------------------------ blacklist tables
HIST = SCORED + f""",
hist AS (SELECT make_timestamp(we + CAST({TTL} AS BIGINT) * 1000000) AS expire_at,
                'CSANTI_ANTI_BLACK' || ip || ':' || flow_id AS key,
                printf('%.6f', flow_score) || '|' || printf('%.6f', flow_limit) || '|' || hit_rules || '|'
                  || strftime(make_timestamp(we), '%Y-%m-%d %H:%M:%S') AS value,
                strftime(make_timestamp(we), '%Y%m%d%H') AS hour
         FROM dedup),
hn AS (SELECT *, (SELECT max(expire_at) - INTERVAL 30 MINUTES FROM hist) AS now FROM hist),
latest AS (SELECT key, expire_at, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY expire_at DESC, value DESC) rn FROM hist) WHERE rn = 1)
"""
ORACLES["latest_expiry"] = _with(HIST, "SELECT key, epoch_us(max(expire_at)) AS expire_at_us FROM hist GROUP BY key")
ORACLES["blacklist_latest"] = _with(HIST, "SELECT key, epoch_us(expire_at) AS expire_at_us, value FROM latest")
ORACLES["blacklist_restore"] = _with(HIST, """SELECT l.key, epoch_us(l.expire_at) AS expire_at_us, l.value
  FROM latest l, (SELECT DISTINCT now FROM hn) n
  WHERE l.expire_at > n.now AND NOT l.key LIKE '%:P1'""")
ORACLES["blacklist_recent_partitions"] = _with(HIST, """SELECT key, value, epoch_us(expire_at) AS expire_at_us, hour
  FROM hn WHERE hour IN (strftime(now, '%Y%m%d%H'), strftime(now - INTERVAL 1 HOUR, '%Y%m%d%H'))""")
ORACLES["hourly_partition_counts"] = _with(HIST, "SELECT hour, count(*) AS n_entries FROM hist GROUP BY hour")

# ------------------------------------------------------------------ XML slice, C16, C19, C23, C33
ORACLES["xml_nodes"] = """SELECT page_id, CAST(i - 1 AS INTEGER) AS idx, v AS value FROM (
  SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '<nav>.*?</nav>', 0), '<a href="[^"]*">([^<]*)</a>', 1)) AS v,
         unnest(range(1, 1 + len(regexp_extract_all(regexp_extract(html, '<nav>.*?</nav>', 0), '<a href="[^"]*">([^<]*)</a>', 1)))) AS i
  FROM pages)"""
ORACLES["xml_fields"] = """SELECT page_id,
  regexp_extract(regexp_extract(html, '<nav>.*?</nav>', 0), '<li><a href="[^"]*">([^<]*)</a>', 1) AS first_link,
  regexp_extract(regexp_extract(html, '<nav>.*?</nav>', 0), '<li><a href="[^"]*">[^<]*</a></li><li><a href="([^"]*)"', 1) AS second_href,
  NULL::VARCHAR AS title_if_xml
  FROM pages"""
ORACLES["query_fields_from_params"] = _with(PROC2, """SELECT event_id, dep_city AS depcity, arr_city AS arrcity,
  '' AS adultnum, CASE travel_type WHEN 'OneWay' THEN 0 WHEN 'RoundTrip' THEN 1 ELSE -1 END AS travel_type
  FROM proc2 WHERE matched_rule = 'q-get-any'""")
ORACLES["json_body_fields"] = "SELECT event_id, json_extract(props, '$.k')::VARCHAR AS adultnum, '' AS depcity FROM events"
ORACLES["book_json"] = _with(PROC2, """SELECT event_id, json_extract(props, '$.k')::VARCHAR AS flightno, 0 AS n_passengers
  FROM proc2 WHERE matched_rule = 'b-post'""")
ORACLES["book_hash_pii"] = f"""SELECT doc_id,
  array_to_string(list_transform(regexp_extract_all(text, '{DOC_NUMBER}'), lambda x: upper(md5(x))), ',') AS hashed_ids
  FROM documents"""
ORACLES["link_snapshot"] = _with(ACCESS + """,
per AS (
  SELECT server_addr, count(*) AS n,
         arg_max(connection_active, (ts, event_id)) AS active
  FROM access GROUP BY server_addr)
""", """SELECT CAST(to_json(map_from_entries(list_sort(list((server_addr, n))))) AS VARCHAR) AS link_counts,
       CAST(to_json(map_from_entries(list_sort(list((server_addr, active))))) AS VARCHAR) AS active_connections
FROM per""")

NAV = "regexp_extract(html, '<nav>.*?</nav>', 0)"
ORACLES["book_xml"] = f"""SELECT page_id,
  array_to_string(regexp_extract_all({NAV}, '<a href="([^"]*)"', 1), ',') AS hrefs,
  split_part(regexp_extract({NAV}, '<li><a href="[^"]*">([^<]*)</a>', 1), '|', 1) AS contractname,
  split_part(regexp_extract({NAV}, '<a href="([^"]*)"', 1), '/', 1) AS contractphone,
  'Unknown' AS travel_type
  FROM pages"""

# C35 wire line of the processed records; the query / book structs as Spark's to_json
# writes them (compact, null fields left out).
ORACLES["serialize_record"] = _with(PROC2, """SELECT concat_ws('#CS#',
    'NULL', request_method, request, ip, user_agent,
    strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00'), server_addr,
    CASE WHEN high_freq THEN 'true' ELSE 'false' END,
    flight_type, behavior_type, travel_type,
    'NULL', coalesce(dep_city, 'NULL'), coalesce(arr_city, 'NULL'), session_hash, user_hash,
    CASE WHEN behavior_type = 'Query' THEN
      '{"is_empty":false,"flight_type":' || CASE flight_type WHEN 'National' THEN '0' ELSE '1' END
      || ',"depcity":"' || CASE WHEN request_method = 'GET' THEN dep_city ELSE '' END
      || '","arrcity":"' || CASE WHEN request_method = 'GET' THEN arr_city ELSE '' END
      || '","flightdate":"","adultnum":"'
      || CASE WHEN request_method = 'POST' THEN json_extract(props, '$.k')::VARCHAR ELSE '' END
      || '","childnum":"","infantnum":"","country":"","travel_type":'
      || CASE travel_type WHEN 'OneWay' THEN '0' WHEN 'RoundTrip' THEN '1' ELSE '-1' END || '}'
    ELSE 'NULL' END,
    CASE WHEN matched_rule = 'b-post' THEN
      '{"flight_type":0,"travel_type":' || CASE travel_type WHEN 'OneWay' THEN '0' WHEN 'RoundTrip' THEN '1' ELSE '-1' END
      || ',"flightno":["' || json_extract(props, '$.k')::VARCHAR || '"]}'
    ELSE 'NULL' END,
    referer) AS value
  FROM proc2 WHERE behavior_type IN ('Query', 'Book', 'Other')""")

# ------------------------------------------------------------------ A5, A10/F3, A11/F4 over the data
ORACLES["rules_by_class"] = _with(PROC + f""",
cls(class, expressions) AS (VALUES ('nq', '/air/search.*'), ('nb', '/air/book.*'),
                                   ('iq', '/air/intl/search.*'), ('ib', '/air/intl/book.*')),
per AS (SELECT CASE flight_type || '/' || behavior_type
                 WHEN 'National/Query' THEN 'nq' WHEN 'National/Book' THEN 'nb'
                 WHEN 'International/Query' THEN 'iq' WHEN 'International/Book' THEN 'ib' END AS class
        FROM (SELECT
    CASE WHEN regexp_full_match(request, '/air/intl/book.*') OR regexp_full_match(request, '/air/intl/search.*')
         THEN 'International'
         WHEN regexp_full_match(request, '/air/book.*') OR regexp_full_match(request, '/air/search.*')
         THEN 'National' ELSE 'Other' END AS flight_type,
    CASE WHEN regexp_full_match(request, '/air/intl/book.*') THEN 'Book'
         WHEN regexp_full_match(request, '/air/intl/search.*') THEN 'Query'
         WHEN regexp_full_match(request, '/air/book.*') THEN 'Book'
         WHEN regexp_full_match(request, '/air/search.*') THEN 'Query' ELSE 'Other' END AS behavior_type
          FROM access))
""", """SELECT c.class, c.expressions, count(p.class) AS n_requests
  FROM cls c LEFT JOIN per p ON p.class = c.class GROUP BY c.class, c.expressions""")
ORACLES["flow_strategy_join"] = _with(SCORED + f""",
fl AS (SELECT p.id AS flow_id, p.process_name AS flow_name, CAST(s.crawler_t AS DOUBLE) AS flow_limit
       FROM process_info p JOIN strategy s ON p.id = s.id WHERE p.status = 0)
""", """SELECT f.flow_id, f.flow_name, f.flow_limit, count(d.flow_id) AS n_entries
  FROM fl f LEFT JOIN dedup d ON d.flow_id = f.flow_id GROUP BY f.flow_id, f.flow_name, f.flow_limit""")
ORACLES["flow_rules_join"] = _with(SCORED, """SELECT fr.rule_id, fr.flow_id, fr.indicator, fr.rule_status,
  count(h.rule_id) AS n_hits
  FROM flow_rules fr LEFT JOIN (SELECT rule_id FROM hits_s WHERE hit) h ON h.rule_id = fr.rule_id
  GROUP BY fr.rule_id, fr.flow_id, fr.indicator, fr.rule_status""")

ORACLES["batch_server_counts"] = _with(ACCESS, f"""SELECT epoch_us(ts) // {H} AS batch_id, server_addr,
  count(*) AS n_requests FROM access GROUP BY ALL""")
ORACLES["blacklist_store"] = _with(HIST, """SELECT l.key, epoch_us(l.expire_at) AS expire_at_us, l.value
  FROM latest l, (SELECT DISTINCT now FROM hn) n WHERE l.expire_at > n.now""")
ORACLES["blacklist_store_buckets"] = ORACLES["blacklist_restore_job"] = ORACLES["blacklist_store"]
ORACLES["listed_ip_bitmap"] = _with(ACCESS, """SELECT event_id, ip AS remote_addr,
  CAST(split_part(ip, '.', 4) AS INTEGER) % 3 = 0
  OR (CAST(split_part(ip, '.', 4) AS INTEGER) <= 255 AND (ip LIKE '10.3.%' OR ip LIKE '10.5.2.%')) AS listed FROM access""")
ORACLES["sketch_distincts"] = _with(IPF, "SELECT we AS window_end_us, ip, ua_distinct, trip_distinct, session_distinct FROM ipf")
ORACLES["sketch_distincts_half_day"] = _with(PROC, """SELECT (t_us // 43200000000 + 1) * 43200000000 AS window_end_us, ip,
  count(DISTINCT user_agent) AS ua_distinct, count(DISTINCT trip) AS trip_distinct,
  count(DISTINCT CASE WHEN critical THEN session_id END) AS session_distinct FROM recs GROUP BY ALL""")
_CLOSED = "(SELECT max(t_us) // 1000 * 1000 FROM recs)"  # the watermark, in ms
ORACLES["stream_ip_features"] = _with(IPF, f"""SELECT we AS window_end_us, ip, ip_count, critical_count, ua_distinct,
  min_interval_ms, trip_distinct, session_distinct FROM ipf WHERE we <= {_CLOSED}""")
ORACLES["stream_fast_repeats"] = _with(IPF, f"SELECT we AS window_end_us, ip, request, fast_repeats FROM fast WHERE we <= {_CLOSED}")
ORACLES["stream_attach_features"] = _with(SCORED, f"""SELECT we AS window_end_us, ip, request, block_count, ip_count,
  critical_count, ua_distinct, min_interval_ms, trip_distinct, session_distinct, fast_repeats FROM feats WHERE we <= {_CLOSED}""")
ORACLES["blacklist_sink"] = ORACLES["blacklist_latest"]
_SECOND = 1_705_276_800_000_000  # 2024-01-15
_VERSIONED = SCORED.replace(
    "regexp_full_match(request, '/air/(intl/)?search.*') AS critical",
    f"regexp_full_match(request, CASE WHEN epoch_us(ts) >= {_SECOND} THEN '/air/.*' ELSE '/air/(intl/)?search.*' END) AS critical").replace(
    "any_value(flow_limit) AS flow_limit", f"CASE WHEN we >= {_SECOND} THEN 5.0 ELSE any_value(flow_limit) END AS flow_limit")
ORACLES["score_job_versions"] = _with(_VERSIONED, """SELECT we AS window_end_us, ip, flow_id, round(flow_score, 6) AS flow_score,
  CAST(flow_limit AS DOUBLE) AS flow_limit, hit_rules, 'CSANTI_ANTI_BLACK' || ip || ':' || flow_id AS bl_key FROM dedup""")
ORACLES["flag_listed_asof"] = _with(ACCESS + """,
changes AS (SELECT ip, ts, bool_or(request LIKE '/static%') AS listed FROM access
            WHERE request LIKE '/static%' OR request LIKE '/air/book%' GROUP BY ip, ts)
""", """SELECT a.event_id, coalesce(c.listed, FALSE) AS listed FROM access a ASOF LEFT JOIN changes c ON a.ip = c.ip AND a.ts >= c.ts""")
ORACLES["archive_compacted"] = _with(RAW, """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_lines,
  count(DISTINCT event_id) AS n_events, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM raw GROUP BY day""")
ORACLES["url_clean_index"] = ORACLES["url_clean_filter"]
ORACLES["url_rule_index"] = r"""
WITH rules AS (SELECT DISTINCT unnest([
  'https?://([a-z]+\.)?' || regexp_extract(url, '([a-z]+)\.example\.', 1) || '\.example\.(com|net)/.*',
  '[^?#]*/' || regexp_extract(url, '/[a-z]{2}/(\d+)', 1) || '(\.html|/)?([?#].*)?', '.{45,}', '.*[?&]r?ef=[a-z]{1,3}']) AS expression FROM pages)
SELECT expression, count(url) AS n_urls FROM rules LEFT JOIN (SELECT DISTINCT url FROM pages) u ON regexp_full_match(url, expression)
GROUP BY expression"""
# C3 in SQL: each escape or character on its own, joined again
ORACLES["cookie_unescape"] = """SELECT page_id, title, array_to_string(list_transform(
    regexp_extract_all(title, '(?s)%u[0-9a-fA-F]{4}|%[0-9a-fA-F]{2}|.'),
    lambda x: CASE WHEN length(x) = 6 THEN chr(('0x' || substr(x, 3))::INTEGER)
                   WHEN length(x) = 3 THEN chr(('0x' || substr(x, 2))::INTEGER) ELSE x END), '') AS unescaped
  FROM (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)"""

from gatewatch.plans.irregular import ORACLES as _IRREGULAR  # noqa: E402

ORACLES.update(_IRREGULAR)
