"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the access-log adapter) with the
fixture rule tables; times leave as epoch microseconds (``*_us``), doubles are
rounded to 6 places, so the DuckDB oracle (plans/oracles.py) compares exactly.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.config import WindowSpec
from gatewatch.functions import classify as C
from gatewatch.functions import masking as M
from gatewatch.functions import params as P
from gatewatch.functions import text as T
from gatewatch.functions import xml as X
from gatewatch.operators import blacklist as B
from gatewatch.operators import features as fe
from gatewatch.operators import ingest as I
from gatewatch.operators import ip_set as IP
from gatewatch.operators import lookup as L
from gatewatch.operators import monitor as MO
from gatewatch.operators import rule_index as RI
from gatewatch.operators import scoring as S
from gatewatch.operators import sketches as SK
from gatewatch.plans import enrich_job as EJ
from gatewatch.plans import score_job
from gatewatch.plans import versions as VE
from gatewatch.plans.context import Ctx
from gatewatch.session import checkpoint_dir, materialize
from gatewatch.sources import rules as R
from gatewatch.streaming import files
from gatewatch.streaming import indicators as IN
from gatewatch.streaming import restore
from gatewatch.streaming import sink as SI
from gatewatch.streaming.archive import Archive
from gatewatch.streaming.store import KeyedStore

QUERIES: dict = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _us(col: str, alias: str | None = None):
    return F.unix_micros(F.col(col)).alias(alias or f"{col}_us")


def _recs(c: Ctx) -> DataFrame:
    return score_job.indicator_records(c.score_input(), c.tables)


def _scored(c: Ctx, form: str = "pane") -> DataFrame:
    return score_job.scored(c.score_input(), c.tables, c.window, form)


# ------------------------------------------------------------------ E: window indicators

@query("win_ip_count")
def win_ip_count(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return fe.ip_counts(_recs(c), c.window).select(_us("window_end"), "ip", "ip_count")


@query("win_ipblock_count")
def win_ipblock_count(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return fe.block_counts(_recs(c), c.window).select(_us("window_end"), "ip_block", "block_count")


def _ipf_col(name):
    def q(spark, sf_dir):
        c = Ctx(spark, sf_dir)
        f = fe.min_intervals(_recs(c), c.window) if name == "min_interval_ms" else fe.ip_features(_recs(c), c.window)
        return f.select(_us("window_end"), "ip", name)
    return q


QUERIES["win_critical_count"] = _ipf_col("critical_count")
QUERIES["win_ua_distinct"] = _ipf_col("ua_distinct")
QUERIES["win_min_interval"] = _ipf_col("min_interval_ms")
QUERIES["win_trip_distinct"] = _ipf_col("trip_distinct")
QUERIES["win_session_distinct"] = _ipf_col("session_distinct")


@query("win_fast_repeats")
def win_fast_repeats(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return fe.fast_repeats(_recs(c), c.window).select(_us("window_end"), "ip", "request", "fast_repeats")


@query("ip_features")
def ip_features(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    f = fe.ip_features(_recs(c), c.window, "pane")
    return f.select(_us("window_end"), *[x for x in f.columns if x != "window_end"])


@query("ip_features_direct")
def ip_features_direct(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    f = fe.ip_features(_recs(c), c.window, "direct")
    return f.select(_us("window_end"), *[x for x in f.columns if x != "window_end"])


@query("request_gaps")
def request_gaps(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    r = _recs(c).filter("critical")
    g = fe.request_gaps(r, ("ip",))
    return g.select("ip", _us("ts"), "gap_ms")


@query("critical_pages")
def critical_pages(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return _recs(c).groupBy("request").agg(F.first("critical").alias("critical"),
                                           F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ F / G: scoring

@query("attach_features")
def attach_features(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    recs = _recs(c)
    f = S.attach_features(S.score_keys(recs, c.window), recs, c.window)
    return f.select(_us("window_end"), *[x for x in f.columns if x != "window_end"])


@query("rule_hits")
def rule_hits(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    recs = _recs(c)
    f = S.attach_features(S.score_keys(recs, c.window), recs, c.window)
    h = S.rule_hits(f, ["window_end", "ip", "request"], R.flow_config(c.tables))
    return h.filter("hit").select(_us("window_end"), "ip", "request", "flow_id", "rule_id",
                                  "indicator", "value", F.col("s").cast("long").alias("s"))


@query("flow_scores")
def flow_scores(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    s = _scored(c)
    return s.select(_us("window_end"), "ip", "request", "flow_id",
                    F.round("flow_score", 6).alias("flow_score"), "flow_limit", "over_limit",
                    F.array_join("hit_rules", ",").alias("hit_rules"))


@query("blacklist_candidates")
def blacklist_candidates(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return S.blacklist_candidates(_scored(c), ["window_end", "ip"]).select(_us("window_end"), "ip")


@query("dedupe_hits")
def dedupe_hits(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    d = S.dedupe_hits(_scored(c))
    return d.select(_us("window_end"), "ip", "flow_id", F.round("flow_score", 6).alias("flow_score"),
                    "request")


def _entries(c: Ctx, form: str = "pane") -> DataFrame:
    e = score_job.blacklist(c.score_input(), c.tables, c.window, form)
    return e.select(_us("window_end"), "ip", "flow_id", F.round("flow_score", 6).alias("flow_score"),
                    "flow_limit", "hit_rules", "bl_key", "bl_value", _us("expire_at"))


@query("blacklist_entries")
def blacklist_entries(spark, sf_dir):
    return _entries(Ctx(spark, sf_dir))


@query("score_job")
def score_job_q(spark, sf_dir):
    """H7 flagship: events -> enrich -> indicators -> flow scores -> blacklist entries."""
    return _entries(Ctx(spark, sf_dir))


# ------------------------------------------------------------------ A / C: ingest, clean, label, extract


# Pattern parameters for the documents table (FIXTURES.md section 2: its phones are
# ``+1 (743) 555-3824`` style and its long numbers have 16 digits).
DOC_PHONE_PATTERN = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
DOC_NUMBER_PATTERN = r"[0-9]{16}"


@query("src_raw_log")
def src_raw_log(spark, sf_dir):
    return Ctx(spark, sf_dir).raw_lines()


@query("parse_access_log")
def parse_access_log(spark, sf_dir):
    a = Ctx(spark, sf_dir).access()
    return a.select("event_id", "request", "request_method", "content_type", "remote_addr",
                    "http_user_agent", "server_addr", "connection_active", _us("ts"))


@query("reject_rows")
def reject_rows(spark, sf_dir):
    return I.reject_rows(Ctx(spark, sf_dir).raw_lines()).select("event_id", "n_fields")


@query("cookie_fields")
def cookie_fields(spark, sf_dir):
    return Ctx(spark, sf_dir).access().select("event_id", "jsession_id", "cookie_user_id")


@query("url_decode_params")
def url_decode_params(spark, sf_dir):
    a = Ctx(spark, sf_dir).access()
    return a.select("event_id", T.url_decode(F.substring_index("request_body", "=", -1)).alias("decoded"))


@query("url_clean_filter")
def url_clean_filter(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return EJ.url_filter(c.access(), c.tables).select("event_id", "request")


@query("url_clean_antijoin")
def url_clean_antijoin(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    rules = R.url_filter_rules(c.tables.filter_rule)
    return L.regex_anti_join(c.access(), rules).select("event_id", "request")


@query("mask_phone")
def mask_phone(spark, sf_dir):
    d = Ctx(spark, sf_dir).table("documents")
    return d.select("doc_id", M.mask_phones(F.col("text"), DOC_PHONE_PATTERN).alias("masked"))


@query("mask_id_number")
def mask_id_number(spark, sf_dir):
    d = Ctx(spark, sf_dir).table("documents")
    return d.select("doc_id", M.mask_ids(F.col("text"), DOC_NUMBER_PATTERN).alias("masked"))


@query("strip_whitespace")
def strip_whitespace(spark, sf_dir):
    d = Ctx(spark, sf_dir).table("documents")
    return d.select("doc_id", T.strip_whitespace(F.col("text")).alias("stripped"))


@query("hash_ids")
def hash_ids(spark, sf_dir):
    d = Ctx(spark, sf_dir).table("documents")
    return d.select("doc_id", T.md5_upper(F.col("text")).alias("text_md5"))


@query("classify_request")
def classify_request(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    cls = C.classify_request(F.col("request"), EJ.class_patterns(c.tables.classify_rule))
    return c.access().select("event_id", "request", cls["flight_type"].alias("flight_type"),
                             cls["behavior_type"].alias("behavior_type"))


@query("classify_trip")
def classify_trip(spark, sf_dir):
    a = Ctx(spark, sf_dir).access()
    return a.select("event_id", C.travel_type(F.col("http_referer")).alias("travel_type"))


@query("flag_listed_ip")
def flag_listed_ip(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    f = L.flag_listed_ip(c.access(), R.high_frequency_ips(c.tables.ip_blacklist))
    return f.select("event_id", "remote_addr", "high_freq")


@query("listed_ip_semi")
def listed_ip_semi(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return L.listed_ip_semi(c.access(), R.all_listed_ips(c.tables.ip_blacklist)).select("event_id", "remote_addr")


@query("get_params")
def get_params(spark, sf_dir):
    p = Ctx(spark, sf_dir).table("pages")
    return p.select("page_id", F.explode(P.get_params(F.col("url"))).alias("kv")).select(
        "page_id", F.col("kv.k").alias("k"), F.col("kv.v").alias("v"))


@query("form_params")
def form_params(spark, sf_dir):
    a = Ctx(spark, sf_dir).access()
    return a.select("event_id", F.explode(P.form_params(F.col("request_body"))).alias("kv")).select(
        "event_id", F.col("kv.k").alias("k"), F.col("kv.v").alias("v"))


@query("json_fields")
def json_fields(spark, sf_dir):
    e = Ctx(spark, sf_dir).events
    return e.select("event_id", P.json_field(F.col("props"), "$.k").alias("k"),
                    P.json_field(F.col("props"), "$.missing").alias("missing"))


@query("json_to_map")
def json_to_map(spark, sf_dir):
    e = Ctx(spark, sf_dir).events
    return e.select("event_id", F.explode(P.json_to_map(F.col("props"))).alias("key", "value"))


@query("json_in_form")
def json_in_form(spark, sf_dir):
    a = Ctx(spark, sf_dir).access()
    j = P.json_in_form(F.col("request_body"), F.lit("q"))
    return a.select("event_id", j.alias("json"), P.json_field(j, "$.k").alias("k"))


def _proc(c: Ctx) -> DataFrame:
    return c.processed()


@query("match_parse_rule")
def match_parse_rule(spark, sf_dir):
    return _proc(Ctx(spark, sf_dir)).select("event_id", "matched_rule")


@query("parse_query_request")
def parse_query_request(spark, sf_dir):
    p = _proc(Ctx(spark, sf_dir)).filter(F.col("query").isNotNull())
    return p.select("event_id", "query.*")


@query("parse_book_request")
def parse_book_request(spark, sf_dir):
    p = _proc(Ctx(spark, sf_dir)).filter(F.col("book").isNotNull())
    return p.select("event_id", F.col("book.flight_type").alias("flight_type"),
                    F.col("book.travel_type").alias("travel_type"),
                    F.array_join("book.flightno", ",").alias("flightno"),
                    F.array_join("book.depcity", ",").alias("depcity"),
                    F.col("book.contractphone").alias("contractphone"),
                    F.size(F.coalesce("book.idcard", F.array())).alias("n_idcard"))


@query("processed_records")
def processed_records(spark, sf_dir):
    p = _proc(Ctx(spark, sf_dir))
    return p.select("event_id", "ip", "request", "request_method", "flight_type", "behavior_type",
                    "travel_type", "flight_date", "dep_city", "arr_city", "session_hash", "user_hash",
                    "high_freq", "matched_rule", _us("ts"))


@query("enrich_job")
def enrich_job(spark, sf_dir):
    """H6: raw lines -> processed records (not materialised: the whole data job)."""
    c = Ctx(spark, sf_dir)
    p = EJ.enrich_lines(c.raw_lines(), c.tables)
    return p.select("event_id", "ip", "request", "flight_type", "behavior_type", "travel_type",
                    "dep_city", "arr_city", "session_hash", "high_freq", "matched_rule")


@query("roundtrip_record")
def roundtrip_record(spark, sf_dir):
    from gatewatch.functions import wire as W
    p = _proc(Ctx(spark, sf_dir))
    back = W.parse(W.serialize(p.select("*")).select("value"))
    return back.select("request", "ip", "user_agent", "flight_type", "behavior_type", "travel_type",
                       "dep_city", "arr_city", "session_hash", "user_hash", "high_freq", _us("ts"))


@query("serialize_record")
def serialize_record(spark, sf_dir):
    from gatewatch.functions import wire as W
    return W.serialize(_proc(Ctx(spark, sf_dir))).select("value")


@query("route_records")
def route_records(spark, sf_dir):
    p = _proc(Ctx(spark, sf_dir))
    topic = F.when(F.col("behavior_type") == "Query", "query").when(F.col("behavior_type") == "Book", "book")
    return p.select("event_id", topic.alias("topic")).filter(F.col("topic").isNotNull())


# ------------------------------------------------------------------ D: monitoring

@query("link_counts")
def link_counts(spark, sf_dir):
    return MO.link_counts(Ctx(spark, sf_dir).access())


@query("link_active_latest")
def link_active_latest(spark, sf_dir):
    return MO.link_active_latest(Ctx(spark, sf_dir).access())


@query("link_snapshot")
def link_snapshot(spark, sf_dir):
    return MO.link_snapshot(Ctx(spark, sf_dir).access())


@query("batch_throughput")
def batch_throughput(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    a = c.access().withColumn("batch_id", fe._floor_div(F.unix_micros("ts"), c.window.slide_us))
    return MO.batch_throughput(a)


@query("batch_server_counts")
def batch_server_counts(spark, sf_dir):
    """Requests per server in each batch."""
    c = Ctx(spark, sf_dir)
    a = c.access().withColumn("batch_id", fe._floor_div(F.unix_micros("ts"), c.window.slide_us))
    return MO.batch_server_counts(a)


# ------------------------------------------------------------------ blacklist tables

def _history(c: Ctx) -> DataFrame:
    e = score_job.blacklist(c.score_input(), c.tables, c.window)
    return B.history_rows(e)


@query("latest_expiry")
def latest_expiry(spark, sf_dir):
    h = _history(Ctx(spark, sf_dir))
    return B.latest_expiry(h).select("key", _us("expire_at"))


@query("blacklist_latest")
def blacklist_latest(spark, sf_dir):
    h = _history(Ctx(spark, sf_dir))
    return B.latest_per_key(h).select("key", _us("expire_at"), "value")


def _now(h: DataFrame):
    """Reference clock of the fixture, taken from the data: 30 minutes after the last
    hit (the latest expiry minus 30 minutes), a scalar subquery of the query itself."""
    return h.agg((F.max("expire_at") - F.expr("INTERVAL 30 MINUTES")).alias("now")).scalar()


@query("blacklist_store")
def blacklist_store(spark, sf_dir):
    """The keyed store, latest live entry per key at ``now``."""
    h = _history(Ctx(spark, sf_dir))
    empty = h.select("key", "expire_at", "value").limit(0)
    return B.upsert_store(empty, h, _now(h)).select("key", _us("expire_at"), "value")


@query("blacklist_restore")
def blacklist_restore(spark, sf_dir):
    """Latest live entries (at ``now``) whose key the store lacks; here the
    store has lost the entries of flow P2 and kept those of flow P1."""
    h = _history(Ctx(spark, sf_dir))
    now = _now(h)
    store = B.live(h, now).filter(F.col("key").endswith(":P1")).select("key")
    return B.restore(h, store, now).select("key", _us("expire_at"), "value")


def _scratch_store(spark) -> KeyedStore:
    return KeyedStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/stores/{uuid.uuid4().hex}", target_rows=500)


@query("blacklist_store_buckets")
def blacklist_store_buckets(spark, sf_dir):
    """The history taken up by the bucketed store in four batches, read back. Each batch
    rewrites the buckets of its keys; small buckets, so that they split on the way."""
    h = materialize(_history(Ctx(spark, sf_dir)), "history")
    now, store = _now(h), _scratch_store(spark)
    quarter = F.substring("hour", 9, 2).cast("int") % 4
    for batch_id in range(4):
        store.apply(h.filter(quarter == batch_id), now, batch_id)
    return store.read().select("key", _us("expire_at"), "value")


@query("blacklist_restore_job")
def blacklist_restore_job(spark, sf_dir):
    """The restore job over the history partitioned by hour. The store has the
    entries of flow P1, but its health markers are lost: the hours that can hold live entries
    are read and the missing keys put back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/stores/history-{uuid.uuid4().hex}"
    h = _history(Ctx(spark, sf_dir))
    h.write.partitionBy("hour").parquet(path)
    h = B.read_history(spark, path)
    now, store = _now(h), _scratch_store(spark)
    store.apply(h.filter(F.col("key").endswith(":P1")), now, 0)
    restore.restore_store(spark, path, store, now, 1)
    return store.read().select("key", _us("expire_at"), "value")


@query("blacklist_recent_partitions")
def blacklist_recent_partitions(spark, sf_dir):
    """The history's rows of this hour and the one before (on the written table the
    predicate prunes folders, see tests)."""
    h = _history(Ctx(spark, sf_dir))
    return B.recent_partitions(h, _now(h)).select("key", "value", _us("expire_at"), "hour")


@query("hourly_partition_counts")
def hourly_partition_counts(spark, sf_dir):
    """Rows per hour partition of the blacklist history."""
    return _history(Ctx(spark, sf_dir)).groupBy("hour").agg(F.count(F.lit(1)).alias("n_entries"))


@query("archive_union")
def archive_union(spark, sf_dir):
    """F8: archive lines plus a new batch, duplicates kept (here the new batch is the
    rejected lines, so those appear twice)."""
    c = Ctx(spark, sf_dir)
    old = c.raw_lines()
    new = I.reject_rows(c.raw_lines()).select("event_id", "value")
    return old.unionByName(new).groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


# ------------------------------------------------------------------ XML (C20, C22, C26-C28), C3, C16, C19, C23, C33


def _nav(pages: DataFrame) -> DataFrame:
    """The XML-safe slice of a page: its ``<nav>`` element (the rest of the HTML is not
    well-formed XML; the guard in functions.xml returns NULL for it)."""
    return pages.select("page_id", F.regexp_extract("html", r"<nav>.*?</nav>", 0).alias("xml"))


@query("xml_nodes")
def xml_nodes(spark, sf_dir):
    """Node texts at a path, in document order, as (name + index -> value)."""
    n = _nav(Ctx(spark, sf_dir).table("pages"))
    return n.select("page_id", F.posexplode(X.xml_nodes(F.col("xml"), "//a/text()")).alias("idx", "value"))


@query("xml_fields")
def xml_fields(spark, sf_dir):
    """C20: scalar reads at literal paths, guarded against malformed documents
    (the whole page HTML is malformed and yields NULL, the nav slice parses)."""
    p = Ctx(spark, sf_dir).table("pages")
    n = p.select("page_id", "html", F.regexp_extract("html", r"<nav>.*?</nav>", 0).alias("xml"))
    return n.select("page_id",
                    X.xml_text(F.col("xml"), "//li[1]/a/text()").alias("first_link"),
                    X.xml_text(F.col("xml"), "//li[2]/a/@href").alias("second_href"),
                    X.xml_text(F.col("html"), "//title/text()").alias("title_if_xml"))


@query("book_xml")
def book_xml(spark, sf_dir):
    """List and scalar reads with the contact cuts (name before '|', phone before '/')."""
    n = _nav(Ctx(spark, sf_dir).table("pages"))
    hrefs = X.xml_nodes(F.col("xml"), "//a/@href")
    return n.select("page_id", F.array_join(hrefs, ",").alias("hrefs"),
                    X.contact_name(X.xml_text(F.col("xml"), "//li[1]/a/text()")).alias("contractname"),
                    X.contact_phone(F.element_at(hrefs, 1)).alias("contractphone"),
                    X.xml_travel_type(F.col("xml")).alias("travel_type"))


@query("cookie_unescape")
def cookie_unescape(spark, sf_dir):
    """C3 over whole page titles (``%`` runs that are not escapes stay as they are)."""
    p = Ctx(spark, sf_dir).table("pages")
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    return p.select("page_id", title.alias("title"), T.unescape(title).alias("unescaped"))


@query("query_fields_from_params")
def query_fields_from_params(spark, sf_dir):
    """Query fields read from GET parameters by the rule's keys."""
    p = _proc(Ctx(spark, sf_dir)).filter(F.col("matched_rule") == "q-get-any")
    return p.select("event_id", F.col("query.depcity").alias("depcity"), F.col("query.arrcity").alias("arrcity"),
                    F.col("query.adultnum").alias("adultnum"), F.col("query.travel_type").alias("travel_type"))


@query("json_body_fields")
def json_body_fields(spark, sf_dir):
    """JSON body read with rule paths (the event props as the body)."""
    e = Ctx(spark, sf_dir).events
    paths = F.lit("$.k")
    return e.select("event_id", P.json_field(F.col("props"), paths).alias("adultnum"),
                    F.coalesce(P.json_field(F.col("props"), F.lit("$.dep")), F.lit("")).alias("depcity"))


@query("book_json")
def book_json(spark, sf_dir):
    """Book lists from JSON in the form field (flight numbers from ``$.k``)."""
    p = _proc(Ctx(spark, sf_dir)).filter(F.col("book").isNotNull())
    return p.select("event_id", F.array_join("book.flightno", ",").alias("flightno"),
                    F.size(F.coalesce("book.psgname", F.array())).alias("n_passengers"))


@query("book_hash_pii")
def book_hash_pii(spark, sf_dir):
    """MD5 of each id-like number in the whole document."""
    d = Ctx(spark, sf_dir).table("documents")
    ids = F.regexp_extract_all("text", F.lit(DOC_NUMBER_PATTERN), F.lit(0))
    return d.select("doc_id", F.array_join(M.hash_list(ids), ",").alias("hashed_ids"))


# ------------------------------------------------------------------ A5, A10/F3, A11/F4 over the data

@query("rules_by_class")
def rules_by_class(spark, sf_dir):
    """A5: the classification rule lists (one grouped read) with the requests of each
    class in the access log."""
    c = Ctx(spark, sf_dir)
    lists = R.rules_by_class(c.tables.classify_rule).select(
        "class", F.array_join("expressions", "|").alias("expressions"))
    label = C.request_class(F.col("request"), EJ.compiled(c.tables)["classes"])
    counts = c.access().select(label.alias("class")).filter(F.col("class").isNotNull()) \
        .groupBy("class").agg(F.count(F.lit(1)).alias("n_requests"))
    return lists.join(counts, "class", "left").select(
        "class", "expressions", F.coalesce("n_requests", F.lit(0)).alias("n_requests"))


@query("flow_strategy_join")
def flow_strategy_join(spark, sf_dir):
    """Process join strategy (status 0, crawler threshold) with the blacklist
    entries each flow produced."""
    c = Ctx(spark, sf_dir)
    fl = R.flows(c.tables.process_info, c.tables.strategy, 0)
    e = score_job.blacklist(c.score_input(), c.tables, c.window).groupBy("flow_id").agg(
        F.count(F.lit(1)).alias("n_entries"))
    return fl.join(e, "flow_id", "left").select(
        "flow_id", "flow_name", "flow_limit", F.coalesce("n_entries", F.lit(0)).alias("n_entries"))


@query("flow_rules_join")
def flow_rules_join(spark, sf_dir):
    """Rule join rule names (crawler type 0) with the hits of each rule over
    the scored keys."""
    c = Ctx(spark, sf_dir)
    fr = R.flow_rules(c.tables.rule, c.tables.rule_name, 0)
    hits = (_scored(c).select(F.explode("hit_rules").alias("rule_id"))
            .groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_hits")))
    return fr.join(hits, "rule_id", "left").select(
        "rule_id", "flow_id", "indicator", "rule_status",
        F.coalesce("n_hits", F.lit(0)).alias("n_hits"))


@query("archive_compacted")
def archive_compacted(spark, sf_dir):
    """The raw archive by day, appended in four batches of small files, compacted
    after the second and the last, and read back."""
    lines = materialize(Ctx(spark, sf_dir).raw_lines().withColumn("day", F.expr("coalesce(substring(split(value, '#CS#')[8], 1, 10), '-')")), "lines")
    root = f"{checkpoint_dir(spark).rstrip('/')}/stores/archive-{uuid.uuid4().hex}"
    archive = Archive(spark, root, "parquet", "event_id long, value string", "day")
    for batch in range(4):
        lines.filter(F.col("event_id") % 4 == batch).repartition(3).write.mode("append").partitionBy("day").parquet(root)
        if batch % 2:
            archive.compact(target_bytes=1 << 20)
    archive.vacuum()
    return archive.read().groupBy("day").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("event_id").alias("n_events"),
                                             F.sum(F.length("value")).alias("n_chars"))


# ------------------------------------------------------------------ address sets, sketches, rules as of event time

@query("listed_ip_bitmap")
def listed_ip_bitmap(spark, sf_dir):
    """Addresses of every third user and two blocks, tested by bucket and bit."""
    a = Ctx(spark, sf_dir).access()
    last = F.element_at(F.split("remote_addr", r"\."), -1).cast("int")
    listed = a.filter(last % 3 == 0).select(F.col("remote_addr").alias("ip_name")).distinct()
    blocks = spark.createDataFrame([("10.3.0.0/16",), ("10.5.2.0/24",)], "ip_name string")
    return IP.flag_in_set(a.select("event_id", "remote_addr"), IP.ip_set(listed.unionByName(blocks)))


def _sketch_windows(spark, sf_dir, w) -> DataFrame:
    table = materialize(SK.sketch_table(_recs(Ctx(spark, sf_dir)), "2 hours"), "sketches")
    return SK.window_distincts(table, w, "2 hours").select(_us("window_end"), "ip", *SK.KINDS.values())


@query("sketch_distincts")
def sketch_distincts(spark, sf_dir):
    """Distinct counts of the windows from a table of two-hour sketches."""
    return _sketch_windows(spark, sf_dir, Ctx(spark, sf_dir).window)


@query("sketch_distincts_half_day")
def sketch_distincts_half_day(spark, sf_dir):
    """The same sketches for tumbling windows of twelve hours."""
    return _sketch_windows(spark, sf_dir, WindowSpec("12 hours", "12 hours"))


#: Start of the second rule version of the fixture: 2024-01-15, inside the events.
SECOND_VERSION_US = 1_705_276_800_000_000


def _versions(c: Ctx) -> list:
    """The fixture rules, and from the 15th on all pages critical and a limit of 5 for each flow."""
    later = R.fixture_rules(c.spark)
    later.critical_page = c.spark.createDataFrame([("/air/.*",)], R.CRITICAL_PAGE_SCHEMA)
    later.strategy = later.strategy.withColumn("crawler_blacklist_thresholds", F.lit(5.0))
    return [VE.RuleVersion(0, c.tables), VE.RuleVersion(SECOND_VERSION_US, later)]


@query("score_job_versions")
def score_job_versions(spark, sf_dir):
    """H3 / H4 / H7: the score job as a replay, each record and window by the rules of its time."""
    c = Ctx(spark, sf_dir)
    e = VE.blacklist_asof(c.score_input(), _versions(c), c.window)
    return e.select(_us("window_end"), "ip", "flow_id", F.round("flow_score", 6).alias("flow_score"), "flow_limit", "hit_rules", "bl_key")


@query("flag_listed_asof")
def flag_listed_asof(spark, sf_dir):
    """Whether an address was listed at the time of its request; addresses are listed by
    their error requests and taken off by a purchase."""
    e = Ctx(spark, sf_dir)
    a = e.access().select("event_id", "remote_addr", "ts", "request")
    change = F.when(F.col("request").startswith("/static"), True).when(F.col("request").startswith("/air/book"), False)
    changes = a.select(F.col("remote_addr").alias("ip_name"), F.col("ts").alias("valid_from"), change.alias("listed")).filter("listed IS NOT NULL")
    return VE.flag_listed_asof(a, changes).select("event_id", "listed")


# ------------------------------------------------------------------ streams run to their end

#: Rows that a trigger of a stream takes, rows of one for a partition of its state, and rows of a window
#: from which state is kept in RocksDB.
TRIGGER_ROWS, STATE_ROWS, LARGE_STATE = 600_000, 50_000, 2_000_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Kept of a stream's state: the last versions, in few and small files.
STATE_CONF = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def _settings(spark, conf: dict):
    """The session with these settings, which are put back as they were."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _stream(spark, table: DataFrame, partitions: int = 4) -> tuple:
    """A stream over the files of a table, and a function that runs a stream to its end (all
    data available now) into a table. Up to ``TRIGGER_ROWS`` rows are one trigger. More of them come
    in the order of ``ts``, as they would live, that many a trigger, so that state holds the open windows and not
    the whole input. State is kept in ``partitions`` while a trigger is small, else in as many as its rows ask for;
    outside the heap if a window of ``w`` (without: the table) has over ``LARGE_STATE`` rows."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/stores/stream-{uuid.uuid4().hex}"
    table.write.parquet(f"{root}/rows")
    rows = spark.read.schema(table.schema).parquet(f"{root}/rows")
    n = rows.count()  # from the footers
    triggers = -(-n // TRIGGER_ROWS) if "ts" in table.columns else 1
    source, per_trigger = f"{root}/rows", {}
    if triggers > 1:
        source = f"{root}/in"
        rows.repartitionByRange(triggers, "ts").write.parquet(source)
        files.delete(spark, f"{root}/rows")
        if files.in_order(spark, source):
            per_trigger = {"maxFilesPerTrigger": 1}
        else:  # late rows would be dropped: all files are one trigger
            triggers = 1

    def run(df: DataFrame, w: WindowSpec | None = None) -> DataFrame:
        key = "spark.sql.shuffle.partitions"
        conf = {key: str(max(min(partitions, int(spark.conf.get(key))), -(-n // (triggers * STATE_ROWS)))), **STATE_CONF}
        open_rows = n
        if w and triggers > 1 and n > LARGE_STATE:
            in_window = spark.read.schema(table.schema).parquet(source).groupBy(F.window("ts", w.duration)).count()
            open_rows = in_window.agg(F.max("count")).first()[0] or 0
        if open_rows > LARGE_STATE:
            conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        with _settings(spark, conf):
            q = (df.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck")
                 .outputMode("append").trigger(availableNow=True).start())
            q.awaitTermination()
        return spark.read.schema(df.schema).parquet(f"{root}/out")

    return spark.readStream.schema(table.schema).options(**per_trigger).parquet(source), run


@query("stream_ip_features")
def stream_ip_features(spark, sf_dir):
    """E2-E5, E7, E8 as chained stateful aggregates: the windows the watermark has passed."""
    c = Ctx(spark, sf_dir)
    src, run = _stream(spark, _recs(c))
    out = run(IN.ip_features_stream(src, c.window, "0 seconds"), c.window)
    return out.select(_us("window_end"), "ip", "ip_count", "critical_count", "ua_distinct", "min_interval_ms", "trip_distinct", "session_distinct")


@query("stream_fast_repeats")
def stream_fast_repeats(spark, sf_dir):
    """E6 as chained stateful aggregates: the windows the watermark has passed."""
    c = Ctx(spark, sf_dir)
    src, run = _stream(spark, _recs(c))
    return run(IN.fast_repeats_stream(src, c.window, "0 seconds"), c.window).select(_us("window_end"), "ip", "request", "fast_repeats")


@query("stream_attach_features")
def stream_attach_features(spark, sf_dir):
    """F1 / E1-E8 as stream-stream outer joins: the keys whose window the watermark has passed."""
    c = Ctx(spark, sf_dir)
    src, run = _stream(spark, _recs(c), 2)
    return run(IN.attach_features_stream(src, c.window, "0 seconds"), c.window).select(_us("window_end"), "ip", "request", *S.FEATURE_COLUMNS)


@query("blacklist_sink")
def blacklist_sink(spark, sf_dir):
    """The history streamed through the sink with the commit protocol, latest entry per key
    of what it has published."""
    SI.register(spark)
    h = _history(Ctx(spark, sf_dir)).select("key", "expire_at", "value")
    src, _ = _stream(spark, h)
    path = f"{checkpoint_dir(spark).rstrip('/')}/stores/sink-{uuid.uuid4().hex}"
    q = (src.writeStream.format("gatewatch_store").option("path", path).option("checkpointLocation", f"{path}-ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return B.latest_per_key(SI.read_published(spark, path, B.STORE_SCHEMA)).select("key", _us("expire_at"), "value")


# ------------------------------------------------------------------ F5 by the literal index

@query("url_clean_index")
def url_clean_index(spark, sf_dir):
    """The anti-join of ``url_clean_antijoin`` through the index of necessary literals."""
    c = Ctx(spark, sf_dir)
    rules = R.url_filter_rules(c.tables.filter_rule)
    return RI.regex_anti_join(c.access(), rules).select("event_id", "request")


def _page_rules(pages: DataFrame) -> DataFrame:
    """A rule per site name, one per article number, and two that no literal helps."""
    site = F.regexp_extract("url", r"([a-z]+)\.example\.", 1)
    number = F.regexp_extract("url", r"/[a-z]{2}/(\d+)", 1)
    rules = [F.concat(F.lit(r"https?://([a-z]+\.)?"), site, F.lit(r"\.example\.(com|net)/.*")),
             F.concat(F.lit(r"[^?#]*/"), number, F.lit(r"(\.html|/)?([?#].*)?")), F.lit(r".{45,}"), F.lit(r".*[?&]r?ef=[a-z]{1,3}")]
    return pages.select(F.explode(F.array(*rules)).alias("expression")).distinct().withColumn("rule_id", F.md5("expression"))


@query("url_rule_index")
def url_rule_index(spark, sf_dir):
    """whole-string rules, as many as there are sites and articles, on the page URLs."""
    pages = Ctx(spark, sf_dir).table("pages")
    rules = _page_rules(pages)
    hits = RI.rule_hits(pages, rules, "url").groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_urls"))
    return rules.join(hits.hint("merge"), "rule_id", "left").select("expression", F.coalesce("n_urls", F.lit(0)).alias("n_urls"))


# ------------------------------------------------------------------ irregular input
from gatewatch.plans.irregular import QUERIES as _IRREGULAR  # noqa: E402

QUERIES.update(_IRREGULAR)
