"""Stream = batch, restart from checkpoint, rule change between batches, listener."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gatewatch.config import FIXTURE_WINDOW
from gatewatch.operators import blacklist as B
from gatewatch.plans import enrich_job, score_job
from gatewatch.plans.context import Ctx
from gatewatch.sources import rules as R
from gatewatch.sources.streams import line_stream
from gatewatch.streaming import jobs as J


def _chunks(df, n):
    """Split rows (time ordered by event_id) into n consecutive chunks."""
    q = df.approxQuantile("event_id", [i / n for i in range(1, n)], 0.0)
    edges = [-1] + q + [10**12]
    return [df.filter((F.col("event_id") > lo) & (F.col("event_id") <= hi)) for lo, hi in zip(edges, edges[1:])]


def _write_text(df, path):
    df.select("value").coalesce(1).write.mode("overwrite").text(path)


def test_enrich_stream_equals_batch_and_restarts(spark):
    c = Ctx(spark, SF_SMALL)
    tmp = tempfile.mkdtemp(prefix="gw-stream-")
    src, out, ck, rules = (os.path.join(tmp, x) for x in ("src", "out", "ck", "rules"))
    lines = c.raw_lines()
    parts = _chunks(lines, 2)
    _write_text(parts[0], os.path.join(src, "p0"))
    J.RuleSource.publish(c.tables, rules, 1)
    sink = J.EnrichSink(out=out, rejects=os.path.join(tmp, "rej"), monitor=os.path.join(tmp, "mon"),
                        rules=J.RuleSource(spark, rules))
    stream = line_stream(spark, os.path.join(src, "*"), "text")
    q = J.start_enrich_stream(stream, sink, ck, available_now=True)
    q.awaitTermination(120)
    # rule change between batches: also filter national book pages from now on
    t2 = R.fixture_rules(spark)
    t2.filter_rule = spark.createDataFrame(R.FIXTURE_FILTER_RULES + [("0", "/air/book.*")], R.FILTER_RULE_SCHEMA)
    J.RuleSource.publish(t2, rules, 2)
    _write_text(parts[1], os.path.join(src, "p1"))
    q = J.start_enrich_stream(line_stream(spark, os.path.join(src, "*"), "text"), sink, ck, available_now=True)
    q.awaitTermination(120)

    key = ["ip", "request", "ts", "session_hash", "dep_city", "behavior_type"]
    got = spark.read.parquet(out).select(*key)
    # no duplicates after the restart
    assert got.count() == got.distinct().count()

    def routed(df, tables):
        return enrich_job.enrich_lines(df, tables).filter(F.col("behavior_type").isin("Query", "Book")).select(*key)
    exp = routed(parts[0], c.tables).unionByName(routed(parts[1], t2))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    assert spark.read.parquet(os.path.join(tmp, "rej")).count() == 20


def test_score_stream_equals_batch(spark):
    c = Ctx(spark, SF_SMALL)
    tmp = tempfile.mkdtemp(prefix="gw-score-")
    src = os.path.join(tmp, "src")
    processed = c.processed()
    cols = ["ip", "request", "user_agent", "session_hash", "dep_city", "arr_city", "ts", "event_id"]
    for i, part in enumerate(_chunks(processed.select(*cols), 4)):
        part.coalesce(1).write.mode("overwrite").parquet(os.path.join(src, f"p{i}"))
    schema = processed.select(*cols).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    sink = J.ScoreSink(state=os.path.join(tmp, "state"), history=os.path.join(tmp, "hist"),
                       rules=J.StaticRules(c.tables), window=FIXTURE_WINDOW, lateness="0 seconds")
    listener = J.ThroughputListener(spark, os.path.join(tmp, "throughput"))
    spark.streams.addListener(listener)
    try:
        q = J.start_score_stream(stream, sink, os.path.join(tmp, "ck"), available_now=True)
        q.awaitTermination(300)
        J.flush(sink, spark)
    finally:
        spark.streams.removeListener(listener)
    assert not os.path.exists(sink.late_path)
    got = spark.read.parquet(sink.history).select("key", "value", "expire_at")
    exp = B.history_rows(score_job.blacklist(processed, c.tables, FIXTURE_WINDOW)).select("key", "value", "expire_at")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    assert got.count() > 0
    snaps = [r for r in listener.snapshots().collect() if r["num_input_rows"]]
    assert sum(r["num_input_rows"] for r in snaps) == processed.count()
    assert all(r["trigger_ms"] > 0 and r["rows_per_ms"] > 0 for r in snaps)
    last = J.latest_snapshot(listener.snapshots()).collect()
    assert [r["batch_id"] for r in last] == [max(r["batch_id"] for r in listener.snapshots().collect())]


def test_windowed_features_stream(spark):
    c = Ctx(spark, SF_SMALL)
    tmp = tempfile.mkdtemp(prefix="gw-win-")
    recs = score_job.indicator_records(c.processed(), c.tables)
    recs.write.parquet(os.path.join(tmp, "src"))
    stream = spark.readStream.schema(recs.schema).parquet(os.path.join(tmp, "src"))
    q = (J.windowed_features_stream(stream, FIXTURE_WINDOW, "0 seconds", exact=True).writeStream
         .format("memory").queryName("gw_win").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT * FROM gw_win")
    from gatewatch.operators import features as fe
    exp = fe.ip_features(recs, FIXTURE_WINDOW).drop("min_interval_ms")
    # append mode emits only the windows the watermark has passed: all but the last ones
    joined = got.join(exp, ["window_end", "ip"])
    assert got.count() > 0 and joined.count() == got.count()
    for col in ("ip_count", "critical_count", "ua_distinct", "trip_distinct", "session_distinct"):
        assert joined.filter(got[col] != exp[col]).count() == 0


def test_windowed_features_stream_hll(spark):
    c = Ctx(spark, SF_SMALL)
    tmp = tempfile.mkdtemp(prefix="gw-hll-")
    recs = score_job.indicator_records(c.processed(), c.tables)
    recs.write.parquet(os.path.join(tmp, "src"))
    stream = spark.readStream.schema(recs.schema).parquet(os.path.join(tmp, "src"))
    q = (J.windowed_features_stream(stream, FIXTURE_WINDOW, "0 seconds", exact=False).writeStream
         .format("memory").queryName("gw_hll").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT * FROM gw_hll")
    from gatewatch.operators import features as fe
    exp = fe.ip_features(recs, FIXTURE_WINDOW)
    j = got.join(exp, ["window_end", "ip"])
    assert j.count() == got.count() > 0
    # small sets: the sketch is exact
    assert j.filter(got["ua_distinct"] != exp["ua_distinct"]).count() == 0


def test_score_stream_counts_and_drops_late_rows(spark):
    c = Ctx(spark, SF_SMALL)
    tmp = tempfile.mkdtemp(prefix="gw-late-")
    src = os.path.join(tmp, "src")
    cols = ["ip", "request", "user_agent", "session_hash", "dep_city", "arr_city", "ts"]
    early, late = _chunks(c.processed().select(*cols, "event_id"), 2)
    # the later half arrives first; the earlier half then lies behind the watermark
    late.drop("event_id").coalesce(1).write.parquet(os.path.join(src, "a"))
    early.drop("event_id").coalesce(1).write.parquet(os.path.join(src, "b"))
    schema = late.drop("event_id").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    sink = J.ScoreSink(state=os.path.join(tmp, "state"), history=os.path.join(tmp, "hist"),
                       rules=J.StaticRules(c.tables), window=FIXTURE_WINDOW, lateness="0 seconds")
    q = J.start_score_stream(stream, sink, os.path.join(tmp, "ck"), available_now=True)
    q.awaitTermination(300)
    n_early = early.count()
    assert spark.read.parquet(sink.late_path).count() == n_early
    # what is kept (panes that windows still need) is of the later half
    kept = spark.read.parquet(sink.records_path).agg(F.min("ts"), F.count(F.lit(1))).first()
    assert 0 < kept[1] <= late.count() and kept[0] >= late.agg(F.min("ts")).first()[0]


def test_records_from_wire(spark):
    from gatewatch.functions.wire import serialize
    from gatewatch.sources.streams import records_from_wire
    c = Ctx(spark, SF_SMALL)
    p = c.processed()
    back = records_from_wire(serialize(p).select("value"))
    cols = ["ip", "request", "user_agent", "session_hash", "dep_city", "arr_city", "ts"]
    assert sorted(map(tuple, back.select(*cols).collect())) == sorted(map(tuple, p.select(*cols).collect()))


def test_raw_archive_monitor_and_graceful_stop(spark):
    c = Ctx(spark, SF_SMALL)
    tmp = tempfile.mkdtemp(prefix="gw-arch-")
    src = os.path.join(tmp, "src")
    lines = c.raw_lines()
    _write_text(lines, os.path.join(src, "p0"))
    # Hourly text archive, append only
    q = J.start_raw_archive(line_stream(spark, os.path.join(src, "*"), "text"), os.path.join(tmp, "arch"),
                            os.path.join(tmp, "ck-arch"), available_now=True)
    q.awaitTermination(120)
    arch = spark.read.text(os.path.join(tmp, "arch"))
    assert arch.count() == lines.count()
    assert "hour" in arch.columns
    # B6 + H5: monitor snapshots per batch; stop after the running trigger finishes
    sink = J.EnrichSink(out=os.path.join(tmp, "out"), monitor=os.path.join(tmp, "mon"),
                        rules=J.StaticRules(c.tables))
    q = J.start_enrich_stream(line_stream(spark, os.path.join(src, "*"), "text"), sink,
                              os.path.join(tmp, "ck"), trigger="1 second")
    q.processAllAvailable()
    J.stop_gracefully(q)
    assert not q.isActive
    mon = spark.read.parquet(os.path.join(tmp, "mon"))
    accepted = lines.count() - 20  # the adapter drops a field on every 50th line
    assert mon.agg(F.sum("n_requests")).first()[0] == accepted
    assert set(mon.columns) >= {"server_addr", "n_requests", "connection_active", "expire_at", "batch_id"}
    docs = J.link_snapshots(spark, os.path.join(tmp, "mon")).collect()
    assert [r["is_last"] for r in docs].count(True) == 1
    import json
    assert sum(json.loads(r["snapshot"])["link_counts"].values().__iter__().__next__() for r in docs) > 0
    future = F.current_timestamp() + F.expr("INTERVAL 2 DAYS")
    assert J.link_snapshots(spark, os.path.join(tmp, "mon"), future).count() == 0


def _score_sink(spark, tmp, tables, **kw):
    from gatewatch.config import WindowSpec
    w = WindowSpec("9 seconds", "3 seconds")
    return J.ScoreSink(state=os.path.join(tmp, "state"), history=os.path.join(tmp, "hist"), rules=J.StaticRules(tables),
                       window=w, lateness="0 seconds", store=os.path.join(tmp, "store"), **kw)


def _busy_records(spark, n, start=0):
    """n seconds of records: two addresses that repeat a critical page every second."""
    rows = [(f"10.0.0.{a}", f"/air/search?x={t % 2}", f"UA{(t + a) % 3}", f"S{t % 4}", "A", f"B{t % 5}", 1_700_000_000 + start + t)
            for t in range(n) for a in range(2)]
    df = spark.createDataFrame(rows, "ip string, request string, user_agent string, session_hash string, dep_city string, arr_city string, s long")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


def _history(spark, sink):
    return sorted(map(tuple, spark.read.parquet(sink.history).select("key", "value", "expire_at").collect()))


def test_flush_crash_and_resume_give_the_batch_result(spark):
    from gatewatch.sources.rules import fixture_rules
    tmp = tempfile.mkdtemp(prefix="gw-flush-")
    tables = fixture_rules(spark)
    sink = _score_sink(spark, tmp, tables)
    whole = _busy_records(spark, 24)
    parts = [_busy_records(spark, 6, 6 * i) for i in range(4)]
    sink(parts[0], 0)
    J.flush(sink, spark)
    sink(parts[1], 1)
    J.flush(sink, spark)
    J.flush(sink, spark)
    # a crash after the writes of batch 2 but before its progress: the batch runs again
    sink(parts[2], 2)
    os.remove(os.path.join(sink.progress_path, "2.json"))
    again = _score_sink(spark, tmp, tables)
    again(parts[2], 2)
    again(parts[3], 3)
    J.flush(again, spark)
    want = B.history_rows(score_job.blacklist(whole, tables, sink.window)).select("key", "value", "expire_at")
    assert _history(spark, again) == sorted(map(tuple, want.collect())) and want.count() > 0
    # the keyed store holds the latest entry of each key among the closed windows
    live = {r["key"]: r["expire_at"] for r in B.read_store(spark, sink.store).collect()}
    closed = spark.read.parquet(sink.history).filter(F.col("batch_id") >= 0)
    assert live == {r["key"]: r["expire_at"] for r in B.latest_per_key(closed).collect()} and live


def test_state_is_bounded_over_many_triggers(spark):
    from gatewatch.sources.rules import fixture_rules
    tmp = tempfile.mkdtemp(prefix="gw-many-")
    sink = _score_sink(spark, tmp, fixture_rules(spark))
    n = int(os.environ.get("GATEWATCH_TRIGGERS", "7"))
    for i in range(n):
        sink(_busy_records(spark, 3, 3 * i), i)
        assert len(os.listdir(sink.records_path)) <= 2 * (sink.window.panes + 4)
        assert len([x for x in os.listdir(sink.progress_path) if x.endswith(".json")]) <= J.KEEP_PROGRESS
        assert len(os.listdir(sink.store)) <= 2 * 3 if os.path.exists(sink.store) else True


def test_expired_entries_leave_the_store(spark):
    tmp = tempfile.mkdtemp(prefix="gw-store-")
    at = lambda s: F.timestamp_seconds(F.lit(s))
    rows = lambda *r: spark.createDataFrame(r, "key string, s long, value string").select("key", F.timestamp_seconds("s").alias("expire_at"), "value")
    B.write_store(spark, tmp, rows(("a", 100, "1"), ("b", 200, "1")), at(50), 0)
    B.write_store(spark, tmp, rows(("b", 300, "2"), ("c", 110, "1")), at(100), 1)
    got = lambda: {r["key"]: r["value"] for r in B.read_store(spark, tmp).collect()}
    assert got() == {"b": "2", "c": "1"}
    B.write_store(spark, tmp, rows(("b", 300, "2"), ("c", 110, "1")), at(100), 1)  # a retried batch
    assert got() == {"b": "2", "c": "1"}
    B.write_store(spark, tmp, rows(), at(299), 2)
    assert got() == {"b": "2"}


def test_wire_lines_feed_the_score_job_with_rule_changes(spark):
    """Raw lines -> data job -> wire files -> score job, rules changing in between."""
    c = Ctx(spark, SF_SMALL)
    tmp = tempfile.mkdtemp(prefix="gw-wire-")
    base = os.path.join(tmp, "rules")
    J.RuleSource.publish(c.tables, base, 1)
    lines = _chunks(c.raw_lines(), 2)
    enrich = J.EnrichSink(out=os.path.join(tmp, "out"), rules=J.RuleSource(spark, base), wire=os.path.join(tmp, "wire"))
    for i, part in enumerate(lines):
        enrich(part, i)
    score = J.ScoreSink(state=os.path.join(tmp, "state"), history=os.path.join(tmp, "hist"), rules=J.RuleSource(spark, base),
                        window=FIXTURE_WINDOW, lateness="0 seconds")
    sink = J.WireScoreSink(score, os.path.join(tmp, "rejects"))
    bad = spark.createDataFrame([("a#CS#b",), (None,)], "value string")
    sink(spark.read.text(os.path.join(tmp, "wire", "batch_id=0")).unionByName(bad), 0)
    t2 = R.fixture_rules(spark)
    t2.critical_page = spark.createDataFrame([("/air/.*",)], R.CRITICAL_PAGE_SCHEMA)
    t2.strategy = spark.createDataFrame([("P1", 5.0, 40.0), ("P2", 5.0, 30.0), ("P3", 50.0, 60.0)], R.STRATEGY_SCHEMA)
    J.RuleSource.publish(t2, base, 2)
    sink(spark.read.text(os.path.join(tmp, "wire", "batch_id=1")), 1)
    J.flush(score, spark)
    assert spark.read.parquet(sink.rejects).count() == 2
    got = sorted(map(tuple, spark.read.parquet(score.history).select("key", "value", "expire_at").collect()))
    # batch form: each half's critical flag by the rules of its time, windows scored by the
    # rules in force when they closed
    recs = [score_job.indicator_records(enrich_job.enrich_lines(p, c.tables).filter(F.col("behavior_type").isin("Query", "Book")), t)
            for p, t in zip(lines, (c.tables, t2))]
    from gatewatch.operators import features as fe
    from gatewatch.operators import scoring as S
    recs = [r.persist() for r in recs]  # the hand-over between the jobs
    feats = fe.window_features(recs[0].unionByName(recs[1]), FIXTURE_WINDOW)
    turn = (recs[0].agg(F.max(F.unix_micros("ts"))).first()[0] // FIXTURE_WINDOW.slide_us) * FIXTURE_WINDOW.slide_us
    old = S.flow_scores(feats.filter(F.unix_micros("window_end") <= turn), R.flow_config(c.tables))
    new = S.flow_scores(feats.filter(F.unix_micros("window_end") > turn), R.flow_config(t2))
    want = B.history_rows(S.blacklist_entries(old.unionByName(new))).select("key", "value", "expire_at")
    assert got == sorted(map(tuple, want.collect())) and got


def test_rows_in_are_scored_rejected_or_late(spark):
    c = Ctx(spark, SF_SMALL)
    lines = c.raw_lines().select("value")
    broken = lines.limit(30).select(F.regexp_replace("value", r"#CS#\d{4}-\d\d-\d\dT[^#]*#CS#", "#CS#yesterday#CS#").alias("value"))
    from gatewatch.operators.ingest import parse_access_log, reject_rows, timed
    both = lines.unionByName(broken).unionByName(spark.createDataFrame([(None,), ("",)], "value string"))
    bad = {r["reason"]: r["n"] for r in reject_rows(both).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert timed(parse_access_log(both)).count() + sum(bad.values()) == both.count()
    assert bad["time"] > 20 and bad["width"] >= 22
