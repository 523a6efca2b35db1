"""Structured Streaming wiring of the two jobs.

Design
------
* Both jobs are ``foreachBatch`` over a file or Kafka source. File writes of a batch replace
  that batch's own folders, so a retried batch (lost executor, restart) rewrites the same
  files. Kafka writes are at least once: a retried batch sends its records again. Source
  offsets live in the query checkpoint, on shared storage (``spark.checkpoint.dir``).
* Data job: raw lines -> rejects, link counts, processed records (one parquet table
  partitioned by ``topic`` and ``batch_id``, the B1/B2 routing).
* Score job: records are kept per ``pane`` (event time / slide), pane first, so a trigger
  lists and reads only the panes its closed windows cover, with a fixed schema, and panes
  no window needs any more are deleted. The event-time watermark is the largest event time
  seen minus ``lateness``; windows it passes are scored by the batch code, so the stream's
  result equals the batch result. Rows older than the watermark on arrival go to the
  ``late`` table. Progress is one small file per batch, of which the last few are kept.
* Rules are re-read when a new version was published (no change flags, fixes 2.J-29..31).
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from gatewatch.config import FIELD_SEP, MONITOR_TTL_S, REFERENCE_WINDOW, Tables, WindowSpec
from gatewatch.operators import blacklist as B
from gatewatch.operators import features as fe
from gatewatch.operators import monitor as MO
from gatewatch.operators import scoring as S
from gatewatch.operators.ingest import parse_access_log, reject_rows
from gatewatch.plans import enrich_job, score_job
from gatewatch.session import prepare, quick_planning
from gatewatch.sources import rules as R
from gatewatch.sources.adapters import RAW_FIELDS
from gatewatch.streaming import files, restore
from gatewatch.streaming.store import KeyedStore

DEFAULT_TRIGGER = "3 seconds"  # H1: the reference's micro-batch interval
KEEP_PROGRESS = 5              # progress files kept


# ------------------------------------------------------------------ rules (H3, H4)

class RuleSource:
    """Versioned rule tables under ``base``: tables live in ``base/v=<version>/<table>`` and
    ``base/published/<version>.json`` is written last, as a whole, so a reader sees a version
    completely or not at all. ``get`` re-reads the tables only when the version changed."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.version, self.tables = None, None

    @staticmethod
    def publish(tables: Tables, base: str, version: int, valid_from_us: int | None = None) -> None:
        """``valid_from_us``: event time from which the version holds in a replay (now)."""
        base = base.rstrip("/")
        R.write_rules(tables, f"{base}/v={version}")
        since = int(time.time() * 1_000_000) if valid_from_us is None else int(valid_from_us)
        files.write_json(tables.rule.sparkSession, f"{base}/published/{version}.json", {"version": version, "valid_from_us": since})

    def history(self) -> list:
        """Every published version with the time from which it holds, for ``plans.versions``."""
        from gatewatch.plans.versions import RuleVersion
        found = []
        for n in files.children(self.spark, f"{self.base}/published"):
            if n.endswith(".json"):
                p = files.read_json(self.spark, f"{self.base}/published/{n}")
                found.append((p.get("valid_from_us", 0), p["version"]))
        return [RuleVersion(t, R.read_rules(self.spark, f"{self.base}/v={v}")) for t, v in sorted(found)]

    def get(self) -> Tables:
        names = [n for n in files.children(self.spark, f"{self.base}/published") if n.endswith(".json")]
        v = max(int(n.removesuffix(".json")) for n in names)
        if v != self.version:
            self.tables = R.read_rules(self.spark, f"{self.base}/v={v}")
            self.version = v
        return self.tables


class StaticRules:
    def __init__(self, tables: Tables):
        self.tables, self.version = tables, 0

    def get(self) -> Tables:
        return self.tables


def _write_batch(df: DataFrame, root: str, batch_id: int, *parts: str) -> None:
    """Write one micro-batch to ``root/batch_id=<id>/`` (overwriting that folder only),
    so a retried batch replaces its own files and readers of ``root`` see
    ``batch_id`` as a partition column."""
    w = df.write.mode("overwrite")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(f"{root.rstrip('/')}/batch_id={int(batch_id)}")


def _write_parts(df: DataFrame, root: str, batch_id: int, part: str) -> None:
    """Write one micro-batch to ``root/<part>=<value>/batch_id=<id>/``, replacing only the
    folders it fills. Rows of a part are gathered into few files; large parts are split."""
    (df.hint("rebalance", part).withColumn("batch_id", F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part, "batch_id").parquet(root))


# ------------------------------------------------------------------ data job (H6)

@dataclass
class EnrichSink:
    out: str                      # processed records, partitioned by topic / batch_id
    rejects: str | None = None    # C1 reject table
    monitor: str | None = None    # D1-D3 link counts per batch (B6)
    rules: object = None
    wire: str | None = None       # C35 lines of the routed records, as text
    kafka: dict | None = None     # B1/B2 over Kafka: producer options (bootstrap servers ...)
    topics: dict = field(default_factory=lambda: {"query": "query", "book": "book"})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with quick_planning(prepare(batch.sparkSession)):
            self._run(batch, batch_id)

    def _run(self, batch: DataFrame, batch_id: int) -> None:
        from gatewatch.functions.wire import serialize
        tables = self.rules.get()
        batch = batch.select("value").persist()
        topic = (F.when(F.col("behavior_type") == "Query", "query")
                 .when(F.col("behavior_type") == "Book", "book"))
        parsed = parse_access_log(batch)
        routed = enrich_job.enrich(parsed, tables).withColumn("topic", topic).filter(F.col("topic").isNotNull())
        several = bool(self.kafka or self.wire)
        if several:
            routed = routed.persist()
        try:
            writes = [lambda: _write_batch(routed, self.out, batch_id, "topic")]
            if self.rejects:
                writes.append(lambda: _write_batch(reject_rows(batch), self.rejects, batch_id))
            if self.monitor:
                writes.append(lambda: _write_batch(_snapshot(parsed), self.monitor, batch_id))
            if self.wire:
                writes.append(lambda: serialize(routed).select("value").write.mode("overwrite").text(
                    f"{self.wire.rstrip('/')}/batch_id={int(batch_id)}"))
            # the writes are independent jobs over the persisted batch: submit them
            # together so their fixed per-job costs overlap
            _run_concurrently(writes)
            if self.kafka:
                # B1/B2: one write for both record kinds; the Kafka topic is a column
                ktopic = (F.when(F.col("behavior_type") == "Query", F.lit(self.topics["query"]))
                          .otherwise(F.lit(self.topics["book"])))
                (serialize(routed).withColumn("topic", ktopic).select("topic", "value")
                 .write.format("kafka").options(**self.kafka).save())
        finally:
            if several:
                routed.unpersist()
            batch.unpersist()


def _snapshot(parsed: DataFrame) -> DataFrame:
    """Requests and latest active connections per server, with the lifetime of
    the snapshot. The latest is the greatest (time, count), as in the batch form."""
    counts = MO.link_counts(parsed).join(MO.link_active_latest(parsed, ("ts", "connection_active")), "server_addr")
    return (counts.withColumn("snapshot_at", F.current_timestamp())
            .withColumn("expire_at", F.current_timestamp() + F.expr(f"INTERVAL {MONITOR_TTL_S} SECONDS")))


def link_snapshots(spark: SparkSession, monitor: str, now=None) -> DataFrame:
    """The snapshots that have not expired, one JSON document per batch, with
    ``is_last`` on the newest (the ``_LAST`` key)."""
    now = now if now is not None else F.current_timestamp()
    per = spark.read.parquet(monitor).filter(F.col("expire_at") > now)
    entries = F.array_sort(F.collect_list(F.struct("server_addr", "n_requests", "connection_active")))
    docs = per.groupBy("batch_id").agg(F.max("snapshot_at").alias("snapshot_at"), entries.alias("e"))

    def as_map(c):
        return F.map_from_arrays(F.transform("e", lambda x: x["server_addr"]), F.transform("e", lambda x: x[c]))

    doc = F.to_json(F.struct(as_map("n_requests").alias("link_counts"), as_map("connection_active").alias("active_connections")))
    last = docs.agg(F.max("batch_id").alias("m")).scalar()
    return docs.select("batch_id", "snapshot_at", doc.alias("snapshot"), (F.col("batch_id") == last).alias("is_last"))


def _metrics(seen: Observation) -> dict:
    """Values of an observation; none if nothing was left to write and the counters were planned away."""
    from py4j.protocol import Py4JJavaError
    try:
        return seen.get
    except Py4JJavaError:  # a row without fields
        return {}


def _run_concurrently(fns) -> None:
    from concurrent.futures import ThreadPoolExecutor
    if len(fns) == 1:
        fns[0]()
        return
    with ThreadPoolExecutor(max_workers=len(fns)) as pool:
        for f in [pool.submit(fn) for fn in fns]:
            f.result()


OBSERVED = "access"
SERVERS = 7_500  # servers a batch may have for its counts to be exact


def observed(lines: DataFrame) -> DataFrame:
    """A raw-line stream with named metrics (lines, rejects, requests per server), gathered by
    the pass that reads the batch and carried by its progress event. The counts per server
    are a frequent-items sketch, which is exact up to ``SERVERS`` different servers."""
    fields = F.split(F.col("value"), FIELD_SEP, -1)
    whole = F.coalesce(F.size(fields) == len(RAW_FIELDS), F.lit(False))
    at = lambda name: F.get(fields, F.lit(RAW_FIELDS.index(name)))
    server = F.when(whole, at("server_addr"))
    readable = whole & F.try_to_timestamp(F.when(whole, at("time_iso8601"))).isNotNull()
    return lines.observe(
        OBSERVED, F.count(F.lit(1)).alias("rows"), F.count_if(~readable).alias("rejects"),
        F.call_function("approx_top_k", server, F.lit(SERVERS), F.lit(10_000)).alias("servers"))


def start_enrich_stream(lines: DataFrame, sink: EnrichSink, checkpoint: str,
                        trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False,
                        name: str = "gatewatch-enrich"):
    w = observed(lines).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


# ------------------------------------------------------------------ score job (H7)

RECORD_SCHEMA = ("ip string, request string, user_agent string, session_id string, dep_city string, "
                 "arr_city string, ts timestamp, critical boolean, pane long, batch_id int")
PROVISIONAL = -1  # batch id of entries for windows that are still open


@dataclass
class ScoreSink:
    state: str                       # records, late rows and progress, on shared storage
    history: str                     # blacklist history, partitioned by hour (B3/B5)
    lateness: str                    # how far behind the largest event time a row may arrive
    rules: object = None
    window: WindowSpec = REFERENCE_WINDOW
    store: str | None = None         # keyed store with expiry (B5), if wanted

    @property
    def records_path(self) -> str:
        return f"{self.state.rstrip('/')}/records"

    @property
    def late_path(self) -> str:
        return f"{self.state.rstrip('/')}/late"

    @property
    def progress_path(self) -> str:
        return f"{self.state.rstrip('/')}/progress"

    def _last_batch(self, spark: SparkSession, before: int = 2**62) -> int | None:
        """The last batch (before this one) that has ended."""
        done = [int(n.removesuffix(".json")) for n in files.children(spark, self.progress_path) if n.endswith(".json")]
        return max((b for b in done if b < before), default=None)

    def _watermark_before(self, spark: SparkSession, batch_id: int) -> int | None:
        """The watermark of the last batch before this one, None before the first."""
        last = self._last_batch(spark, batch_id)
        return files.read_json(spark, f"{self.progress_path}/{last}.json")["watermark_us"] if last is not None else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with quick_planning(prepare(batch.sparkSession)):
            self._run(batch, batch_id)

    def _run(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = self.rules.get()
        w = self.window
        _drop_provisional(spark, self.history)
        recs = score_job.indicator_records(batch, tables).withColumn(
            "pane", fe._floor_div(F.unix_micros("ts"), w.slide_us)).persist()
        try:
            prev = self._watermark_before(spark, batch_id)
            behind = F.col("ts").isNull() | (F.unix_micros("ts") < F.lit(prev if prev is not None else -2**62))
            # counted by the pass that writes the records
            stats = Observation(f"score-{int(batch_id)}")
            counts = [F.count(F.lit(1)).alias("rows"), F.max(F.unix_micros("ts")).alias("max_us"), F.count_if(behind).alias("late")]
            _write_parts(recs.observe(stats, *counts).filter(~behind), self.records_path, batch_id, "pane")
            # a batch that leaves nothing to write (empty, or all late) may be planned without its counters
            got = _metrics(stats) or recs.agg(*counts).first().asDict()
            if got.get("late"):
                _write_batch(recs.filter(behind), self.late_path, batch_id)
            seen = got.get("max_us")
            wm = prev if seen is None else seen - fe.duration_us_of(self.lateness)
            wm = wm if prev is None or wm is None else max(wm, prev)
            if wm is not None:
                self._purge(spark, prev)
                lo = None if prev is None else (prev // w.slide_us) * w.slide_us
                entries = self._entries(spark, tables, lo, (wm // w.slide_us) * w.slide_us)
                if entries is not None:
                    self._publish(spark, entries, batch_id, wm)
            files.write_json(spark, f"{self.progress_path}/{int(batch_id)}.json", {
                "batch_id": int(batch_id), "watermark_us": wm, "rows": got.get("rows", 0), "late": got.get("late", 0)})
            for n in files.children(spark, self.progress_path):
                if n.endswith(".json") and int(n.removesuffix(".json")) <= batch_id - KEEP_PROGRESS:
                    files.delete(spark, f"{self.progress_path}/{n}")
        finally:
            recs.unpersist()

    def _panes(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.removeprefix("pane=")) for n in files.children(spark, self.records_path)
                      if n.startswith("pane=") and n != "pane=__HIVE_DEFAULT_PARTITION__")

    def _purge(self, spark: SparkSession, prev: int | None) -> None:
        """Deletes panes that no window ending after the previous watermark covers; a retry of
        this batch starts from that watermark again and finds what it needs."""
        if prev is not None:
            first = prev // self.window.slide_us - self.window.panes
            for p in self._panes(spark):
                if p < first:
                    files.delete(spark, f"{self.records_path}/pane={p}")

    def _entries(self, spark: SparkSession, tables: Tables, lo: int | None, hi: int | None) -> DataFrame | None:
        """Blacklist entries of the windows whose end lies in (lo, hi], None for no window. The
        bounds are multiples of the slide; None is no bound."""
        w = self.window
        s = w.slide_us
        panes = [p for p in self._panes(spark) if (lo is None or p >= lo // s - w.panes) and (hi is None or p < hi // s)]
        if not [p for p in panes if lo is None or p >= lo // s]:
            return None  # a window is scored for the records of its last pane
        recs = (spark.read.schema(RECORD_SCHEMA).option("basePath", self.records_path)
                .parquet(*[f"{self.records_path}/pane={p}" for p in panes]).drop("batch_id", "pane"))
        feats = fe.window_features(recs, w)
        if lo is not None:
            feats = feats.filter(F.unix_micros("window_end") > lo)
        return S.blacklist_entries(S.flow_scores(feats, R.flow_config(tables)))

    def _publish(self, spark: SparkSession, entries: DataFrame, batch_id: int, wm: int) -> None:
        rows = B.history_rows(entries).persist()
        try:
            _write_parts(rows, self.history, batch_id, "hour")
            if self.store and batch_id != PROVISIONAL:
                store = KeyedStore(spark, self.store)
                store.apply(rows, F.timestamp_micros(F.lit(wm)), batch_id)
                hours = sorted(r[0] for r in rows.select("hour").distinct().collect())
                store.mark_hours(hours, batch_id, oldest=hours[0] if hours else None)
        finally:
            rows.unpersist()


def _drop_provisional(spark: SparkSession, history: str) -> None:
    for hour in files.children(spark, history):
        if hour.startswith("hour="):
            files.delete(spark, f"{history.rstrip('/')}/{hour}/batch_id={PROVISIONAL}")


def flush(sink: "ScoreSink", spark: SparkSession) -> None:
    """Score the windows that are still open (end of input, or a look at the present). Their
    entries stand under the batch id ``PROVISIONAL`` and are replaced by the next flush, or
    dropped by the next batch, whose progress is as if there had been no flush."""
    last = sink._watermark_before(spark, 2**62)
    _drop_provisional(spark, sink.history)
    s = sink.window.slide_us
    entries = sink._entries(spark, sink.rules.get(), None if last is None else (last // s) * s, None)
    if entries is not None:
        sink._publish(spark, entries, PROVISIONAL, last or 0)


def start_score_stream(records: DataFrame, sink: ScoreSink, checkpoint: str,
                       trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False,
                       name: str = "gatewatch-score"):
    """Starts the score job; a keyed store that has lost hours of the history gets them back
    first (G7), so a restart after a loss needs no step of its own."""
    restore_after_loss(sink, records.sparkSession)
    w = records.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def restore_after_loss(sink: ScoreSink, spark: SparkSession, now=None) -> int:
    """G7 as a job: puts the live entries of unmarked hours back into the sink's store, as of
    the stream's watermark (or ``now``). Returns how many."""
    done = sink._last_batch(spark)
    if not sink.store or (done is None and now is None):
        return 0
    wm = sink._watermark_before(spark, 2**62)
    if now is None and wm is None:
        return 0
    now = F.timestamp_micros(F.lit(wm)) if now is None else now
    return restore.restore_store(prepare(spark), sink.history, KeyedStore(spark, sink.store), now, done or 0)


@dataclass
class WireScoreSink:
    """A2 + C36 + H7: micro-batches of wire lines -> rejects and the score job."""
    score: ScoreSink
    rejects: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from gatewatch.functions.wire import parse, wire_rejects
        lines = batch.select("value").persist()
        try:
            _write_batch(wire_rejects(lines), self.rejects, batch_id)
            self.score(parse(lines), batch_id)
        finally:
            lines.unpersist()


# ------------------------------------------------------------------ pure streaming form

def windowed_features_stream(records: DataFrame, w: WindowSpec, watermark: str,
                             exact: bool = True, lg_k: int = 12) -> DataFrame:
    """E2-E4, E7, E8 as one Structured Streaming windowed aggregation with a watermark (append
    mode emits each window once, when the watermark passes its end); all eight indicators:
    ``streaming.indicators``.

    Distinct counts (D7) are exact, ``size(collect_set)`` (streaming rejects
    ``count_distinct``), whose state grows with the distinct values. ``exact=False`` keeps an
    HLL sketch of 2 ** lg_k registers per (window, ip) instead, with its error."""
    r = records.withColumn("trip", fe.trip_key(F.col("dep_city"), F.col("arr_city")))
    sess = F.when(F.col("critical"), F.col("session_id"))

    def distinct(c):
        if exact:
            return F.size(F.collect_set(c)).cast("long")
        return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(c, lg_k)), F.lit(0)).cast("long")
    return (r.withWatermark("ts", watermark)
            .groupBy(F.window("ts", w.duration, w.slide).alias("win"), "ip")
            .agg(F.count(F.lit(1)).alias("ip_count"),
                 F.sum(F.col("critical").cast("long")).alias("critical_count"),
                 distinct(F.col("user_agent")).alias("ua_distinct"),
                 distinct(F.col("trip")).alias("trip_distinct"),
                 distinct(sess).alias("session_distinct"))
            .select(F.col("win.end").alias("window_end"), "ip", "ip_count", "critical_count",
                    "ua_distinct", "trip_distinct", "session_distinct"))


def start_raw_archive(lines: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                      trigger: str = DEFAULT_TRIGGER):
    """Append raw lines to an hourly text archive (processing hour); append only,
    never rewrite an existing hour (fix 2.J-34)."""
    out = lines.select("value", F.date_format(F.current_timestamp(), B.HOUR_FORMAT).alias("hour"))
    wr = (out.writeStream.format("text").partitionBy("hour").option("path", path)
          .option("checkpointLocation", checkpoint).outputMode("append"))
    wr = wr.trigger(availableNow=True) if available_now else wr.trigger(processingTime=trigger)
    return wr.start()


# ------------------------------------------------------------------ monitoring

class ThroughputListener(StreamingQueryListener):
    """Per-batch row count, trigger time and rows per ms of the *same*
    batch (fix 2.J-38), from the query progress events; no HTTP scraping, no job of its own.
    Streams with ``observed`` metrics also have their rejects and the requests per server.
    Each event is written to ``path`` as one small file; nothing is kept in memory."""

    SCHEMA = ("query string, batch_id long, num_input_rows long, trigger_ms long, "
              "rows_per_ms double, at string, n_rows long, n_rejects long, server_counts map<string,long>")

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = json.loads(event.progress.json)
        dur = p.get("durationMs", {}).get("triggerExecution") or 0
        n = p.get("numInputRows") or 0
        row = {"query": p.get("name"), "batch_id": p.get("batchId"), "num_input_rows": n, "trigger_ms": dur,
               "rows_per_ms": (n / dur) if dur else None, "at": p.get("timestamp")}
        seen = (p.get("observedMetrics") or {}).get(OBSERVED)
        if seen:
            row |= {"n_rows": seen["rows"], "n_rejects": seen["rejects"],
                    "server_counts": {x["item"]: x["count"] for x in seen["servers"] or [] if x.get("item") is not None}}
        files.write_json(self._spark, f"{self.path}/{row['query']}-{row['batch_id']}.json", row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def snapshots(self) -> DataFrame:
        """The throughput records; ``latest_snapshot`` gives the last of each query."""
        return self._spark.read.schema(self.SCHEMA).json(self.path)


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("query").agg(F.max_by(F.struct("*"), "batch_id").alias("last")).select("last.*")


def stop_gracefully(query) -> None:
    """H5: let the running trigger finish, however long it takes, then stop."""
    while query.isActive and query.status.get("isTriggerActive"):
        time.sleep(0.2)
    query.stop()
