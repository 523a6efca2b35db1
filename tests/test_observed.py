"""Metrics that are gathered by the pass they describe."""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gatewatch.operators import monitor as MO
from gatewatch.operators.ingest import parse_access_log, reject_rows
from gatewatch.plans.context import Ctx
from gatewatch.sources.streams import line_stream
from gatewatch.streaming import jobs as J
from test_streaming import _busy_records, _score_sink


def jobs_of(spark, group, fn):
    """Spark jobs that a call starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        fn()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_listener_has_rejects_and_requests_per_server(spark):
    c = Ctx(spark, SF_SMALL)
    tmp = tempfile.mkdtemp(prefix="gw-obs-")
    lines = c.raw_lines().select("value").unionByName(spark.createDataFrame([(None,), ("x",)], "value string")).persist()
    for i in range(2):
        part = lines.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == i)
        part.coalesce(1).write.parquet(os.path.join(tmp, f"src/p{i}"))
    stream = line_stream(spark, os.path.join(tmp, "src/*"), "parquet", "value string", max_files_per_trigger=1)
    listener = J.ThroughputListener(spark, os.path.join(tmp, "metrics"))
    sink = J.EnrichSink(out=os.path.join(tmp, "out"), rejects=os.path.join(tmp, "rej"), monitor=os.path.join(tmp, "mon"), rules=J.StaticRules(c.tables))
    spark.streams.addListener(listener)
    try:
        q = J.start_enrich_stream(stream, sink, os.path.join(tmp, "ck"), available_now=True)
        q.awaitTermination(300)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        until = time.time() + 20
        while len(os.listdir(listener.path)) < 2 and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    snaps = [r for r in listener.snapshots().collect() if r["num_input_rows"]]
    assert len(snaps) == 2 and all(r["n_rows"] == r["num_input_rows"] for r in snaps)
    assert sum(r["n_rejects"] for r in snaps) == reject_rows(lines).count() == spark.read.parquet(sink.rejects).count()
    got = {}
    for r in snaps:
        for server, n in r["server_counts"].items():
            got[server] = got.get(server, 0) + n
    assert got == {r["server_addr"]: r["n_requests"] for r in MO.link_counts(parse_access_log(lines)).collect()}
    # batch by batch they are the counts of the monitor table, which the same stream writes
    table = {(r["batch_id"], r["server_addr"]): r["n_requests"] for r in spark.read.parquet(sink.monitor).collect()}
    assert table == {(r["batch_id"], s): n for r in snaps for s, n in r["server_counts"].items()}


def test_stream_metrics_need_no_job_of_their_own(spark):
    tmp = tempfile.mkdtemp(prefix="gw-obs-")
    c = Ctx(spark, SF_SMALL)
    c.raw_lines().select("value").coalesce(1).write.text(os.path.join(tmp, "src"))
    seen = {}
    for name, wrap in (("plain", lambda x: x), ("observed", J.observed)):
        counted = []
        q = (wrap(line_stream(spark, os.path.join(tmp, "src"), "text")).writeStream.foreachBatch(
            lambda b, i: counted.append(jobs_of(spark, f"gw-{name}-{i}", lambda: b.write.format("noop").mode("overwrite").save())))
             .option("checkpointLocation", os.path.join(tmp, name)).trigger(availableNow=True).start())
        q.awaitTermination(120)
        seen[name] = counted
    assert seen["plain"] == seen["observed"] and sum(seen["plain"]) > 0


def test_score_sink_counts_in_its_write(spark):
    from gatewatch.sources.rules import fixture_rules
    tmp = tempfile.mkdtemp(prefix="gw-obs-")
    sink = _score_sink(spark, tmp, fixture_rules(spark))
    none = _busy_records(spark, 6).limit(0)
    sink(none, 0)  # an empty batch has nothing to count
    sink(_busy_records(spark, 6), 1)
    sink(_busy_records(spark, 6, 6).unionByName(_busy_records(spark, 1)), 2)  # a second of the first rows again, too late
    read = lambda b: json.load(open(os.path.join(sink.progress_path, f"{b}.json")))
    assert [read(b)["rows"] for b in range(3)] == [0, 12, 14] and [read(b)["late"] for b in range(3)] == [0, 0, 2]
    assert read(0)["watermark_us"] is None and read(2)["watermark_us"] > read(1)["watermark_us"]
    assert spark.read.parquet(sink.late_path).count() == 2
