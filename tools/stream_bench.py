"""Streaming trigger time of the data job against the reference's 3 s interval.

    python tools/stream_bench.py [sf_dir] [n_files] [enrich|score]

enrich: writes the adapter's raw lines as n time-ordered text files into a scratch
folder and streams them one file per trigger through the data job.
score: writes the processed records as n time-ordered parquet files and streams them
one file per trigger through the score job (1 day / 6 hour windows, scored when the
watermark closes them).
Prints one JSON line with the per-trigger durations from the query progress.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    mode = sys.argv[3] if len(sys.argv) > 3 else "enrich"
    from gatewatch.plans.context import Ctx
    from gatewatch.session import build_session, prepare
    from gatewatch.sources.streams import line_stream
    from gatewatch.streaming import jobs as J
    spark = prepare(build_session("local[8]", shuffle_partitions=8))
    tmp = tempfile.mkdtemp(prefix="gw-streambench-")
    c = Ctx(spark, sf_dir)
    from pyspark.sql import Window
    listener = J.ThroughputListener(spark, f"{tmp}/throughput")
    spark.streams.addListener(listener)
    if mode == "score":
        from gatewatch.config import FIXTURE_WINDOW
        cols = ["ip", "request", "user_agent", "session_hash", "dep_city", "arr_city", "ts"]
        recs = c.processed().select(*cols, "event_id").withColumn("chunk", F.ntile(n).over(Window.orderBy("event_id")))
        for i in range(1, n + 1):
            recs.filter(F.col("chunk") == i).select(*cols).coalesce(1).write.parquet(f"{tmp}/src/{i:04d}")
        schema = recs.select(*cols).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/src/*")
        sink = J.ScoreSink(state=f"{tmp}/state", history=f"{tmp}/hist", rules=J.StaticRules(c.tables),
                           window=FIXTURE_WINDOW, lateness="0 seconds")
        q = J.start_score_stream(stream, sink, f"{tmp}/ck", available_now=True)
    else:
        lines = c.raw_lines().withColumn("chunk", F.ntile(n).over(Window.orderBy("event_id")))
        for i in range(1, n + 1):
            lines.filter(F.col("chunk") == i).select("value").coalesce(1).write.text(f"{tmp}/src/{i:04d}")
        sink = J.EnrichSink(out=f"{tmp}/out", rejects=f"{tmp}/rej", monitor=f"{tmp}/mon",
                            rules=J.StaticRules(c.tables))
        q = J.start_enrich_stream(line_stream(spark, f"{tmp}/src/*", "text", max_files_per_trigger=1),
                                  sink, f"{tmp}/ck", available_now=True)
    q.awaitTermination(1800)
    import time
    time.sleep(1)
    rows = sorted((r for r in listener.snapshots().collect() if r["num_input_rows"]), key=lambda r: r["batch_id"])
    durs = [r["trigger_ms"] for r in rows]
    print(json.dumps({"metric": f"{mode}_stream_trigger_ms", "batches": len(rows),
                      "rows_per_batch": int(statistics.median([r["num_input_rows"] for r in rows])) if rows else 0,
                      "median_ms": statistics.median(durs) if durs else None,
                      "max_ms": max(durs) if durs else None,
                      "first_ms": durs[0] if durs else None}))


if __name__ == "__main__":
    main()
