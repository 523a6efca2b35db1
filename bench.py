"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Each query runs once to warm up, then three times; the
median is reported. Results are forced with the ``noop`` sink, so no time goes to
collecting rows on the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gatewatch.config import FIXTURE_WINDOW  # noqa: E402
from gatewatch.session import build_session, materialize, quick_planning  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, reps: int = 3) -> float:
    fn()  # warm-up
    out = []
    for _ in range(reps):
        t = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t)
    return statistics.median(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(f"local[{cpus}]", app="gatewatch-bench", shuffle_partitions=int(cpus) * 2)
    from gatewatch.operators import features as fe
    from gatewatch.plans import enrich_job, score_job
    from gatewatch.plans.catalog import QUERIES
    from gatewatch.plans.context import Ctx
    from gatewatch.session import prepare
    prepare(spark)
    c = Ctx(spark, sf_dir)
    tables, w = c.tables, FIXTURE_WINDOW
    lines = c.raw_lines()
    n_lines = lines.count()

    def enriched():
        return enrich_job.enrich_lines(lines, tables)

    def end_to_end():
        with quick_planning(spark):  # as the streams plan both jobs
            processed = materialize(enriched(), "bench_processed")
            run(score_job.blacklist(processed, tables, w))

    def quick(fn):
        with quick_planning(spark):
            run(fn())

    results = {}
    results["enrich_job"] = timed(lambda: quick(enriched), reps)
    processed = c.hand_over()
    recs = score_job.indicator_records(processed, tables)
    results["ip_features_pane"] = timed(lambda: run(fe.ip_features(recs, w, "pane")), reps)
    results["ip_features_direct"] = timed(lambda: run(fe.ip_features(recs, w, "direct")), reps)
    results["score_job"] = timed(lambda: run(score_job.blacklist(processed, tables, w)), reps)
    results["end_to_end"] = timed(end_to_end, reps)
    for name in ("win_min_interval", "win_fast_repeats", "flow_scores", "mask_phone",
                 "classify_request", "link_counts", "blacklist_latest"):
        results[name] = timed(lambda n=name: run(QUERIES[n](spark, sf_dir)), reps)

    total = sum(results.values())
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in results.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "rows": {"raw_lines": n_lines},
        "enrich_rows_per_sec": round(n_lines / results["enrich_job"], 1),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
