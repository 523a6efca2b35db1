"""Chained stateful streams of the eight indicators against their batch forms."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gatewatch.config import WindowSpec
from gatewatch.operators import features as fe
from gatewatch.operators import scoring as S
from gatewatch.streaming import indicators as IN

W = WindowSpec("9 seconds", "3 seconds", fast_repeat_ms=2_000)
T0 = 1_700_000_000
SCHEMA = "ip string, request string, user_agent string, session_id string, dep_city string, arr_city string, critical boolean, s double"


def records(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))).drop("s")


def rows(n=400, seed=1):
    import random
    rng = random.Random(seed)
    return [(rng.choice(["10.0.0.1", "10.0.1.2", "10.7.0.3", "NULL"]), f"/p{rng.randrange(3)}", f"u{rng.randrange(3)}", rng.choice(["s1", "s2", None]),
             rng.choice(["A", None]), f"B{rng.randrange(3)}", rng.choice([True, True, False, None]), T0 + rng.random() * 60) for _ in range(n)]


def hot(n=500):
    """Half of all rows in one second, from one address."""
    return [("10.0.0.1", "/p0", "u0", "s1", "A", "B0", True, T0 + 7 + i / (2 * n)) for i in range(n)]


END = [("end", "/end", "u", "s", "A", "B", True, T0 + 10_000.0)]  # pushes the watermark past every other window


@pytest.fixture()
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def streamed(spark, parts, make, name):
    """Runs a stream over files, one trigger each; the rows it emits and its state rows."""
    tmp = tempfile.mkdtemp(prefix="gw-ind-")
    for i, part in enumerate(parts):
        records(spark, part).coalesce(1).write.parquet(os.path.join(tmp, f"src/p{i}"))
    src = spark.readStream.schema(records(spark, parts[0]).schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(tmp, "src/*"))
    q = (make(src).writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    states = [op["numRowsTotal"] for op in q.lastProgress["stateOperators"]]
    return spark.sql(f"SELECT * FROM {name}").filter("window_end < timestamp_seconds(%d)" % (T0 + 9_000)), states


def equal(got, want):
    cols = want.columns
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.collect())) and want.count() > 0


def test_ip_features_stream(spark, few_partitions):
    data = rows() + hot()
    got, states = streamed(spark, [data, END], lambda r: IN.ip_features_stream(r, W, "0 seconds"), "gw_ind_ip")
    equal(got, fe.ip_features(records(spark, data), W, "direct"))
    # what is left is the state of the last record: a few rows an operator
    assert all(n <= 4 for n in states)


def test_fast_repeats_and_block_counts_stream(spark, few_partitions):
    data = rows(seed=2) + hot()
    got, _ = streamed(spark, [data, END], lambda r: IN.fast_repeats_stream(r, W, "0 seconds"), "gw_ind_fast")
    equal(got, fe.fast_repeats(records(spark, data), W, "direct"))
    got, _ = streamed(spark, [data, END], lambda r: IN.block_counts_stream(r, W, "0 seconds"), "gw_ind_block")
    equal(got, fe.block_counts(records(spark, data), W, "direct"))


def test_state_follows_seconds_and_not_rows(spark, few_partitions):
    tmp = tempfile.mkdtemp(prefix="gw-ind-")
    records(spark, hot(3_000)).coalesce(1).write.parquet(os.path.join(tmp, "src/p0"))
    src = spark.readStream.schema(records(spark, END).schema).parquet(os.path.join(tmp, "src/*"))
    q = (IN.fast_repeats_stream(src, W, "1 hour").writeStream.format("memory").queryName("gw_ind_state").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert [op["numRowsTotal"] for op in q.lastProgress["stateOperators"]][-1] <= 1 and sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]) <= 1


def test_attached_features_with_late_rows(spark, few_partitions):
    data = [r for r in rows(120, seed=3) if r[0] != "NULL"]
    # rows far behind the watermark: no chain counts them and they are no key to score
    late = [("10.0.0.1", "/p0", "late", "late", "A", "B", True, T0 - 500.0), ("10.9.0.9", "/late", "u", "s", "A", "B", True, T0 - 400.0)]
    mid = [("mid", "/mid", "u", "s", "A", "B", False, T0 + 200.0)]
    parts = [data, mid, late, END]
    got, _ = streamed(spark, parts, lambda r: IN.attach_features_stream(r, W, "1 seconds"), "gw_ind_f1")
    recs = records(spark, data + mid)
    want = S.attach_features(S.score_keys(recs, W), recs, W, "direct")
    equal(got, want)
    # keys without a critical access have no row in the E6 stream: their value is the default
    assert got.filter("fast_repeats = 0 and min_interval_ms = 0").count() > 0


def test_large_input_comes_in_triggers_and_gives_the_same(spark, tmp_path, monkeypatch):
    import datetime

    from gatewatch.plans import catalog
    from gatewatch.session import checkpoint_dir
    from gatewatch.streaming import files
    at = datetime.datetime(2024, 1, 1)
    # not in the order of time, equal times, a row without a time and one that comes twice
    events = [(i, at + datetime.timedelta(minutes=(i * 37) % 400 * 13), i % 9, ("view", "click", "purchase")[i % 3], i / 7, '{"k": 1}') for i in range(600)]
    events += [(7, None, 3, "view", 1.0, None), events[0]]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    stores = f"{checkpoint_dir(spark).rstrip('/')}/stores"
    names = ("stream_attach_features", "stream_ip_features", "stream_fast_repeats")
    conf = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.minBatchesToRetain")}

    def run(rows):
        monkeypatch.setattr(catalog, "TRIGGER_ROWS", rows, raising=False)
        before = set(files.children(spark, stores))
        found, triggers = {}, {}
        for name in names:
            found[name] = sorted(map(str, catalog.QUERIES[name](spark, str(tmp_path)).collect()))
            (new,) = set(files.children(spark, stores)) - before
            before.add(new)
            triggers[name] = 1 + max(int(n) for n in files.children(spark, f"{stores}/{new}/ck/commits") if n.isdigit())
        return found, triggers

    whole, few = run(10_000)
    parts, many = run(100)
    assert parts == whole and all(len(whole[n]) > 50 for n in names)
    assert all(many[n] >= 6 > 2 >= few[n] for n in names)  # the last one has no rows
    assert conf == {k: spark.conf.get(k, None) for k in conf}
    # a store that keeps no modification times: one trigger takes all files
    monkeypatch.setattr(files, "in_order", lambda *_: False)
    monkeypatch.setattr(catalog, "TRIGGER_ROWS", 100)
    name = names[0]
    assert sorted(map(str, catalog.QUERIES[name](spark, str(tmp_path)).collect())) == whole[name]


def test_a_folder_is_read_in_the_order_of_names(spark, tmp_path):
    from gatewatch.streaming import files
    spark.range(40).repartitionByRange(8, "id").write.parquet(f"{tmp_path}/in")
    assert files.in_order(spark, f"{tmp_path}/in")
    found = sorted((tmp_path / "in").glob("part-*"))
    times = [f.stat().st_mtime for f in found]
    assert len(found) > 4 and times == sorted(set(times))
