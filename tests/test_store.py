"""The bucketed keyed store and the restore job."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gatewatch.operators import blacklist as B
from gatewatch.streaming import files, restore
from gatewatch.streaming import jobs as J
from gatewatch.streaming.store import KeyedStore, bucket_of, origin


def at(s):
    return F.timestamp_seconds(F.lit(s))


def entries(spark, rows):
    return spark.createDataFrame(rows, "key string, s long, value string").select("key", F.timestamp_seconds("s").alias("expire_at"), "value")


def found(df):
    return {r["key"]: r["value"] for r in df.collect()}


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_buckets_split_one_by_one(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    for n in (1, 2, 3, 16, 21, 31, 32, 40):
        rows = keys.select(bucket_of(F.col("k"), n).alias("a"), bucket_of(F.col("k"), n + 1).alias("b")).collect()
        assert {r.a for r in rows} == set(range(n))
        # a key stays, or moves from the split bucket to the new one
        assert {(r.a, r.b) for r in rows if r.a != r.b} == {(origin(n, n), n)}


def test_store_equals_latest_live_entry_over_many_batches(spark):
    import random
    rng = random.Random(2)
    path = tempfile.mkdtemp(prefix="gw-kv-")
    store = KeyedStore(spark, path, target_rows=20, first_buckets=2)
    best, top = {}, 0
    for batch in range(6):
        rows = [(f"k{rng.randrange(150)}", 100 + 10 * batch + rng.randrange(60), f"v{batch}.{i}") for i in range(40)]
        now = 100 + 12 * batch
        m = store.apply(entries(spark, rows + [(None, 999, "no key"), ("gone", now, "expired")]), at(now), batch)
        for k, s, v in rows:
            best[k] = max(best.get(k, (0, "")), (s, v))
        best = {k: x for k, x in best.items() if x[0] > now}
        assert found(store.read()) == {k: x[1] for k, x in best.items()}
        top = max(top, m["buckets"])
        assert store.versions() == list(range(max(0, batch - 2), batch + 1))
    assert top > 4  # it has grown
    kept = {p["folder"] for v in store.versions() for p in files.read_json(spark, f"{path}/manifest/{v}.json")["parts"].values()}
    assert set(os.listdir(os.path.join(path, "data"))) <= kept
    some = sorted(best)[:5] + ["unknown"]
    keys = spark.createDataFrame([(k,) for k in some], "key string")
    assert found(store.lookup(keys)) == {k: best[k][1] for k in some[:-1]}


def test_bytes_written_follow_the_batch(spark):
    path = tempfile.mkdtemp(prefix="gw-kv-")
    store = KeyedStore(spark, path, target_rows=100)
    big = spark.range(20_000).select(F.concat(F.lit("key"), "id").alias("key"), F.timestamp_seconds(F.lit(10_000)).alias("expire_at"), F.lit("x").alias("value"))
    m = store.apply(big, at(0), 0)
    assert m["buckets"] == 200 and len(m["parts"]) == 200
    whole = size(path)
    m = store.apply(entries(spark, [("key7", 20_000, "new"), ("other", 20_000, "new")]), at(0), 1)
    folder, = {p["folder"] for p in m["parts"].values() if p["folder"].startswith("1-")}
    wrote = size(os.path.join(path, "data", folder))
    assert len(m["rewritten"]) <= 3 and wrote < whole / 40
    assert store.read().count() == 20_001
    one = store.lookup(spark.createDataFrame([("key7",)], "key string"))
    assert found(one) == {"key7": "new"} and len(one.inputFiles()) == 1
    # expired buckets go by their manifest lines: nothing but the two new keys' buckets stays
    m = store.apply(entries(spark, []), at(10_000), 2)
    assert m["rewritten"] == [] and set(p["folder"] for p in m["parts"].values()) == {folder}
    assert found(store.read()) == {"key7": "new", "other": "new"}


@pytest.mark.parametrize("when", ["data", "manifest"])
def test_crash_and_retry(spark, monkeypatch, when):
    path = tempfile.mkdtemp(prefix="gw-kv-")
    store = KeyedStore(spark, path, first_buckets=2)
    store.apply(entries(spark, [("a", 100, "1"), ("b", 100, "1")]), at(0), 0)
    write = files.write_json

    def broken(s, p, value):
        if when == "manifest":
            write(s, p, value)
        raise OSError("lost")

    monkeypatch.setattr(files, "write_json", broken)
    with pytest.raises(OSError):
        store.apply(entries(spark, [("b", 200, "2"), ("c", 200, "2")]), at(0), 1)
    monkeypatch.setattr(files, "write_json", write)
    # a reader sees the old version or the new one, never a part of it
    assert found(store.read()) == ({"a": "1", "b": "1"} if when == "data" else {"a": "1", "b": "2", "c": "2"})
    store.apply(entries(spark, [("b", 200, "2"), ("c", 200, "2")]), at(0), 1)
    assert found(store.read()) == {"a": "1", "b": "2", "c": "2"} and found(store.read(before=1)) == {"a": "1", "b": "1"}
    assert len([f for f in os.listdir(os.path.join(path, "data")) if f.startswith("1-")]) == 1


def history(spark, path, hours):
    """One entry per (key, hour number), written as the score job writes it."""
    rows = spark.createDataFrame([(f"k{k}", h * 3600 + 60 * k, f"v{k}@{h}") for h in hours for k in range(h % 3 + 1, 6)], "key string, s long, value string")
    (rows.select(F.timestamp_seconds(F.col("s") + 3600).alias("expire_at"), "key", "value", B.hour_of(F.timestamp_seconds("s")).alias("hour"))
     .withColumn("batch_id", F.lit(0)).write.partitionBy("hour", "batch_id").parquet(path))


def test_restore_reads_only_unmarked_live_hours(spark):
    tmp = tempfile.mkdtemp(prefix="gw-restore-")
    hist, store = os.path.join(tmp, "hist"), KeyedStore(spark, os.path.join(tmp, "store"))
    hours = list(range(472_000, 472_030))
    history(spark, hist, hours)
    now = hours[-1] * 3600 + 1800
    want = found(B.live(B.read_history(spark, hist), at(now)))
    assert want and restore.hours_to_restore(store, now).count() == 2
    rows = restore.restorable(B.read_history(spark, hist), store, now)
    assert found(rows.select("key", "value")) == want
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    # older hours are not opened: their files may be unreadable
    for h in hours[:-2]:
        name = spark.range(1).select(B.hour_of(at(h * 3600))).first()[0]
        for d, _, names in os.walk(os.path.join(hist, f"hour={name}")):
            for n in names:
                if n.endswith(".parquet"):
                    open(os.path.join(d, n), "w").write("no parquet")
    assert found(rows.select("key", "value")) == want

    # an empty store gets everything and marks the hours
    assert restore.restore_store(spark, hist, store, at(now), 5) == len(want)
    assert found(store.read()) == want and store.healthy_hours().count() == 2
    # a healthy one is left alone
    before = store.versions()
    assert restore.restore_store(spark, hist, store, at(now), 6) == 0 and store.versions() == before
    # keys the store has are not replaced, lost hours are read again
    store.apply(entries(spark, [("k4", now + 9_000, "newer")]), at(now), 7)
    files.delete(spark, f"{store.path}/markers")
    assert restore.restore_store(spark, hist, store, at(now), 8) == 0
    assert found(store.read()) == want | {"k4": "newer"}


def test_restore_without_history(spark):
    tmp = tempfile.mkdtemp(prefix="gw-restore-")
    store = KeyedStore(spark, os.path.join(tmp, "store"))
    assert restore.restore_store(spark, os.path.join(tmp, "none"), store, at(1_700_000_000), 0) == 0
    assert store.read().count() == 0 and store.healthy_hours().count() > 0


def test_restart_after_a_lost_store(spark):
    import shutil

    from gatewatch.sources.rules import fixture_rules
    from test_streaming import _busy_records, _score_sink
    tmp = tempfile.mkdtemp(prefix="gw-lost-")
    sink = _score_sink(spark, tmp, fixture_rules(spark))
    sink(_busy_records(spark, 12), 0)
    sink(_busy_records(spark, 12, 12), 1)
    want = found(B.read_store(spark, sink.store))
    assert want
    assert J.restore_after_loss(sink, spark) == 0  # marked hours
    shutil.move(sink.store, sink.store + "-lost")
    assert J.restore_after_loss(sink, spark) == len(want)
    assert found(B.read_store(spark, sink.store)) == want
    sink(_busy_records(spark, 6, 24), 2)
    assert set(found(B.read_store(spark, sink.store))) >= set(want)
