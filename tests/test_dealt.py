"""The events are dealt out before lines are made, documents are tested once, windows are sorted in small partitions."""

import datetime

from pyspark.sql import functions as F

from gatewatch.functions import xml as X
from gatewatch.plans.catalog import QUERIES
from gatewatch.plans.context import Ctx
from gatewatch.plans.irregular import QUERIES as IRREGULAR
from gatewatch.session import SHUFFLED_BYTES, shuffle_finely

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _events(spark, folder, n=400):
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at + datetime.timedelta(minutes=i), i % 9, ("view", "click", "purchase")[i % 3], i / 7, '{"k": 1}') for i in range(n)]
    rows += [(7, None, None, None, None, None), (None, at, 1, "view", 1.0, None), rows[0], rows[0]]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_made_after_the_exchange(spark, tmp_path):
    rows = _events(spark, tmp_path)
    c = Ctx(spark, str(tmp_path))
    assert c.dealt_events().rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(map(repr, c.dealt_events().collect())) == sorted(map(repr, spark.createDataFrame(rows, EVENTS).collect()))
    for name, made in (("irregular_cookies", "irregular"), ("link_snapshot", "regular")):
        plan = _plan(QUERIES[name](spark, str(tmp_path)))
        below = plan[plan.rindex("Exchange hashpartitioning(__at"):]
        assert "concat_ws" not in below and "split(" not in below, (made, below)
    plan = _plan(IRREGULAR["book_xml_body"](spark, str(tmp_path)))
    assert "concat_ws" not in plan[plan.rindex("Exchange hashpartitioning(__at"):]


def test_many_partitions_are_dealt_in_two_steps(spark, tmp_path, monkeypatch):
    from gatewatch.plans import context
    rows = _events(spark, tmp_path)
    monkeypatch.setattr(context, "DEAL_AT_ONCE", 3)
    dealt = Ctx(spark, str(tmp_path)).dealt_events()
    n = max(4, spark.sparkContext.defaultParallelism)
    plan = _plan(dealt)
    assert dealt.rdd.getNumPartitions() >= n
    assert plan.count("Exchange hashpartitioning(__at") == 2
    assert ", 3), " in plan[plan.rindex("Exchange hashpartitioning(__at"):]
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, spark.createDataFrame(rows, EVENTS).collect()))


def test_only_the_columns_of_the_score_job_are_cached(spark, tmp_path):
    from gatewatch.plans.score_job import INPUT
    _events(spark, tmp_path)
    c = Ctx(spark, str(tmp_path))
    assert c.score_input().columns == list(INPUT)
    want = c.processed().select(*INPUT).collect()
    assert sorted(map(repr, c.score_input().collect())) == sorted(map(repr, want))
    spark.catalog.clearCache()


def test_a_document_is_tested_once(spark):
    df = spark.createDataFrame([("<r><a>x</a><a>y</a></r>",), ("<r><a>x</r>",), ("",), (None,)], "x string").withColumn("d", X.document(F.col("x")))
    got = df.select(X.text_at(F.col("d"), "//a/text()"), X.nodes_at(F.col("d"), "//a/text()")).collect()
    want = df.select(X.xml_text(F.col("x"), "//a/text()"), X.xml_nodes(F.col("x"), "//a/text()")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] == [("x", ["x", "y"]), (None, None), (None, None), (None, None)]


def test_shuffles_are_fine(spark):
    first, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "8")
    shuffle_finely(session, 3)
    assert session.conf.get(first, None) is None and session.conf.get(size) == str(SHUFFLED_BYTES)
    shuffle_finely(session, 70)
    assert session.conf.get(first) == "70"
    session.conf.set(size, "1m")
    shuffle_finely(session, 70)
    assert session.conf.get(size) == "1m"


def test_state_partitions_follow_the_rows(spark, tmp_path, monkeypatch):
    from gatewatch.plans import catalog
    monkeypatch.setattr(catalog, "STATE_ROWS", 100)
    monkeypatch.setattr(catalog, "LARGE_STATE", 200)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    rows = spark.range(650).select((F.col("id") % 10).alias("k"), F.timestamp_seconds("id").alias("ts"))
    src, run = catalog._stream(spark, rows)
    seen = src.withWatermark("ts", "0 seconds").groupBy(F.window("ts", "10 seconds").alias("w"), "k").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.select("k", "n", F.spark_partition_id().alias("p"))
    got = run(seen).collect()
    assert len(got) == 640 and 4 < len({r["p"] for r in got}) <= 7
    assert before == {k: spark.conf.get(k) for k in before}
