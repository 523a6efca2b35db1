"""Address sets as bitmaps (F7, A8, C32) and stored sketches."""

import ipaddress
import os
import random

from pyspark.sql import functions as F

from gatewatch.config import WindowSpec
from gatewatch.operators import features as fe
from gatewatch.operators import ip_set as IP
from gatewatch.operators import sketches as SK


def test_addresses_blocks_and_texts(spark):
    rng = random.Random(3)
    near = [f"10.1.{rng.randrange(4)}.{rng.randrange(256)}" for _ in range(3000)]
    listed = near[:1500] + ["10.2.0.0/16", "192.168.7.0/24", "172.16.0.9/32", "0.0.0.0", "255.255.255.255", "200.0.0.0/7", "NULL", "010.0.0.1", "::1", "1.2.3",
                            "9.9.9.9/33", "", None, "10.1.0.0/x", near[0]]
    ips = near + ["10.2.255.1", "10.3.0.0", "192.168.7.255", "192.168.8.0", "172.16.0.9", "172.16.0.8", "0.0.0.0", "255.255.255.255", "201.9.9.9", "202.0.0.0", "NULL",
                  "10.0.0.1", "010.0.0.1", "::1", "1.2.3", "9.9.9.9", "9.9.9.9/33", "", None, "256.1.1.1", "1.2.3.4 "]
    sets = IP.ip_set(spark.createDataFrame([(x,) for x in listed], "ip_name string"))
    assert sets.lengths == [7, 16, 24, 32]
    kinds = {(r["few"] is None, r["bits"] is None) for r in sets.buckets.collect()}
    assert kinds == {(False, True)} or kinds == {(False, True), (True, False)}
    blocks = [ipaddress.ip_network(x) for x in ("10.2.0.0/16", "192.168.7.0/24", "172.16.0.9/32", "200.0.0.0/7")]

    def want(ip):
        if ip is None:
            return False
        try:
            a = ipaddress.ip_address(ip)
            return ip in listed or (a.version == 4 and any(a in b for b in blocks))
        except ValueError:
            return ip in listed
    df = spark.createDataFrame([(i, x, "k") for i, x in enumerate(ips)], "id int, remote_addr string, extra string")
    out = IP.flag_in_set(df, sets)
    assert out.columns == ["id", "remote_addr", "extra", "listed"]
    assert {r["id"]: r["listed"] for r in out.collect()} == {i: want(x) for i, x in enumerate(ips)}
    assert IP.listed_rows(df, sets).count() == sum(map(want, ips))


def test_dense_buckets_are_bitmaps(spark):
    listed = spark.range(0, 200_000, 3).select(F.concat_ws(".", F.lit("10"), F.expr("id div 65536"), F.expr("id div 256 % 256"), F.expr("id % 256")).alias("ip_name"))
    sets = IP.ip_set(listed)
    assert sets.buckets.filter("bits IS NULL").count() <= 1 and sets.buckets.count() <= 7
    rows = spark.range(0, 210_000).select("id", F.concat_ws(".", F.lit("10"), F.expr("id div 65536"), F.expr("id div 256 % 256"), F.expr("id % 256")).alias("remote_addr"))
    got = IP.flag_in_set(rows, sets)
    assert got.filter(F.col("listed") != ((F.col("id") % 3 == 0) & (F.col("id") < 200_000))).count() == 0


def test_many_addresses_without_their_strings(spark):
    """A long list of single addresses in dense networks (GATEWATCH_LISTED: ten million take 100 s)."""
    n = int(os.environ.get("GATEWATCH_LISTED", "1000000"))
    ip = F.concat_ws(".", F.expr("100 + id div 16777216"), F.expr("id div 65536 % 256"), F.expr("id div 256 % 256"), F.expr("id % 256"))
    sets = IP.ip_set(spark.range(n).select(ip.alias("ip_name")))
    assert sets.buckets.count() == -(-n // 32768)
    size = sets.buckets.agg(F.sum(F.octet_length(F.coalesce("bits", F.lit(b"")))), F.sum(F.size(F.coalesce("few", F.array())) * 4)).first()
    assert sum(size) < 2_000_000  # the strings are 130 MB
    rows = spark.range(0, 2 * n, 9_973).select("id", ip.alias("remote_addr"))
    got = IP.flag_in_set(rows, sets)
    assert got.filter(F.col("listed") != (F.col("id") < n)).count() == 0 and got.filter("listed").count() == -(-n // 9_973)


def records(spark, n, kinds):
    at = F.timestamp_seconds(1_700_000_000 + F.col("id") % 600)
    return spark.range(n).select(
        F.concat(F.lit("10.0.0."), F.col("id") % 3).alias("ip"), F.concat(F.lit("u"), F.xxhash64("id") % kinds).alias("user_agent"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.xxhash64("id", F.lit(1)) % kinds)).alias("session_id"), F.lit(None).cast("string").alias("dep_city"),
        F.concat(F.lit("B"), F.col("id") % 4).alias("arr_city"), (F.col("id") % 2 == 0).alias("critical"), F.lit("/a").alias("request"), at.alias("ts"))


SIZES = [WindowSpec("30 seconds", "30 seconds"), WindowSpec("2 minutes", "30 seconds"), WindowSpec("10 minutes", "1 minute")]


def test_one_table_serves_three_window_sizes(spark):
    recs = records(spark, 3000, 9)
    table = SK.sketch_table(recs, "30 seconds").persist()
    for w in SIZES:
        got = SK.window_distincts(table, w, "30 seconds")
        want = fe.ip_features(recs, w, "direct").select("window_end", "ip", *SK.KINDS.values())
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 0  # small sets: exact


def test_error_of_large_sets(spark):
    recs = records(spark, 120_000, 50_000)
    table = SK.sketch_table(recs, "30 seconds").persist()
    for w in SIZES:
        got = SK.window_distincts(table, w, "30 seconds").alias("g")
        want = fe.ip_features(recs, w, "direct").alias("w")
        j = got.join(want, ["window_end", "ip"])
        worst = j.select(F.max(F.abs(F.col("g.ua_distinct") / F.col("w.ua_distinct") - 1))).first()[0]
        assert worst < 0.07  # four standard errors of 1.6 %
