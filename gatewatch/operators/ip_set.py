"""Address lists as compressed bitmaps.

A list entry is an IPv4 address or a block ``a.b.c.d/len``. Entries of one prefix length are
numbers of ``len`` bits; numbers are gathered into buckets of 2 ** 15, and a bucket is one row:
its members as an array while they are few, as a bitmap of 4 KB beyond that. A row of the data is
tested by a join on the bucket's number and a look at one bit, for each prefix length that
the list has (33 at most), so no address string of the list is shipped or compared. Dense blocks, as
a blacklisted network is, take one bit an address.

Only the usual spelling (four numbers to 255 without leading zeros) is an address; anything
else, in the list or the data, is compared as text, so membership of single entries is exactly equality of strings. Null is
not listed. A bucket table below Spark's byte threshold is broadcast, a larger one is
shuffled by bucket, where adaptive execution splits a hot bucket of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.session import materialize

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_ADDRESS = rf"\A{_OCTET}(\.{_OCTET}){{3}}\z"
FEW = 1024  # members up to which a bucket is an array


def number(ip: Column) -> Column:
    """The 32-bit number of an address, null for any other text."""
    part = F.split(ip, r"\.")
    value = sum((F.get(part, F.lit(i)).try_cast("long") * (1 << 8 * (3 - i)) for i in range(4)), F.lit(0).cast("long"))
    return F.when(ip.rlike(_ADDRESS), value)


class IpSet:
    """``buckets`` (len, bucket, few, bits), ``texts`` (other entries) and the prefix lengths."""

    def __init__(self, buckets: DataFrame, texts: DataFrame, lengths: list[int]):
        self.buckets, self.texts, self.lengths = buckets, texts, lengths


def ip_set(listed: DataFrame, ip_col: str = "ip_name") -> IpSet:
    entry = F.col(ip_col)
    length = F.regexp_extract(entry, r"/(3[0-2]|[12]?\d)\z", 1)
    ip = number(F.when(length == "", entry).otherwise(F.substring_index(entry, "/", 1)))
    rows = listed.filter(entry.isNotNull()).select(
        entry.alias("text"), ip.alias("ip"), F.when(ip.isNotNull(), F.when(length == "", 32).otherwise(length.try_cast("int"))).alias("len"))
    members = (rows.filter("len IS NOT NULL").select("len", F.expr("shiftright(ip, 32 - len)").alias("v"))
               .select("len", F.expr("v div 32768").alias("bucket"), F.expr("CAST(v % 32768 AS INT)").alias("at")).distinct())
    buckets = members.groupBy("len", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.collect_list("at").alias("few"), F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits"))
    buckets = materialize(buckets.select(
        "len", "bucket", F.when(F.col("n") <= FEW, F.array_sort("few")).alias("few"), F.when(F.col("n") > FEW, F.col("bits")).alias("bits")), "ip_buckets")
    texts = rows.filter("len IS NULL").select("text").distinct()
    lengths = sorted(r[0] for r in buckets.select("len").distinct().collect())  # 33 at most
    return IpSet(buckets, texts, lengths)


def _bit(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, at % 8).bitwiseAND(F.lit(1)) == 1


def flag_in_set(df: DataFrame, listed: IpSet, ip_col: str = "remote_addr", out: str = "listed") -> DataFrame:
    """Adds ``out``: whether the address, or a block that holds it, is listed."""
    df = df.withColumn("__ip", number(F.col(ip_col)))
    hits = []
    for n in listed.lengths:
        v = F.shiftright("__ip", 32 - n)
        side = listed.buckets.filter(F.col("len") == n).select(
            F.col("bucket").alias(f"__b{n}"), F.col("few").alias(f"__few{n}"), F.col("bits").alias(f"__bits{n}"))
        df = df.withColumns({f"__v{n}": F.floor(v / 32768).cast("long"), f"__at{n}": (v % 32768).cast("int")})
        df = df.join(side, F.col(f"__v{n}") == F.col(f"__b{n}"), "left")
        at = F.col(f"__at{n}")
        hits.append(F.coalesce(F.array_contains(F.col(f"__few{n}"), at), _bit(F.col(f"__bits{n}"), at), F.lit(False)))
    side = listed.texts.select(F.col("text").alias("__text"), F.lit(True).alias("__other"))
    df = df.join(side, F.when(F.col("__ip").isNull(), F.col(ip_col)) == F.col("__text"), "left")
    hit = F.coalesce(F.col("__other"), F.lit(False))
    for h in hits:
        hit = hit | h
    spare = [c for n in listed.lengths for c in (f"__v{n}", f"__at{n}", f"__b{n}", f"__few{n}", f"__bits{n}")]
    return df.withColumn(out, hit).drop("__ip", "__text", "__other", *spare)


def listed_rows(df: DataFrame, listed: IpSet, ip_col: str = "remote_addr") -> DataFrame:
    """Rows whose address is listed."""
    return flag_in_set(df, listed, ip_col, "__listed").filter("__listed").drop("__listed")
