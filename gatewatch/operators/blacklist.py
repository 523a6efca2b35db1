"""Blacklist tables.

The reference keeps live entries in a key-value store with a time to live and an
hourly parquet history used to restore the store after a loss. Here both are
tables: the history is partitioned by ``hour`` (append only), "live" means
``expire_at > now``, and the store is the latest live entry per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.config import BLACKLIST_TTL_S

HOUR_FORMAT = "yyyyMMddHH"
# Schema of the history table; reading with it keeps ``hour`` a string partition
# column (inference would turn yyyyMMddHH into an int).
HISTORY_SCHEMA = "expire_at timestamp, key string, value string, hour string"


def read_history(spark, path: str):
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def hour_of(ts: Column) -> Column:
    return F.date_format(ts, HOUR_FORMAT)


def history_rows(entries: DataFrame) -> DataFrame:
    """B3 row shape: expire_at, key, value and the hour partition of the hit time."""
    return entries.select("expire_at", F.col("bl_key").alias("key"), F.col("bl_value").alias("value"),
                          hour_of(F.col("window_end")).alias("hour"))


def append_history(entries: DataFrame, path: str) -> None:
    """Append to the hourly-partitioned history (no rewrite of existing
    hours, fix 2.J-34)."""
    history_rows(entries).write.mode("append").partitionBy("hour").parquet(path)


def recent_partitions(history: DataFrame, now: Column) -> DataFrame:
    """The partitions of this hour and the previous one; a predicate on the
    partition column, so the scan prunes folders."""
    this_hour = hour_of(now)
    prev_hour = hour_of(now - F.expr("INTERVAL 1 HOUR"))
    return history.filter(F.col("hour").isin(this_hour, prev_hour))


def latest_expiry(history: DataFrame) -> DataFrame:
    """Latest expiry per key."""
    return history.groupBy("key").agg(F.max("expire_at").alias("expire_at"))


def latest_per_key(history: DataFrame) -> DataFrame:
    """exactly one row per key, the latest expiry (ties: greatest value), compared
    as timestamps (fix 2.J-36)."""
    best = F.max_by(F.struct("expire_at", "value"), F.struct("expire_at", "value"))
    return history.groupBy("key").agg(best.alias("b")).select("key", "b.expire_at", "b.value")


def live(history: DataFrame, now: Column, ttl_s: int = BLACKLIST_TTL_S) -> DataFrame:
    """The store: latest entry per key that has not expired at ``now``. An entry lives for
    ``ttl_s`` after its hour, so older hour partitions are not read."""
    if "hour" in history.columns:
        history = history.filter(F.col("hour") >= hour_of(now - F.expr(f"INTERVAL {int(ttl_s)} SECONDS")))
    return latest_per_key(history).filter(F.col("expire_at") > now)


def restore(history: DataFrame, store: DataFrame, now: Column) -> DataFrame:
    """Entries to put back: latest live ones whose key the store lacks."""
    return live(history, now).join(store.select("key").distinct(), "key", "left_anti")


def upsert_store(store: DataFrame, new_entries: DataFrame, now: Column | None = None) -> DataFrame:
    """Keyed store after a batch: latest entry per key over old and new rows, without
    those that have expired at ``now``."""
    merged = latest_per_key(store.select("key", "expire_at", "value").unionByName(
        new_entries.select("key", "expire_at", "value")))
    return merged if now is None else merged.filter(F.col("expire_at") > now)


STORE_SCHEMA = "key string, expire_at timestamp, value string"


def read_store(spark, path: str, before: int | None = None) -> DataFrame:
    """The keyed store's live entries: its newest version (before a batch id)."""
    from gatewatch.streaming.store import KeyedStore
    return KeyedStore(spark, path).read(before)


def write_store(spark, path: str, new_entries: DataFrame, now: Column, batch_id: int) -> None:
    """Applies a batch to the keyed store (``streaming.store``): only the buckets of its keys
    are rewritten. A retried batch starts from the version before its own again."""
    from gatewatch.streaming.store import KeyedStore
    KeyedStore(spark, path).apply(new_entries, now, batch_id)
