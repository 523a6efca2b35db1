"""Restore of the keyed store after a loss.

The history is partitioned by hour. Live entries can only stand in the hours of the last
lifetime, and of these only the hours without a health marker in the store are read: the
hours are a small table joined to the history on its partition column, so the scan prunes
its folders when the join's other side is known (dynamic partition pruning). Of their rows
the latest live one per key is put in, where the store has no entry of that key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.config import BLACKLIST_TTL_S
from gatewatch.operators import blacklist as B
from gatewatch.streaming import files
from gatewatch.streaming.store import KeyedStore

HOUR_S = 3600


def hours_to_restore(store: KeyedStore, now_s: int, ttl_s: int = BLACKLIST_TTL_S) -> DataFrame:
    """Hours that may hold an entry live at ``now_s`` and that the store has not marked."""
    first = (now_s - ttl_s) // HOUR_S
    hours = (store.spark.range(first, now_s // HOUR_S + 1).filter(F.col("id") * HOUR_S + HOUR_S + ttl_s > now_s)
             .select(B.hour_of(F.timestamp_seconds(F.col("id") * HOUR_S)).alias("hour")))
    return hours.join(store.healthy_hours().select("hour"), "hour", "left_anti")


def restorable(history: DataFrame, store: KeyedStore, now_s: int, ttl_s: int = BLACKLIST_TTL_S) -> DataFrame:
    """Entries to put back: from unmarked hours, the latest live one of each key the store lacks."""
    lost = history.join(F.broadcast(hours_to_restore(store, now_s, ttl_s)), "hour", "left_semi")  # ttl / 1 h + 2 rows at most
    return B.restore(lost, store.read(), F.timestamp_seconds(F.lit(now_s)))


def restore_store(spark: SparkSession, history_path: str, store: KeyedStore, now: Column, batch_id: int, ttl_s: int = BLACKLIST_TTL_S) -> int:
    """Runs the restore and marks the hours; number of entries put back. A store whose hours
    are all marked is left as it is, a history that does not exist yet restores nothing."""
    now_s = spark.range(1).select(F.unix_seconds(now)).first()[0]
    lost = [r[0] for r in hours_to_restore(store, now_s, ttl_s).collect()]
    if not lost:
        return 0
    there = any(n.startswith("hour=") for n in files.children(spark, history_path))
    rows = restorable(B.read_history(spark, history_path), store, now_s, ttl_s) if there else None
    n = rows.persist().count() if there else 0
    if n:
        store.apply(rows, F.timestamp_seconds(F.lit(now_s)), batch_id, on_newest=True)
        rows.unpersist()
    store.mark_hours(lost, batch_id)
    return n
