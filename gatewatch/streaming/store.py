"""Keyed store with expiry as hash buckets, written bucket by bucket.

Layout under the store's folder::

    data/<batch>-<attempt>/b=<bucket>/*.parquet   the buckets a batch has rewritten
    manifest/<batch>.json                         which folder holds each bucket
    markers/<hour>.json                           hours of the history the store has taken up

A batch reads and rewrites the buckets its keys fall into and nothing else; the manifest,
renamed into place last, makes the new buckets visible together. A crash before that leaves
the old version in force, and a retried batch starts from the version before its own again.

Buckets grow by linear hashing: with n buckets, a hash belongs to its remainder modulo the
largest power of two below or at n, or modulo the next one where that bucket is split
already. So n rises by single buckets, each split rewrites one bucket, and a bucket's size
stays near ``target_rows`` however large the store gets: bytes written follow the batch.

An entry whose time has passed is not returned; its row goes when its bucket is rewritten,
and a bucket whose last entry has expired is dropped by its manifest line alone. The
manifest has one line per bucket (a billion keys at 50,000 a bucket: 20,000 lines)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.operators import blacklist as B
from gatewatch.streaming import files

FIRST_BUCKETS = 16
TARGET_ROWS = 50_000
KEEP = 3  # manifests, and the folders they name


def bucket_of(key: Column, n: int) -> Column:
    """Linear-hashing bucket of a key among n buckets."""
    low = 1 << (n.bit_length() - 1)
    h = F.xxhash64(key)
    b = F.pmod(h, F.lit(low))
    return F.when(b < n - low, F.pmod(h, F.lit(2 * low))).otherwise(b).cast("int")


def origin(bucket: int, n: int) -> int:
    """The bucket among n that held the keys of a later bucket."""
    while bucket >= n:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


class KeyedStore:
    """Latest entry per key (key, expire_at, value). One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, target_rows: int = TARGET_ROWS, first_buckets: int = FIRST_BUCKETS, keep: int = KEEP):
        self.spark, self.path = spark, path.rstrip("/")
        self.target_rows, self.first_buckets, self.keep = target_rows, first_buckets, keep

    # ---- versions

    def versions(self) -> list[int]:
        names = files.children(self.spark, f"{self.path}/manifest")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, before: int | None = None) -> dict:
        """The newest manifest (before a batch id); an empty store's if there is none."""
        found = [v for v in self.versions() if before is None or v < before]
        if not found:
            return {"version": None, "buckets": self.first_buckets, "now_us": None, "parts": {}}
        return files.read_json(self.spark, f"{self.path}/manifest/{found[-1]}.json")

    # ---- reads

    def _rows(self, manifest: dict, buckets=None) -> DataFrame:
        parts = manifest["parts"]
        paths = [f"{self.path}/data/{p['folder']}/b={b}" for b, p in parts.items() if buckets is None or int(b) in buckets]
        if not paths:
            return self.spark.createDataFrame([], B.STORE_SCHEMA)
        return self.spark.read.schema(B.STORE_SCHEMA).parquet(*paths)

    def read(self, before: int | None = None) -> DataFrame:
        """The live entries as of the newest batch (before a batch id)."""
        m = self.manifest(before)
        rows = self._rows(m)
        return rows if m["now_us"] is None else rows.filter(F.unix_micros("expire_at") > m["now_us"])

    def lookup(self, keys: DataFrame, column: str = "key") -> DataFrame:
        """Live entries of the given keys; only the buckets they fall into are read."""
        m = self.manifest()
        hit = {r[0] for r in keys.select(bucket_of(F.col(column), m["buckets"])).distinct().collect()}
        rows = self._rows(m, hit).join(keys.select(F.col(column).alias("key")).distinct(), "key", "left_semi")
        return rows if m["now_us"] is None else rows.filter(F.unix_micros("expire_at") > m["now_us"])

    # ---- writes

    def apply(self, entries: DataFrame, now: Column, batch_id: int, on_newest: bool = False) -> dict:
        """Takes up a batch (key, expire_at, value): the latest entry per key over old and new,
        without those that have expired at ``now``. ``on_newest`` adds to the newest version,
        also if that is this batch's own (restore). Returns the manifest."""
        m = self.manifest(None if on_newest else batch_id)
        n, parts = m["buckets"], m["parts"]
        now_us = self.spark.range(1).select(F.unix_micros(now)).first()[0]
        new = entries.select("key", "expire_at", "value").filter(F.col("key").isNotNull() & (F.unix_micros("expire_at") > now_us))
        per = new.groupBy(bucket_of(F.col("key"), n).alias("b")).agg(F.count(F.lit(1)).alias("rows")).collect()
        grown = sum(r["rows"] for r in per)
        total = grown + sum(p["rows"] for p in parts.values())
        # enough splits to keep up with what the batch adds, few enough to stay a part of it
        splits = max(0, min(-(-total // self.target_rows) - n, 1 + 2 * grown // self.target_rows))
        touched = {r["b"] for r in per} | {origin(b, n) for b in range(n, n + splits)}
        n += splits
        # numbered before the old rows are read, so that a bucket's line changes only with its files
        live = {b: p for b, p in parts.items() if int(b) not in touched and p["last_us"] > now_us}
        if touched:
            folder = f"{int(batch_id)}-{uuid.uuid4().hex[:8]}"
            merged = B.upsert_store(self._rows(m, touched), new, F.timestamp_micros(F.lit(now_us)))
            root = f"{self.path}/data/{folder}"
            (merged.withColumn("b", bucket_of(F.col("key"), n)).hint("rebalance", "b")
             .write.mode("overwrite").partitionBy("b").parquet(root))
            if any(c.startswith("b=") for c in files.children(self.spark, root)):
                wrote = (self.spark.read.schema(B.STORE_SCHEMA + ", b int").parquet(root).groupBy("b")
                         .agg(F.count(F.lit(1)).alias("rows"), F.max(F.unix_micros("expire_at")).alias("last_us")).collect())
                live |= {str(r["b"]): {"folder": folder, "rows": r["rows"], "last_us": r["last_us"]} for r in wrote}
        out = {"version": int(batch_id), "buckets": n, "now_us": now_us, "parts": live, "rewritten": sorted(touched)}
        files.write_json(self.spark, f"{self.path}/manifest/{int(batch_id)}.json", out)
        self._clean(int(batch_id), {p["folder"] for p in live.values()})
        return out

    def _clean(self, batch_id: int, mine: set[str]) -> None:
        """Deletes old manifests with the buckets only they name, and what failed attempts of
        this batch have left."""
        versions = self.versions()
        keep = versions[-self.keep:]
        read = lambda v: {(p["folder"], b) for b, p in files.read_json(self.spark, f"{self.path}/manifest/{v}.json")["parts"].items()}
        named = set().union(*(read(v) for v in keep))
        for v in versions[:-self.keep]:
            for folder, b in read(v) - named:
                files.delete(self.spark, f"{self.path}/data/{folder}/b={b}")
                if not any(c.startswith("b=") for c in files.children(self.spark, f"{self.path}/data/{folder}")):
                    files.delete(self.spark, f"{self.path}/data/{folder}")
            files.delete(self.spark, f"{self.path}/manifest/{v}.json")
        used = {folder for folder, _ in named} | mine
        for folder in files.children(self.spark, f"{self.path}/data"):
            if folder not in used and int(folder.split("-")[0]) <= batch_id:
                files.delete(self.spark, f"{self.path}/data/{folder}")

    # ---- health

    def mark_hours(self, hours, batch_id: int, oldest: str | None = None) -> None:
        """Notes that the store has the history's entries of these hours; notes older than
        ``oldest`` go. Markers are kept in the store, so they are lost with it."""
        for h in hours:
            files.write_json(self.spark, f"{self.path}/markers/{h}.json", {"hour": h, "batch_id": int(batch_id)})
        if oldest:
            for n in files.children(self.spark, f"{self.path}/markers"):
                if n.endswith(".json") and n.removesuffix(".json") < oldest:
                    files.delete(self.spark, f"{self.path}/markers/{n}")

    def healthy_hours(self) -> DataFrame:
        """(hour, batch_id) of the hours the store has taken up."""
        schema = "hour string, batch_id long"
        path = f"{self.path}/markers"
        if not any(n.endswith(".json") for n in files.children(self.spark, path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{path}/*.json")
