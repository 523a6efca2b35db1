"""Compaction of archives that grow by small files.

A stream appends to ``<root>/hour=<h>/`` every few seconds, 1,200 files an hour. ``compact``
packs an hour's files into bins of about ``target_bytes`` (first fit, largest first) and writes
every bin of several files as one, all hours in one job, beside the archive::

    <root>-merged/hour=<h>/v=<n>/*        merged files of the hour's nth compaction
    <root>-merged/manifest/<h>.json       the hour's merged files and those they replace

An hour's manifest is renamed into place when its files are complete. ``read`` takes an hour's
files without the replaced ones and with the merged ones, so it sees the rows of a file once,
before, during and after a compaction and also if that stops half-way. Appends to an hour that
has been compacted are simply further files. ``vacuum`` deletes replaced files; readers
that started before the last compaction may still need them, so it is a step of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.streaming import files

TARGET_BYTES = 128 * 1024 * 1024


def pack(sizes: list[int], target: int) -> list[list[int]]:
    """First fit, largest first: indexes of the items of each bin; an item over the target is
    a bin of its own."""
    bins: list[list[int]] = []
    room: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, r in enumerate(room) if sizes[i] <= r), None)
        if at is None:
            bins.append([i])
            room.append(target - sizes[i])
        else:
            bins[at].append(i)
            room[at] -= sizes[i]
    return bins


class Archive:
    """A folder of ``<partition>=<value>`` folders with files of one format."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "text", schema: str | None = None, partition: str = "hour"):
        self.spark, self.root, self.fmt, self.partition = spark, root.rstrip("/"), fmt, partition
        self.schema = schema or "value string"
        self.side = f"{self.root}-merged"

    # ---- what there is

    def hours(self) -> list[str]:
        mark = f"{self.partition}="
        names = set(files.children(self.spark, self.root)) | set(files.children(self.spark, self.side))
        return sorted(n.removeprefix(mark) for n in names if n.startswith(mark))

    def manifest(self, hour: str) -> dict:
        path = f"{self.side}/manifest/{hour}.json"
        return files.read_json(self.spark, path) if files.exists(self.spark, path) else {"version": 0, "merged": {}, "replaced": []}

    def _committed(self) -> set[str] | None:
        """Paths in the file sink's own log, if the archive has one: an attempt that failed
        leaves files that are not in it."""
        if not files.exists(self.spark, f"{self.root}/_spark_metadata"):
            return None
        rows = self.spark.read.format(self.fmt).schema(self.schema).load(self.root)
        return {_plain(p) for p in rows.inputFiles()}

    def live(self, hours: list[str] | None = None) -> dict[str, dict[str, int]]:
        """Per hour the files a reader takes, with their sizes."""
        logged, out = self._committed(), {}
        for hour in self.hours() if hours is None else hours:
            m = self.manifest(hour)
            gone = set(m["replaced"])
            own = files.walk(self.spark, f"{self.root}/{self.partition}={hour}")
            own = {p: n for p, n in own.items() if p not in gone and (logged is None or p in logged)}
            out[hour] = own | m["merged"]
        return out

    # ---- reading

    def _load(self, paths: list[str], base: str) -> DataFrame:
        """The rows with their hour and file; deeper folders (batch, version) are no columns."""
        schema = f"{self.schema}, {self.partition} string"
        rows = self.spark.read.format(self.fmt).schema(schema).option("basePath", base).load(paths)
        names = [f.name for f in self.spark.createDataFrame([], schema).schema]
        return rows.select(*names, _plain_column(F.col("_metadata.file_path")).alias("__file"))

    def read(self, hours: list[str] | None = None) -> DataFrame:
        """The archive's rows with their hour, each once."""
        paths = [p for found in self.live(hours).values() for p in found]
        merged = [p for p in paths if p.startswith(_plain(self.side) + "/")]
        own = [p for p in paths if not p.startswith(_plain(self.side) + "/")]
        parts = [self._load(x, base) for x, base in ((own, self.root), (merged, self.side)) if x]
        if not parts:
            return self.spark.createDataFrame([], f"{self.schema}, {self.partition} string")
        return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).drop("__file")

    # ---- compaction

    def compact(self, hours: list[str] | None = None, target_bytes: int = TARGET_BYTES) -> int:
        """Merges small files of the given hours (normally those no stream appends to any more);
        returns the number of files replaced."""
        rewrite: list[tuple[str, str, int]] = []  # file, hour, bin
        chosen: dict[str, set[str]] = {}
        n_bins = 0
        for hour, found in self.live(hours).items():
            names = sorted(found)
            for members in pack([found[n] for n in names], target_bytes):
                if len(members) > 1:
                    rewrite += [(names[i], hour, n_bins) for i in members]
                    chosen.setdefault(hour, set()).update(names[i] for i in members)
                    n_bins += 1
        if not rewrite:
            return 0
        versions = {h: self.manifest(h)["version"] + 1 for h in chosen}
        plan = self.spark.createDataFrame([(f, b, versions[h]) for f, h, b in rewrite], "__file string, __bin int, v int")
        paths = [f for f, _, _ in rewrite]
        rows = None
        for base in (self.root, self.side):
            here = [p for p in paths if p.startswith(_plain(base) + "/")]
            if here:
                part = self._load(here, base)
                rows = part if rows is None else rows.unionByName(part)
        # a few bytes per file; every bin becomes one task and so one file
        dealt = rows.join(F.broadcast(plan), "__file").drop("__file").repartitionById(n_bins, F.col("__bin")).drop("__bin")
        self._clear(versions)
        dealt.write.mode("append").format(self.fmt).partitionBy(self.partition, "v").save(self.side)
        for hour, old in chosen.items():
            m = self.manifest(hour)
            new = files.walk(self.spark, f"{self.side}/{self.partition}={hour}/v={versions[hour]}")
            kept = {p: n for p, n in m["merged"].items() if p not in old}
            replaced = set(m["replaced"]) | {p for p in old if p not in m["merged"]}
            files.write_json(self.spark, f"{self.side}/manifest/{hour}.json",
                             {"version": versions[hour], "merged": kept | new, "replaced": sorted(replaced)})
        return len(rewrite)

    def _clear(self, versions: dict[str, int]) -> None:
        """Deletes what a compaction that did not get to its manifest has left."""
        for hour, v in versions.items():
            files.delete(self.spark, f"{self.side}/{self.partition}={hour}/v={v}")

    def vacuum(self, hours: list[str] | None = None) -> int:
        """Deletes replaced files and merged files that a later compaction has merged again."""
        n = 0
        for hour in self.hours() if hours is None else hours:
            m = self.manifest(hour)
            old = [p for p in m["replaced"] if files.exists(self.spark, p)]
            old += [p for p in files.walk(self.spark, f"{self.side}/{self.partition}={hour}") if p not in m["merged"]]
            for p in old:
                files.delete(self.spark, p)
            n += len(old)
        return n


def _plain(path: str) -> str:
    """``file:///a`` and ``file:/a`` as ``/a``; other stores keep their scheme."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return path


def _plain_column(path):
    return F.when(path.startswith("file:"), F.regexp_replace(F.url_decode(path), r"^file:/+", "/")).otherwise(F.url_decode(path))
