"""Shared inputs of the registered queries: driver tables, fixture rules, the access
log view and the processed records (cached by Spark when first computed). Building a
query starts no job but the reads of the rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.config import FIXTURE_WINDOW
from gatewatch.session import prepare, shuffle_finely
from gatewatch.sources.adapters import raw_lines
from gatewatch.sources.rules import fixture_rules
from gatewatch.sources.tables import read_table

WINDOW = FIXTURE_WINDOW
HANDOVER = "gatewatch.processed:"
DEAL_BYTES = 1 << 20  # of the events' files for a task: tens of thousands of rows
DEAL_AT_ONCE = 200  # Spark's bypassMergeThreshold: for more partitions a task holds all its rows, to sort them by partition


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.tables = fixture_rules(spark)
        self.window = WINDOW
        self._read: dict = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.sf_dir, name)
        return self._read[name]

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    def dealt_events(self) -> DataFrame:
        """The events, dealt out before lines are made of them. The driver's tables are one file
        of one row group, which one task reads, so that task does no more than pass the narrow
        rows on: to as many partitions as the files have ``DEAL_BYTES`` (files are listed, nothing
        is read). A table of more files than that is taken as it is. Rows go by their place in the
        scan, which a retry finds again: unlike a round robin, no sort of the whole task. Filters
        are not moved before a column that depends on the partition, so that what they test (the
        parsed lines) is made by the tasks after the exchange. More than ``DEAL_AT_ONCE`` partitions
        are dealt out in two steps, so that the reading task passes rows on without holding them."""
        size = int(self.events._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        n = max(self.spark.sparkContext.defaultParallelism, -(-size // DEAL_BYTES))
        shuffle_finely(self.spark, n)
        if len(self.events.inputFiles()) >= n:
            return self.events
        dealt = self.events.withColumn("__at", F.monotonically_increasing_id())
        here = F.when(F.spark_partition_id() >= 0, F.col("event_id"))
        if n > DEAL_AT_ONCE:
            dealt = dealt.repartition(DEAL_AT_ONCE, "__at").withColumn("event_id", here)
        return dealt.repartition(n, "__at").drop("__at").withColumn("event_id", here)

    def raw_lines(self) -> DataFrame:
        """Wire lines of the adapter."""
        return raw_lines(self.dealt_events())

    def access(self) -> DataFrame:
        """Parsed access log (C1) over the wire lines of the adapter."""
        from gatewatch.operators.ingest import parse_access_log
        return parse_access_log(self.raw_lines())

    def _processed(self, *cols: str) -> DataFrame:
        from gatewatch.plans.enrich_job import enrich_lines
        path = self.spark.conf.get(HANDOVER + self.sf_dir, None)
        if path:
            return self.spark.read.parquet(path)
        found = enrich_lines(self.raw_lines(), self.tables)
        return (found.select(*cols) if cols else found).persist()

    def processed(self) -> DataFrame:
        """Processed records (H6 output), the hand-over between the data job and the score
        job: the table named by ``hand_over`` if the data job has written one, else computed
        from the raw lines. These are marked for caching: the first action computes them,
        equal plans share them."""
        return self._processed()

    def score_input(self) -> DataFrame:
        """The processed records for the score job: of those computed from the raw lines, the
        columns that it reads, so that no others are made and cached."""
        from gatewatch.plans.score_job import INPUT
        return self._processed(*INPUT)

    def hand_over(self) -> DataFrame:
        """Runs the data job: writes the processed records to the shared folder, where
        ``processed`` finds them from now on in this session."""
        from gatewatch.session import materialize, quick_planning
        frame = self.processed()
        with quick_planning(self.spark):
            table = materialize(frame, "processed")
        frame.unpersist()
        self.spark.conf.set(HANDOVER + self.sf_dir, table.inputFiles()[0].rsplit("/", 1)[0])
        return table
