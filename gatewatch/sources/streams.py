"""Stream sources (A1, A2) and the optional Kafka wiring.

The tested path is files: a folder of text lines (raw log or wire records) or of
parquet. Kafka needs the spark-sql-kafka package on the classpath; it is used only
when asked for, with the source's offsets kept in the query checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def line_stream(spark: SparkSession, path: str, fmt: str = "text", schema: str | None = None,
                max_files_per_trigger: int | None = None, kafka: dict | None = None) -> DataFrame:
    """A streaming DataFrame with one ``value: string`` column (plus any columns of a
    parquet source). ``fmt``: text | parquet | kafka."""
    r = spark.readStream
    if fmt == "kafka":
        opts = {"startingOffsets": "earliest"}
        opts.update(kafka or {})
        return (r.format("kafka").options(**opts).load()
                .select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        return r.text(path)
    if schema is None:
        schema = spark.read.parquet(path).schema
    return r.schema(schema).parquet(path)


def records_from_wire(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """A2 + C36: a stream (or table) of processed-record wire lines -> typed records,
    ready for the score job (``streaming.jobs.ScoreSink``)."""
    from gatewatch.functions.wire import parse
    return parse(lines, value_col)
