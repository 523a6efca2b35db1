"""The keyed-store sink publishes every batch exactly once."""

import os
import tempfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gatewatch.streaming import sink as SI

SCHEMA = "key string, value string, expire_at timestamp, tags array<string>"


class Flaky(SI.FileClient):
    """Fails once: before a batch is published, or after it."""

    def __init__(self, options):
        super().__init__(options)
        self.when, self.mark = options["fails"], options["path"] + "-failed"

    def publish(self, batch_id, names):
        fail = batch_id == 1 and not os.path.exists(self.mark)
        if fail and self.when == "before":
            open(self.mark, "w").close()
            raise OSError("killed commit")
        done = super().publish(batch_id, names)
        if fail:
            open(self.mark, "w").close()
            raise OSError("killed after the commit")
        return done


def source(spark, tmp, n=4):
    for i in range(n):
        rows = spark.range(i * 50, i * 50 + 50).select(
            F.concat(F.lit("k"), "id").alias("key"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), "id")).alias("value"),
            F.timestamp_seconds("id").alias("expire_at"), F.array(F.lit("a"), F.col("id").cast("string")).alias("tags"))
        rows.coalesce(2).write.parquet(os.path.join(tmp, f"src/p{i}"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(os.path.join(tmp, "src/*"))


def start(stream, tmp, **options):
    q = (stream.writeStream.format("gatewatch_store").options(path=os.path.join(tmp, "store"), **options)
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)


def content(spark, tmp):
    rows = SI.read_published(spark, os.path.join(tmp, "store"), SCHEMA).collect()
    return sorted((r.key, r.value, r.expire_at, tuple(r.tags)) for r in rows)


def test_rows_and_batches(spark):
    SI.register(spark)
    tmp = tempfile.mkdtemp(prefix="gw-sink-")
    stream = source(spark, tmp)
    start(stream, tmp)
    want = sorted((r.key, r.value, r.expire_at, tuple(r.tags)) for r in spark.read.parquet(os.path.join(tmp, "src/*")).collect())
    assert content(spark, tmp) == want and len(want) == 200
    assert len(SI.FileClient({"path": os.path.join(tmp, "store")}).published()) >= 4


@pytest.mark.parametrize("when", ["before", "after"])
def test_killed_commit(spark, when):
    from pyspark.errors import StreamingQueryException
    SI.register(spark)
    spark.sparkContext.addPyFile(os.path.abspath(__file__))  # the client's module, as a user would ship it
    tmp = tempfile.mkdtemp(prefix="gw-sink-")
    stream = source(spark, tmp)
    options = {"client": "test_sink:Flaky", "fails": when}
    with pytest.raises(StreamingQueryException):
        start(stream, tmp, **options)
    seen = content(spark, tmp)
    assert len(seen) == (50 if when == "before" else 100)  # batch 0, and batch 1 if its commit got through
    start(stream, tmp, **options)  # from the checkpoint: batch 1 runs again
    want = sorted((r.key, r.value, r.expire_at, tuple(r.tags)) for r in spark.read.parquet(os.path.join(tmp, "src/*")).collect())
    assert content(spark, tmp) == want
    named = {n for b in SI.FileClient({"path": os.path.join(tmp, "store")}).published().values() for n in b}
    assert {f.removesuffix(".parquet") for f in os.listdir(os.path.join(tmp, "store/rows"))} == named  # nothing left behind


def test_killed_and_repeated_tasks(spark):
    tmp = tempfile.mkdtemp(prefix="gw-sink-")
    schema = spark.createDataFrame([], SCHEMA).schema
    writer = SI._Writer({"path": tmp}, schema)
    rows = [Row(key=f"k{i}", value=None, expire_at=None, tags=None) for i in range(12_000)]

    def breaks():
        yield from rows[:6_000]
        raise OSError("lost executor")

    with pytest.raises(OSError):
        writer.write(breaks())
    first, again, empty = writer.write(iter(rows)), writer.write(iter(rows)), writer.write(iter([]))
    writer.commit([first, empty, None], 0)  # Spark reports one attempt of each task
    assert SI.read_published(spark, tmp, SCHEMA).count() == 12_000
    writer.commit([again], 0)  # the batch once more
    assert SI.read_published(spark, tmp, SCHEMA).count() == 12_000
    third = writer.write(iter(rows[:5]))
    writer.abort([third, None], 1)
    assert SI.read_published(spark, tmp, SCHEMA).count() == 12_000 and third.names[0] + ".parquet" not in os.listdir(os.path.join(tmp, "rows"))
    assert SI.read_published(spark, tmp + "/none", SCHEMA).count() == 0
