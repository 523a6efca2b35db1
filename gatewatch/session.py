"""SparkSession helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "gatewatch",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, spark-submit supplies
    the master and the settings; this only fills in what is unset."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call sites of every column, recorded over the Python gateway, are most of the time
        # that building a long plan takes
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": "8g",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every operator relies on: UTC wall clock, so event times,
    window boundaries and the oracle agree."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


SHUFFLED_BYTES = 8 << 20


def shuffle_finely(spark: SparkSession, n: int) -> None:
    """Adaptive exchanges start with ``n`` partitions or more and join them up to ``SHUFFLED_BYTES``.
    The shuffled rows of the windows are narrow and much alike: in the memory of the task that
    sorts them they take some fifty times the bytes that they were compressed to, so Spark's
    64 MB would be gigabytes. A smaller size that the session has stays."""
    first, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if n > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(first, str(max(n, int(spark.conf.get(first, None) or 0))))
    if spark.conf.get(size) in ("64MB", "67108864b"):  # Spark's own
        spark.conf.set(size, str(SHUFFLED_BYTES))


@contextmanager
def quick_planning(spark: SparkSession):
    """Plans made inside skip constraint inference, which takes seconds on the data job's
    long expressions: too much for a trigger, nothing for a batch job. The session's own
    setting is put back afterwards."""
    key = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is only read here. Only
    when it is unset and the master is local (tests) is a scratch folder made."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="gatewatch-ckpt-", dir=os.environ.get("GATEWATCH_SCRATCH"))
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir()


def ship_code(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once per Spark context, so that Python functions
    find it whatever the workers' path is."""
    context = spark.sparkContext
    if getattr(context, "_gatewatch_shipped", False):
        return spark
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="gatewatch-code-"), "gatewatch_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    context._gatewatch_shipped = True
    return spark


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back:
    cuts the lineage (a lost executor recomputes from the files, not from the
    source) and lets later stages prune columns. Used between the two jobs, where
    the reference hands records over a topic."""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
