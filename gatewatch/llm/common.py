"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.session import materialize  # noqa: F401  (shared-folder tables)

#: Rows a side may have to be broadcast; the tables concerned hold short rows.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after at most ``max_rows + 1`` rows were counted; beyond
    that the same join runs as a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def ship_code(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once per Spark context, so that Python functions
    find it whatever the workers' path is."""
    context = spark.sparkContext
    if getattr(context, "_gatewatch_shipped", False):
        return spark
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
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


def row_key(*cols: Column) -> list[Column]:
    """96 hash bits that identify a row by the given columns; null differs from ''.

    Rows equal in all of them share a key, so results joined back by it are the same
    for repeated rows and no row id has to be invented."""
    marked = [c for x in cols for c in (x.isNull(), x)]
    return [F.xxhash64(*marked).alias("__k1"), F.hash(*reversed(marked)).alias("__k2")]


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
