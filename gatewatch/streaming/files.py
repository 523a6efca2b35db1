"""Small files of stream state, through Spark's Hadoop file systems (any shared store)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist. Other errors are raised."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def walk(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files below a folder, with their sizes; names starting with . or _ are not data."""
    fs, p = _fs(spark, path)
    out: dict[str, int] = {}
    if not fs.exists(p):
        return out
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith((".", "_")):
            continue
        full = s.getPath().toString()
        full = "/" + full.removeprefix("file:").lstrip("/") if full.startswith("file:") else full
        if s.isDirectory():
            out |= walk(spark, full)
        else:
            out[full] = s.getLen()
    return out


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def in_order(spark: SparkSession, path: str) -> bool:
    """Gives the data files of a folder modification times that follow their names, by which a file
    stream takes them. False on a store that keeps no such times."""
    fs, p = _fs(spark, path)
    found = sorted((s for s in fs.listStatus(p) if not s.getPath().getName().startswith((".", "_"))), key=lambda s: s.getPath().getName())
    first = max((s.getModificationTime() for s in found), default=0) // 1000 * 1000 - 2000 * len(found)
    for i, s in enumerate(found):
        fs.setTimes(s.getPath(), first + 2000 * i, -1)
    times = {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)}
    times = [times[s.getPath().getName()] for s in found]
    return sorted(set(times)) == times


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Whole or not at all: written beside and renamed. A retry finds the same content."""
    fs, p = _fs(spark, path)
    _, tmp = _fs(spark, f"{path}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not rename to {path}")


def read_json(spark: SparkSession, path: str) -> dict:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
