"""Streaming sink into a keyed store with a commit protocol.

A Python data source, ``format("gatewatch_store")``. Tasks stage their rows under a name of
their own and report it; the driver publishes a batch's reported names in one step, under the
batch's id. So rows of a killed or repeated task are never published, and a batch that runs
again because its commit was lost finds itself published already and is discarded: each
batch is in the store exactly once.

What staging and publishing mean is up to a client. ``FileClient`` keeps parquet files and one
small file per batch on any file system that pyarrow reaches; an external key-value store is plugged in with
``option("client", "package.module:Class")``, a class with the same four methods."""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

CHUNK = 5_000  # rows a task holds before it stages them


class FileClient:
    """Staged rows as ``<path>/rows/<name>.parquet``, a published batch as
    ``<path>/batches/<id>.json`` with its names."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        uri = self.path if ":" in self.path.split("/")[0] else f"file://{self.path}"
        return pafs.FileSystem.from_uri(uri.replace("file:/", "file:///") if uri.startswith("file:/") and not uri.startswith("file://") else uri)

    def stage(self, chunks: Iterable[pa.Table]) -> list[str]:
        """Writes a task's rows; returns the names to publish."""
        fs, root = self._fs()
        name, writer = uuid.uuid4().hex, None
        try:
            for table in chunks:
                if writer is None:
                    fs.create_dir(f"{root}/rows", recursive=True)
                    writer = pq.ParquetWriter(f"{root}/rows/{name}.parquet", table.schema, filesystem=fs)
                writer.write_table(table)
        finally:
            if writer is not None:
                writer.close()
        return [name] if writer is not None else []

    def published(self) -> dict[int, list[str]]:
        fs, root = self._fs()
        out = {}
        for f in fs.get_file_info(pafs.FileSelector(f"{root}/batches", allow_not_found=True)):
            if f.base_name.endswith(".json"):
                with fs.open_input_stream(f.path) as s:
                    out[int(f.base_name.removesuffix(".json"))] = json.loads(s.read())
        return out

    def publish(self, batch_id: int, names: list[str]) -> bool:
        """All names of a batch at once; False if the batch is published already."""
        fs, root = self._fs()
        done = f"{root}/batches/{batch_id}.json"
        if fs.get_file_info(done).type == pafs.FileType.File:
            return False
        fs.create_dir(f"{root}/batches", recursive=True)
        part = f"{root}/batches/.{batch_id}-{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as s:
            s.write(json.dumps(names).encode())
        fs.move(part, done)
        return True

    def discard(self, names: list[str]) -> None:
        fs, root = self._fs()
        for n in names:
            if fs.get_file_info(f"{root}/rows/{n}.parquet").type == pafs.FileType.File:
                fs.delete_file(f"{root}/rows/{n}.parquet")


def client_of(options: dict):
    where = options.get("client")
    if not where:
        return FileClient(options)
    module, _, name = where.partition(":")
    return getattr(importlib.import_module(module), name)(options)


@dataclass
class Staged(WriterCommitMessage):
    names: list


class _Writer(DataSourceStreamWriter):
    def __init__(self, options: dict, schema):
        self.options, self.schema = dict(options), schema

    def write(self, iterator: Iterator[Row]) -> Staged:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(self.schema, timestamp_utc=True)

        def tables():
            held = []
            for row in iterator:
                held.append(row.asDict(recursive=True))
                if len(held) >= CHUNK:
                    yield pa.Table.from_pylist(held, arrow)
                    held = []
            if held:
                yield pa.Table.from_pylist(held, arrow)

        return Staged(client_of(self.options).stage(tables()))

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        names = [n for m in messages if m is not None for n in m.names]
        client = client_of(self.options)
        if not client.publish(batchId, names):
            client.discard(names)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        client = client_of(self.options)
        kept = set(client.published().get(batchId, []))  # a commit that failed after it had published
        client.discard([n for m in messages if m is not None for n in m.names if n not in kept])


class StoreSink(DataSource):
    """Options: ``path`` (of the file client) and ``client``."""

    @classmethod
    def name(cls) -> str:
        return "gatewatch_store"

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return _Writer(self.options, schema)


def register(spark: SparkSession) -> None:
    from gatewatch.session import ship_code
    ship_code(spark).dataSource.register(StoreSink)


def read_published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of every published batch of a file client."""
    names = [n for batch in FileClient({"path": path}).published().values() for n in batch]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/rows/{n}.parquet" for n in names])
