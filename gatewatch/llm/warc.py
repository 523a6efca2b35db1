"""WARC archives with an index.

Writing: pages are dealt to archives; each task writes its archives into the shared folder
through pyarrow's file systems, one gzip member per record, and returns one index row per
record: file, offset, length, URL, digest. The index is written before any record is
read; archives of a failed attempt are never in it, as every attempt names its own files.
Reading: selected index rows are sorted by offset, ranges closer than ``GAP`` are
coalesced into one read of at most ``READ`` bytes, and the records are parsed from that.

Of pages with equal payloads (of at least ``least_bytes``), those with the largest page_id
are response records (null ids count as smallest; repeated rows share the type), others
are revisit records that name the response and carry no payload; the payload's size and
digest stand in every record's header. A null html is an empty payload."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import broadcast_if_small, materialize, ship_code
from gatewatch.session import checkpoint_dir

ARCHIVE_BYTES = 256 * 1024 * 1024
GAP = 64 * 1024
READ = 8 * 1024 * 1024
TASK = 16 * 1024 * 1024  # archive bytes of a reader task
DATE = "1970-01-01T00:00:00Z"
INDEX = "file string, offset long, length long, page_id long, url string, digest string, type string"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest_column(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column: 40 hex digits, 20 bits at a time."""
    hexed, chars = F.sha1(payload), []
    for i in range(8):
        n = F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
        chars += [F.substring(F.lit(_BASE32), F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*chars)


def typed(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_digest, type and refers_to of every row."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("payload_digest", digest_column(F.col("payload")))
    # only digests that several rows have; their table is broadcast after a count, so payloads stay where they are
    best = p.groupBy(F.col("payload_digest").alias("__d")).agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    best = broadcast_if_small(materialize(best, "repeated_digests"))
    p = p.join(best, F.col("payload_digest") == F.col("__d"), "left")
    first = F.col("__d").isNull() | (F.octet_length("payload") < least_bytes) | F.col("page_id").eqNullSafe(F.col("best"))
    return p.select("page_id", "url", "payload", "payload_digest", F.when(first, "response").otherwise("revisit").alias("type"),
                    F.when(~first, F.col("best")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    body = payload if kind == "response" else b""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{digest}|{kind}')}>", "WARC-Date": DATE,
            "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"), "WARC-Payload-Digest": f"sha1:{digest}",
            "X-Payload-Length": len(payload), "X-Page-ID": "" if page_id is None else page_id}
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page-ID": refers_to}
    head |= {"Content-Type": "text/html", "Content-Length": len(body)}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header and body of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("record length differs from its header")
    return fields, rest[:n]


def _writer(root: str, limit: int):
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("digest", pa.string()), ("type", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if out is None or at >= limit:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = z.compress(record(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["type"], r["refers_to"])) + z.flush()
                    out.write(member)
                    rows.append((name, at, len(member), r["page_id"], r["url"], r["payload_digest"], r["type"]))
                    at += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        finally:
            if out is not None:
                out.close()

    return write


def write_archives(pages: DataFrame, root: str | None = None, least_bytes: int = 0, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives under ``root`` (a folder all
    executors share; a new one in the checkpoint folder by default) and returns the index,
    read back from the table written beside them."""
    spark = ship_code(pages.sparkSession)
    root = root or f"{checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    uri = root if "://" in root else f"file://{root}" if root.startswith("/") else root.replace("file:/", "file:///", 1)
    fs, base = pafs.FileSystem.from_uri(uri)
    fs.create_dir(base, recursive=True)
    index = typed(pages, least_bytes).mapInArrow(_writer(uri, limit), INDEX)
    index.write.parquet(f"{root}/index")
    return spark.read.parquet(f"{root}/index").withColumn("root", F.lit(uri))


def ranges(rows: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> Iterator[tuple[int, int, list[int]]]:
    """(offset, length) sorted by offset -> reads (start, end, indices of the records in it)."""
    start = end = 0
    own: list[int] = []
    for i, (at, n) in enumerate(rows):
        if own and (at - end > gap or at + n - start > most):
            yield start, end, own
            own = []
        if not own:
            start = at
        end = max(end, at + n) if own else at + n
        own.append(i)
    if own:
        yield start, end, own


def read_records(selected: DataFrame) -> DataFrame:
    """Records of index rows (as from ``write_archives``, filtered at will): page_id, url,
    payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits). Sizes
    and digests of responses are computed from the bytes read and must match the header."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple = ()
        for batch in batches:
            rows = batch.to_pylist()
            i = 0
            while i < len(rows):
                j = i
                while j < len(rows) and (rows[j]["root"], rows[j]["file"]) == (rows[i]["root"], rows[i]["file"]):
                    j += 1
                part, where = rows[i:j], (rows[i]["root"], rows[i]["file"])
                i = j
                if not opened or opened[0] != where:
                    if opened:
                        opened[1].close()
                    fs, base = pafs.FileSystem.from_uri(where[0])
                    opened = (where, fs.open_input_file(f"{base}/{where[1]}"))
                for start, end, own in ranges([(r["offset"], r["length"]) for r in part]):
                    opened[1].seek(start)
                    block = opened[1].read(end - start)
                    got = []
                    for k in own:
                        at = part[k]["offset"] - start
                        head, body = parse(zlib.decompress(block[at:at + part[k]["length"]], 31))
                        page = int(head["X-Page-ID"]) if head["X-Page-ID"] else None
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if head["WARC-Type"] == "response":
                            if b32encode(hashlib.sha1(body).digest()).decode() != digest or len(body) != int(head["X-Payload-Length"]):
                                raise ValueError(f"payload of page {page} differs from its header")
                            got.append((page, part[k]["url"], len(body), digest, "response", None, body))
                        else:
                            refers = head["X-Refers-To-Page-ID"]
                            got.append((page, part[k]["url"], int(head["X-Payload-Length"]), digest, "revisit", int(refers), None))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), schema, strict=True)], schema=schema)
        if opened:
            opened[1].close()

    ship_code(selected.sparkSession)
    # tasks by the bytes they fetch, not by the bytes of the index
    total = selected.agg(F.sum("length")).first()[0] or 0
    stretch = F.floor(F.col("offset") / TASK)
    placed = (selected.select("root", "file", "offset", "length", "url").repartition(max(1, 2 * -(-total // TASK)), "root", "file", stretch)
              .sortWithinPartitions("root", "file", "offset"))
    return placed.mapInArrow(fetch, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
