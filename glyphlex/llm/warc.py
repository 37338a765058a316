"""WARC archives as a table of payload chunks.

A payload travels as rows (record, chunk number, bytes) of bounded size, with the
SHA-1 of the payload up to and including the chunk.  No step between the source
table and the archive, and none on the way back, holds a whole record: writers
append chunks to a compressed stream, readers pass chunks on as they decompress.

Records with equal payloads are written once; the others become revisit records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize, prepare

#: Payload bytes of a chunk row, bytes read at a time, rows of a batch by bytes,
#: and archive bytes after which a writer begins a new file.
CHUNK, READ, BATCH, FILE_BYTES = 1 << 18, 1 << 16, 8 << 20, 1 << 30
GZIP_LEVEL = 1
#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def b32(digest: bytes) -> str:
    return b32encode(digest).decode()


def _chunks(payload: memoryview, size: int) -> Iterator[tuple[int, memoryview]]:
    """At least one chunk, also of an empty payload."""
    for k in range(max(1, -(-len(payload) // size))):
        yield k, payload[k * size:(k + 1) * size]


def _views(texts: pa.Array) -> Iterator[memoryview]:
    """Payloads where they lie in the Arrow buffer; null counts as empty."""
    for t in texts.cast(pa.large_binary()):
        b = t.as_buffer()
        yield memoryview(b) if b is not None else memoryview(b"")


def payload_digests(texts: pa.Array, size: int = CHUNK) -> pa.Array:
    out = []
    for v in _views(texts):
        sha = hashlib.sha1()
        for _, part in _chunks(v, size):
            sha.update(part)
        out.append(b32(sha.digest()))
    return pa.array(out, pa.string())


CHUNKS = "digest string, uid long, chunk_no int, running string, data binary"


def _chunk_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(page_id, url, uid, html) -> the chunk rows of each record, in order."""
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        pages, urls, uids = (batch.column(k) for k in range(3))
        for k, v in enumerate(_views(batch.column(3))):
            sha, running = hashlib.sha1(), []
            for _, part in _chunks(v, size):
                sha.update(part)
                running.append(b32(sha.copy().digest()))
            for n, part in _chunks(v, size):
                rows.append((pages[k].as_py(), running[-1], uids[k].as_py(), n, running[n],
                             urls[k].as_py() if n == 0 else None, len(v), bytes(part)))
                held += len(part) + 100
                if held >= BATCH:
                    yield _batch(rows, pages.type)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, pages.type)


def _batch(rows: list[tuple], page_type: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows))
    types = [page_type, pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      ["page_id", "digest", "uid", "chunk_no", "running", "url", "bytes", "data"])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def _record_id(page, digest: str, copy: int = 0) -> str:
    own = hashlib.sha1(f"{page}/{digest}/{copy}".encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=own)}>"


class _Archive:
    """One .warc.gz file; every record is a gzip member of its own."""

    def __init__(self, folder: str):
        self.fs, path = _open(folder)
        self.name = f"{uuid.uuid4().hex}.warc.gz"
        self.out = self.fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.records = self.size = 0
        self.member = None

    def begin(self, head: dict, block: bytes) -> None:
        lines = [VERSION, *(f"{k}: {v}".encode() for k, v in head.items() if v is not None), b"", b""]
        self.member = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
        self.records += 1
        self.add(b"\r\n".join(lines) + block)

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        if self.member is not None:
            self._put(self.member.compress(b"\r\n\r\n"))
            self._put(self.member.flush())
            self.member = None

    def _put(self, data: bytes) -> None:
        self.size += len(data)
        self.out.write(data)

    def close(self) -> tuple[str, int, int]:
        self.end()
        self.out.close()
        return self.name, self.records, self.size


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by record: first what was decided for it, then its chunks."""
    archive, done = None, []
    decided = current = None
    copies = 0
    whole = False
    for batch in batches:
        for r in batch.to_pylist():
            key = (r["page_id"], r["digest"])
            if r["chunk_no"] < 0:
                decided, current, copies = r, None, 0
                continue
            assert decided is not None and key == (decided["page_id"], decided["digest"])
            if r["uid"] != current:  # a new record
                current = r["uid"]
                if archive is not None:
                    archive.end()
                    if archive.size >= FILE_BYTES:
                        done.append(archive.close())
                        archive = None
                archive = archive or _Archive(folder)
                whole = decided["is_response"] and (copies == 0 or not decided["shared"])
                http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {r['bytes']}\r\n\r\n").encode()
                own = _record_id(*key, copies)
                url = "".join((r["url"] or "").split()) or None
                archive.begin({
                    "WARC-Type": "response" if whole else "revisit", "WARC-Record-ID": own,
                    "WARC-Date": date, "WARC-Target-URI": url,
                    "WARC-Payload-Digest": f"sha1:{r['digest']}",
                    "WARC-Profile": None if whole else PROFILE,
                    "WARC-Refers-To": None if whole else _record_id(decided["keep"], r["digest"]),
                    "X-Page-Id": r["page_id"],
                    "X-Refers-To-Page-Id": None if whole else decided["keep"],
                    "Content-Type": "application/http; msgtype=response",
                    "Content-Length": len(http) + (r["bytes"] if whole else 0)}, http)
                copies += 1
            if whole:
                archive.add(r["data"])
    if archive is not None:
        done.append(archive.close())
    if done:
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))],
            ["file", "records", "bytes"])


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, date: str = DATE, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write one record for every row.  Returns the folder and the manifest (file,
    records, bytes); only files in the manifest count, so the remains of a lost
    executor's attempt are never read.

    Of rows with equal payloads of at least ``min_bytes`` the one with the largest
    identifier is a response and the others revisit it; of rows that share that
    identifier too, one is the response.  Shorter payloads are all responses.  A
    null payload is empty; a null identifier is below all others.  An empty table
    writes nothing.  Other columns are not read.  ``folder`` must be one that all
    executors share; by default it lies below the checkpoint folder.
    """
    spark = prepare(pages.sparkSession)
    folder = folder or scratch_path(spark, "warc")
    target, path = _open(folder)
    target.create_dir(path, recursive=True)
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.monotonically_increasing_id().alias("uid"), F.col(f"`{html}`").alias("html"))

    @F.arrow_udf("string")
    def digest(texts: pa.Array) -> pa.Array:
        return payload_digests(texts)

    slim = materialize(rows.select(
        "page_id", digest("html").alias("digest"),
        F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("bytes"))
        .groupBy("page_id", "digest", "bytes").agg(F.count(F.lit(1)).alias("n")), "payloads")
    groups = slim.groupBy(F.col("digest").alias("d"), F.col("bytes").alias("b")).agg(
        F.max("page_id").alias("keep"))
    shared = F.col("bytes") >= min_bytes
    decided = slim.join(groups, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b"))).select(
        "page_id", "digest", shared.alias("shared"), "keep",
        (~shared | F.col("page_id").eqNullSafe(F.col("keep"))).alias("is_response"))
    kind = pages.schema[page_id].dataType.simpleString()
    chunks = rows.mapInArrow(lambda it: _chunk_rows(it, CHUNK),
                             f"page_id {kind}, digest string, uid long, chunk_no int, running string, "
                             "url string, bytes long, data binary")
    both = decided.withColumn("uid", F.lit(-1).cast("long")).withColumn("chunk_no", F.lit(-1)).unionByName(
        chunks, allowMissingColumns=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (both.repartition(n, "page_id", "digest")
             .sortWithinPartitions("page_id", "digest", "uid", "chunk_no"))
    manifest = dealt.mapInArrow(lambda it: _write(it, folder, date), "file string, records long, bytes long")
    return folder, materialize(manifest, "manifest")


class _Stream:
    """Bytes of a .warc.gz file, decompressed as they are asked for."""

    def __init__(self, source):
        self.source, self.inflate, self.raw, self.have = source, zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        while True:
            if self.inflate.eof:  # the next member; all input left is in unused_data
                self.raw, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            ended = False
            if not self.raw:
                self.raw = bytes(self.source.read(READ))
                ended = not self.raw
            data = self.inflate.decompress(self.raw, READ)
            self.raw = b"" if self.inflate.eof else self.inflate.unconsumed_tail
            if data:
                self.have += data
                return True
            if ended:
                return False

    def head(self) -> list[str] | None:
        """Lines up to the next empty one; none at the end of the file."""
        while (end := self.have.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.have.strip():
                    raise ValueError("archive ends within a header")
                return None
        lines, self.have = self.have[:end], self.have[end + 4:]
        return lines.decode().split("\r\n")

    def take(self, most: int) -> bytes:
        if not self.have and not self._more():
            raise ValueError("archive ends within a record")
        out, self.have = self.have[:most], self.have[most:]
        return out


def _fields(lines: list[str]) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in lines[1:] if ": " in x)


READ_COLUMNS = ("record_id string, record_type string, page_id string, refers_to string, url string, "
                "payload_digest string, payload_bytes long, chunk_no int, offset long, running string, "
                "last boolean, data binary")


def _read(batches: Iterator[pa.RecordBatch], folder: str, with_data: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32(),
                                        "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]])
                        for c in READ_COLUMNS.split(", ")])
    source, path = _open(folder)
    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows: list[tuple] = []
            held = 0
            with source.open_input_stream(f"{path}/{name}", compression=None) as f:
                stream = _Stream(f)
                while (lines := stream.head()) is not None:
                    if lines[0] != VERSION.decode():
                        raise ValueError(f"not a WARC record: {lines[0]!r}")
                    head = _fields(lines)
                    left = int(head["Content-Length"])
                    http = stream.head()
                    left -= len("\r\n".join(http).encode()) + 4
                    total = int(_fields(http)["Content-Length"])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    own = (head["WARC-Record-ID"], head["WARC-Type"], head.get("X-Page-Id"),
                           head.get("X-Refers-To-Page-Id"), head.get("WARC-Target-URI"), digest, total)
                    sha, offset, k = hashlib.sha1(), 0, 0
                    while True:
                        part = b""
                        while left and len(part) < CHUNK:
                            part += stream.take(min(left, CHUNK - len(part)))
                            left = total - offset - len(part)
                        sha.update(part)
                        rows.append((*own, k, offset, b32(sha.copy().digest()), not left,
                                     part if with_data else None))
                        held += 300 + len(part) * with_data
                        offset, k = offset + len(part), k + 1
                        if held >= BATCH:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, held = [], 0
                        if not left:
                            break
                    if own[1] == "response" and b32(sha.digest()) != digest:
                        raise ValueError(f"payload of {own[0]} does not have its digest")
                    mark = b""
                    while len(mark) < 4:
                        mark += stream.take(4 - len(mark))
                    if mark != b"\r\n\r\n":
                        raise ValueError("record does not end where its header says")
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunk table of the manifest's files: one row for each chunk of a payload
    (one for a revisit record), with the running digest, ``last`` on a record's
    last chunk, and the digest and length of the full payload on every row.  A
    payload that does not have the digest in its header raises an error."""
    prepare(spark)
    files = [r.file for r in manifest.select("file").collect()]  # a name for each writer task
    names = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)))
    return names.mapInArrow(lambda it: _read(it, folder, with_data), READ_COLUMNS)
