"""WARC archives as a chunked record table.

Writing: every page is a WARC record (one gzip member per record).  Payloads go
through digest and compressor ``CHUNK`` bytes at a time, so the archive side
never holds a second whole payload.  Of equal payloads of at least
``MIN_REVISIT`` bytes the one with the largest id is stored, the others become
revisit records.  A task writes files of about ``FILE_BYTES`` under names of its
own and returns them as manifest rows; a retried task writes new files, and only
files of the written manifest are ever read.

Reading: archives are streamed and become rows (record id, chunk number) that
carry the bytes and digest so far; the row marked ``last`` has those of the
whole payload.  A stored digest that differs is an error.

Null payload is empty; null id or url is left out of the header and read back
as null.  Rows with equal payload and the same largest id are all stored, and every
row has a record id of its own.  An empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibflow.llm.common import materialize, scratch
from bibflow.session import ship_package

CHUNK = 64 * 1024
FILE_BYTES = 128 << 20
MIN_REVISIT = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records bigint, bytes bigint"
CHUNKS = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int32()), ("page_id", pa.int64()), ("url", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("data", pa.binary()),
                    ("bytes_so_far", pa.int64()), ("sha1_so_far", pa.string()), ("last", pa.bool_()),
                    ("payload_bytes", pa.int64())])
CHUNKS_DDL = ("record_id string, chunk_no int, page_id bigint, url string, record_type string, refers_to bigint, "
              "data binary, bytes_so_far bigint, sha1_so_far string, last boolean, payload_bytes bigint")


def classify(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(page_id, url, payload, sha1, refers_to); refers_to is null for stored records."""
    rows = pages.select(F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "sha256": F.unhex(F.sha2("payload", 256))})
    # Only digests and ids are grouped; a large group of copies is one row from each task.
    copies = materialize(
        rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("sha256")
        .agg(F.max("page_id").alias("stored"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("sha256").alias("s"), "stored"), "payload-copies")
    joined = rows.join(copies, F.col("sha256") == F.col("s"), "left")
    return joined.select("page_id", "url", "payload", "sha1",
                         F.when(~F.col("page_id").eqNullSafe(F.col("stored")), F.col("stored")).alias("refers_to"))


def record_id(page_id: int | None, url: str | None, place: str = "") -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {place}").urn


def header(page_id, url, sha1: str, size: int, refers_to, place: str = "") -> bytes:
    """The WARC header and the HTTP head of one record, up to its payload.

    ``place`` (archive and number in it) tells repeated rows apart.  The address is
    written as it is, but for line ends, which a header can't hold: they are
    percent-encoded and read back so.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    revisit = refers_to is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id, url, place)}>",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
             f"Content-Length: {len(http) + (0 if revisit else size)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http.encode()


def write_archives(records: DataFrame, root: str | None = None) -> DataFrame:
    """Write what :func:`classify` returns; the manifest of the files, itself a written table."""
    spark = records.sparkSession
    ship_package(spark)
    root = root or scratch(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(root)
        fs.create_dir(base, recursive=True)
        out, name, n, size = None, None, 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "records": [n], "bytes": [size]})

        for batch in batches:
            for page_id, url, payload, sha1, refers_to in zip(*(batch.column(c) for c in (
                    "page_id", "url", "payload", "sha1", "refers_to"))):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                body = memoryview(payload.as_buffer())
                refers_to = refers_to.as_py()
                pack = zlib.compressobj(1, wbits=31)
                size += out.write(pack.compress(header(page_id.as_py(), url.as_py(), sha1.as_py(), len(body), refers_to, f"{name} {n}")))
                for at in range(0, 0 if refers_to is not None else len(body), CHUNK):
                    size += out.write(pack.compress(body[at:at + CHUNK]))
                size += out.write(pack.compress(b"\r\n\r\n") + pack.flush())
                n += 1
                if size >= FILE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return materialize(records.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(run, MANIFEST), "warc-manifest")


def _head(feed, have: bytearray) -> bytes:
    """Take bytes up to the first empty line."""
    while (at := have.find(b"\r\n\r\n")) < 0:
        more = feed()
        if not more:
            raise ValueError("record ends inside its header")
        have += more
    head = bytes(have[:at])
    del have[:at + 4]
    return head


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def read_records(stream, data: bool = True) -> Iterator[tuple]:
    """Chunk rows of one archive, read ``CHUNK`` bytes at a time."""
    raw = b""
    while True:
        raw = raw or stream.read(CHUNK)
        if not raw:
            return
        member = zlib.decompressobj(wbits=31)

        def feed() -> bytes:
            nonlocal raw
            while not member.eof:
                raw = member.unconsumed_tail or raw or stream.read(CHUNK)
                if not raw:
                    raise ValueError("archive ends inside a record")
                got = member.decompress(raw, CHUNK)
                raw = member.unused_data if member.eof else b""
                if got:
                    return got
            return b""

        have = bytearray()
        warc = _fields(_head(feed, have))
        http = _fields(_head(feed, have))
        size = int(http["Content-Length"])
        stored = base64.b32decode(warc["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        revisit = warc["WARC-Type"] == "revisit"
        left, seen, number, sha1 = 0 if revisit else size, 0, 0, hashlib.sha1()
        ids = [int(warc[k]) if k in warc else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")]
        url = warc.get("WARC-Target-URI")
        while True:
            if left and not have:
                have += feed()
            part = bytes(have[:min(left, CHUNK)])
            del have[:len(part)]
            left -= len(part)
            seen += len(part)
            sha1.update(part)
            digest = stored if revisit else sha1.hexdigest()
            if not left and digest != stored:
                raise ValueError(f"record {warc['WARC-Record-ID']}: payload differs from its digest")
            yield (warc["WARC-Record-ID"], number, ids[0], url, warc["WARC-Type"], ids[1], part if data else b"", seen, digest,
                   not left, size)
            number += 1
            if not left:
                break
        while feed():  # the blank lines that end the record
            pass


def read_archives(manifest: DataFrame, data: bool = True) -> DataFrame:
    """The chunk table of all archives of a manifest; ``data=False`` leaves the payload bytes out."""
    ship_package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = pyarrow.fs.FileSystem.from_uri(path)
                held, size = [], 0
                with fs.open_input_stream(name, compression=None) as stream:
                    for row in read_records(stream, data):
                        held.append(row)
                        size += len(row[6])
                        if size >= 32 * CHUNK or len(held) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), CHUNKS)], schema=CHUNKS)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), CHUNKS)], schema=CHUNKS)

    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(run, CHUNKS_DDL)
