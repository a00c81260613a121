"""WARC archives through a chunked record table.

Payloads travel as rows (record, chunk number, bytes), each with the bytes so far and the SHA-1 so far, so that neither
the writer nor the reader holds a whole record. Records of equal payloads are decided beforehand on light rows
(page_id, digest, size): the largest page_id is the response, the others are revisits of it. Each task
streams its chunks into gzip members of its own archive files in the shared folder and returns the files' names, so only
files of tasks that succeeded are read. The reader inflates a file piece by piece and gives chunk rows again.

Defined results: null html is an empty payload, a null url is left out of the header. A record with a null page_id is
a response, never referred to. Rows that repeat a page_id are a record each; those of equal payload and page_id
are all the response. Empty tables give no archive records. Other columns don't matter.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, stash, table

CHUNK = 1 << 16
_CHUNKS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string()),
    ("chunk_no", pa.int64()), ("so_far", pa.int64()), ("sha1_so_far", pa.string()), ("last", pa.bool_()), ("data", pa.binary()),
])
_CHUNKS_DDL = (
    "page_id long, url string, record_type string, refers_to long, bytes long, digest string, "
    "chunk_no long, so_far long, sha1_so_far string, last boolean, data binary"
)


def decide(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Pages with payload, bytes, digest, record_type and refers_to. Texts move at most once, keyed by page_id."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("digest"))
    big = rows.where(f"bytes >= {least}").groupBy("digest", "bytes").agg(F.max("page_id").alias("top"), F.min("page_id").alias("low"))
    big = big.where("low < top").select("digest", "bytes", "top")
    # Light rows decide; most pages have no equal, and only the revisits' ids meet the payloads.
    light = rows.select("page_id", "digest", "bytes").join(big, ["digest", "bytes"]).where("page_id <> top")
    light = light.select("page_id", "digest", "top").distinct()
    out = rows.join(light, ["page_id", "digest"], "left")
    kind = F.when(F.col("top").isNull(), "response").otherwise("revisit")
    return out.select("page_id", "url", "payload", "bytes", "digest", kind.alias("record_type"), F.col("top").alias("refers_to"))


def _chunk(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("page_id", "url", "record_type", "refers_to", "bytes", "digest")
        for b in batches:
            rows, held = [], 0
            for i in range(b.num_rows):
                head = {c: b[c][i].as_py() for c in names}
                view = memoryview(b["payload"][i].as_buffer()) if head["record_type"] == "response" else memoryview(b"")
                sha, n, k = hashlib.sha1(), len(view), 0
                while True:
                    part = view[k * size : (k + 1) * size]
                    sha.update(part)
                    last = (k + 1) * size >= n
                    rows.append(head | {"chunk_no": k, "so_far": min(n, (k + 1) * size), "sha1_so_far": sha.copy().hexdigest(), "last": last, "data": bytes(part)})
                    held, k = held + len(part), k + 1
                    if held > 64 * size:
                        yield pa.RecordBatch.from_pylist(rows, schema=_CHUNKS)
                        rows, held = [], 0
                    if last:
                        break
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_CHUNKS)

    return run


def chunk_table(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunks of decided records, those of a record in order and next to each other."""
    return records.mapInArrow(_chunk(size), _CHUNKS_DDL)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _head(r: dict, date: str) -> tuple[bytes, bytes]:
    """The headers of a record, and the HTTP head that opens its block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['bytes']}\r\n\r\n".encode()
    length = len(http) + (r["bytes"] if r["record_type"] == "response" else 0)
    lines = [
        "WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: {_name(r['page_id'])}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{r['digest']}", "Content-Type: application/http; msgtype=response", f"Content-Length: {length}",
    ]
    if r["url"] is not None:
        lines.append("WARC-Target-URI: " + r["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if r["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(r['refers_to'])}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass"), http


def write_archives(chunks: DataFrame, folder: str, file_bytes: int = 256 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write chunk rows into archive files of about ``file_bytes``; the table (path, records) of finished files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, path, records, done = None, "", 0, []
        member = None
        for b in batches:
            for r in b.to_pylist():
                if r["chunk_no"] == 0:
                    if out is not None and out.tell() > file_bytes:
                        out.close()
                        done.append((path, records))
                        out = None
                    if out is None:
                        path, records = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(path, compression=None)
                    records += 1
                    member = zlib.compressobj(4, zlib.DEFLATED, 31)
                    for part in _head(r, date):
                        out.write(member.compress(part))
                out.write(member.compress(r["data"]))
                if r["last"]:
                    out.write(member.compress(b"\r\n\r\n"))
                    out.write(member.flush())
        if out is not None:
            out.close()
            done.append((path, records))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    return stash(chunks.mapInArrow(run, "path string, records long"), "archives")


class _Inflated:
    """Bytes of a file of gzip members, a bounded piece at a time."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.buffer, self.z, self.raw = stream, size, b"", zlib.decompressobj(31), b""

    def more(self) -> bool:
        while True:
            if self.z.eof:
                self.raw, self.z = self.z.unused_data or self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.stream.read(self.size)
                if not self.raw:
                    return False
            out = self.z.decompress(self.raw, self.size)
            self.raw = b"" if self.z.eof else self.z.unconsumed_tail
            if self.z.eof and not self.z.unused_data:
                self.z = zlib.decompressobj(31)
            if out:
                self.buffer += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.buffer.find(mark)) < 0:
            if not self.more():
                return None
        head, self.buffer = self.buffer[:at], self.buffer[at + len(mark) :]
        return head

    def take(self, n: int) -> bytes:
        while not self.buffer:
            if not self.more():
                raise EOFError("an archive ends inside a record")
        part, self.buffer = self.buffer[:n], self.buffer[n:]
        return part


def _records(source: _Inflated, size: int) -> Iterator[dict]:
    while (head := source.until(b"\r\n\r\n")) is not None:
        field = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
        http = source.until(b"\r\n\r\n")
        left, sha, k, so_far = int(field["Content-Length"]) - len(http) - 4, hashlib.sha1(), 0, 0
        number = lambda x: None if x is None or x == "<urn:page:none>" else int(x[10:-1])
        row = {
            "page_id": number(field["WARC-Record-ID"]), "url": field.get("WARC-Target-URI"), "record_type": field["WARC-Type"],
            "refers_to": number(field.get("WARC-Refers-To")), "bytes": left, "digest": field["WARC-Payload-Digest"].removeprefix("sha1:"),
        }
        while True:
            part, want = b"", min(size, left)
            while len(part) < want:
                part += source.take(want - len(part))
            sha.update(part)
            left, so_far = left - len(part), so_far + len(part)
            yield row | {"chunk_no": k, "so_far": so_far, "sha1_so_far": sha.copy().hexdigest(), "last": not left, "data": part}
            k += 1
            if not left:
                break
        source.until(b"\r\n\r\n")


def read_archives(files: DataFrame, folder: str, size: int = CHUNK, data: bool = True) -> DataFrame:
    """Chunk rows of the files in a (path) table, one task for each file; without ``data`` only what describes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b["path"].to_pylist():
                with fs.open_input_stream(path, compression=None) as stream:
                    rows, held = [], 0
                    for r in _records(_Inflated(stream, size), size):
                        held += len(r["data"]) + 200
                        rows.append(r if data else r | {"data": None})
                        if held > 64 * size:
                            yield pa.RecordBatch.from_pylist(rows, schema=_CHUNKS)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_CHUNKS)

    n = max(1, files.count())
    return files.select("path").repartition(n, "path").mapInArrow(run, _CHUNKS_DDL)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    files = write_archives(chunk_table(decide(table(spark, sf_dir, "pages").select("page_id", "url", "html"))), folder)
    ends = stash(read_archives(files, folder, data=False).where("last"), "records")
    full = ends.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("so_far").alias("full_bytes"), F.col("sha1_so_far").alias("full_sha1"))
    referred = ends.where("record_type = 'revisit'").select("refers_to").distinct()
    full = full.join(referred, "refers_to", "left_semi").distinct()
    out = ends.join(full, "refers_to", "left")
    revisit = F.col("record_type") == "revisit"
    return out.select(
        "page_id", F.when(revisit, F.col("full_bytes")).otherwise(F.col("so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("full_sha1")).otherwise(F.col("sha1_so_far")).alias("payload_digest"), "record_type", "refers_to",
    )


SQL = {
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY h HAVING count(*) > 1)
SELECT p.page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN top IS NULL OR top = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top <> p.page_id THEN top END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h
"""
}
QUERIES = {"op3_warc": op3_warc}
