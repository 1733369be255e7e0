"""WARC archives: one gzip member per record, written and read by Spark tasks.

Writing: every task fills files of its own and starts a new one when the last is large
enough. Reading: every file goes through a sequential reader that inflates it piece by
piece, takes each record's block by its content length and verifies the digests, so
memory is bounded by the largest record and not by the file.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.llm.common import stored
from lading.session import run_folder
from lading.sources.blobfiles import open_filesystem

# Payloads below this size are never replaced by a revisit.
REVISIT_BYTES = 100

# A file is closed once it has this many bytes.
FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


class WarcError(ValueError):
    """An archive does not follow the format, or a digest does not match."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    payload: bytes = field(default=b"")

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]


def record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}')}>" if page_id is not None else (
        f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'url {url}')}>"
    )


def sha256(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def _line(value: str) -> bytes:
    """A header value on one line."""
    return " ".join(value.split()).encode("utf-8", "replace")


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = b"\r\n".join([VERSION, *(k.encode() + b": " + _line(v) for k, v in headers)])
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def page_record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    refers_to: int | None,
    date: str,
) -> bytes:
    """The response of a page, or its revisit if another page holds the same payload."""
    digest = sha256(payload)
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
        + str(len(payload)).encode()
        + b"\r\n\r\n"
    )
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, url)),
        ("WARC-Date", date),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    if page_id is not None:
        headers.append(("Page-ID", str(page_id)))
    if refers_to is None:
        block += payload
    else:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to, None)),
            ("Refers-To-Page-ID", str(refers_to)),
        ]
    headers += [
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", sha256(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return member(headers, block)


def _digest_of(name: str, value: str, data: bytes) -> None:
    algorithm, _, expected = value.partition(":")
    found = hashlib.new(algorithm.lower().replace("-", ""), data)
    spellings = (found.hexdigest(), base64.b32encode(found.digest()).decode().rstrip("=").lower())
    if expected.strip().rstrip("=").lower() not in spellings:
        raise WarcError(f"{name} does not match: {value}")


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and body of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()
    return fields, body


def parse(data: bytes) -> Record:
    """A record from the content of one gzip member."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not mark or not version.startswith(b"WARC/"):
        raise WarcError("a member does not start with a WARC record")
    headers = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            headers[name.decode().strip().lower()] = value.decode("utf-8").strip()
    length = int(headers["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise WarcError("a record's block is not as long as its content length says")
    if "warc-block-digest" in headers:
        _digest_of("block digest", headers["warc-block-digest"], block)
    record = Record(headers, block)
    if record.kind == "response":
        _, record.payload = http_parts(block)
        if "warc-payload-digest" in headers:
            _digest_of("payload digest", headers["warc-payload-digest"], record.payload)
    return record


def read_records(stream) -> Iterator[Record]:
    """The records of a gzipped archive in turn, holding one of them at a time."""
    inflate, parts, pending = zlib.decompressobj(31), [], b""
    started = False
    while True:
        data = pending or stream.read(READ_BYTES)
        pending = b""
        if not data:
            if started:
                raise WarcError("the archive ends within a record")
            return
        started = True
        parts.append(inflate.decompress(data))
        if inflate.eof:
            yield parse(b"".join(parts))
            pending = inflate.unused_data
            inflate, parts, started = zlib.decompressobj(31), [], False


def with_roles(pages: DataFrame) -> DataFrame:
    """Add refers_to: for a repeated payload the smallest page_id that has it, else null.

    Payloads are compared by SHA-256 and length in a narrow table; groups are reduced to
    their smallest id before they meet the pages again.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    digest = F.sha2(body, 256)
    narrow = stored(pages.select("page_id", digest.alias("digest"), F.length(body).alias("n")), "payloads")
    first = (
        narrow.filter(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("rows"))
        .filter("rows > 1 and first_id is not null")
    )
    later = narrow.join(first, "digest").filter(
        F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id"))
    )
    roles = stored(
        later.select(
            F.col("page_id").alias("_page_id"), F.col("digest").alias("_digest"), F.col("first_id").alias("refers_to")
        ).distinct(),
        "roles",
    )
    return (
        pages.select("page_id", "url", "html", digest.alias("_payload"))
        .join(
            roles,
            F.col("page_id").eqNullSafe(F.col("_page_id")) & (F.col("_payload") == F.col("_digest")),
            "left",
        )
        .select("page_id", "url", "html", "refers_to")
    )


def write_archives(
    pages: DataFrame, root: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write one record per page below ``root``; return rows (path, records, bytes) of the files.

    Files are named after task and attempt and listed only once complete, so what a lost task
    leaves behind is never read. ``root`` must be reachable from all executors.
    """

    def run(batches):
        filesystem, base = open_filesystem(root)
        filesystem.create_dir(base, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        number, stream, made, size, listed = 0, None, 0, 0, []
        for batch in batches:
            ids, urls, htmls, refers = batch.columns
            for i in range(batch.num_rows):
                if stream is None:
                    path = posixpath.join(base, f"{name}-{number:04d}.warc.gz")
                    stream = filesystem.open_output_stream(path, compression=None)
                    number, made, size = number + 1, 0, 0
                payload = (htmls[i].as_py() or "").encode("utf-8", "surrogatepass")
                data = page_record(ids[i].as_py(), urls[i].as_py(), payload, refers[i].as_py(), date)
                stream.write(data)
                made, size = made + 1, size + len(data)
                if size >= file_bytes:
                    stream.close()
                    listed.append((posixpath.basename(path), made, size))
                    stream = None
        if stream is not None:
            stream.close()
            listed.append((posixpath.basename(path), made, size))
        if listed:
            names, counts, sizes = zip(*listed, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{root.rstrip('/')}/{n}" for n in names]),
                    pa.array(counts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["path", "records", "bytes"],
            )

    ready = pages.select(F.col("page_id").cast("long"), "url", "html", F.col("refers_to").cast("long"))
    return stored(ready.mapInArrow(run, "path string, records long, bytes long"), "archives")


def read_archives(files: DataFrame) -> DataFrame:
    """Rows (page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload).

    ``files`` has a column path. A file is read by one task; files have a bounded size. The
    payload of a revisit is null, its length and digest are those it states.
    """

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem, base = open_filesystem(path)
                rows, size = [], 0
                with filesystem.open_input_stream(base, compression=None) as stream:
                    for record in read_records(stream):
                        rows.append(_row(record))
                        size += len(record.block)
                        if size > READ_BYTES * 8:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    # One row per task: a file is the unit of work.
    spread = files.select("path").repartition(max(1, files.count()), F.xxhash64("path"))
    return spread.mapInArrow(
        run,
        "page_id long, url string, record_type string, refers_to long, payload_digest string, "
        "payload_bytes long, payload binary",
    )


def _row(record: Record) -> tuple:
    headers = record.headers
    fields, body = http_parts(record.block)
    revisit = record.kind == "revisit"
    number = headers.get("page-id")
    refers = headers.get("refers-to-page-id")
    return (
        int(number) if number is not None else None,
        headers.get("warc-target-uri"),
        record.kind,
        int(refers) if refers is not None else None,
        headers["warc-payload-digest"].partition(":")[2],
        int(fields["content-length"]) if revisit else len(body),
        None if revisit else body,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def archived(spark: SparkSession, pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives and read them back.

    A null html is an empty payload. Pages that repeat a page_id have a record each; if the id is
    the smallest of its payload they are all responses. A null page_id comes after all others
    and stays null. Payloads under ``REVISIT_BYTES`` bytes are all responses. Extra columns
    are not archived.
    """
    root = root or f"{run_folder(spark, 'warc')}/files"
    return read_archives(write_archives(with_roles(pages), root))
