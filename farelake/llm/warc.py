"""WARC archives: write pages as records, read archives back one gzip member at a time.

Writing: a page's payload is its html in UTF-8. Of pages with equal payloads the one with the
largest page_id is stored whole, the others as revisits that refer to it. Each task writes its own archives, new
ones for every attempt, and reports them as rows; only archives in that written report are read, so a lost or repeated
task leaves files behind that nobody reads.

Reading: a sequential reader inflates one member after the other in small steps, frames the block by the
record's Content-Length and checks block and payload digests. Damage raises ``ValueError`` with the place.

Null html is an empty payload, a null url an empty one. A page without an id refers to the stored page of its payload, if
one with an id has it; else it is a response. Of repeated rows (same id and payload) each gets a record, all
responses or all revisits. No pages, no archives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import stage
from farelake.session import work_path

ARCHIVE_BYTES = 256 << 20
STEP = 1 << 16
#: Tasks that read archives, at most; beyond, each reads several.
MOST_READERS = 1 << 15
WRITTEN = "archive string, records bigint, bytes bigint"
RECORDS = (
    "archive string, `offset` bigint, record_id string, record_type string, url string, page_id bigint, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
)
#: Fixed values of the format, as the standard gives them.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2020-01-01T00:00:00Z"


def open_stream(path: str, mode: str):
    """``path`` for reading or writing: a mounted folder (plain or ``file:``), or any store that Arrow knows."""
    plain = path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
    if "://" not in plain:
        return open(plain, mode)
    from pyarrow import fs

    store, key = fs.FileSystem.from_uri(path)
    return store.open_input_stream(key, compression=None) if mode == "rb" else store.open_output_stream(key, compression=None)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_value(text: str | None) -> str:
    """A header must stay on its line."""
    return " ".join((text or "").split())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {RECORD_DATE}",
        f"WARC-Target-URI: {header_value(url)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages below ``folder`` and return the report of the archives, as a written table."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha", F.unhex(F.sha1("html")))
    # One row per payload that more than one page has; the rest are responses.
    shared = rows.groupBy("sha").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    told = rows.join(stage(shared, "warc-shared"), "sha", "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )

    def run(batches):
        out, name, count, size = None, "", 0, 0
        reports = []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, count, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = open_stream(name, "wb")
                payload = html.encode()
                member = record(page_id, url, payload, sha1(payload), refers_to)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    reports.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            reports.append((name, count, size))
        columns = [pa.array([r[i] for r in reports], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["archive", "records", "bytes"])

    return stage(told.mapInArrow(run, WRITTEN), "warc-report")


class Members:
    """Bytes of a gzip file, inflated step by step; stops at the end of each member."""

    def __init__(self, stream):
        self.stream, self.left, self.offset = stream, b"", 0

    def next_member(self) -> "Member | None":
        if not self.left:
            self.left = self.stream.read(STEP)
        return Member(self) if self.left else None


class Member:
    def __init__(self, source: Members):
        self.source, self.at, self.inflate, self.ready = source, source.offset, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        """Inflate another step; False at the member's end."""
        if self.inflate.eof:
            return False
        source = self.source
        if not source.left and not self.inflate.unconsumed_tail:
            source.left = source.stream.read(STEP)
        data = self.inflate.unconsumed_tail + source.left
        try:
            new = self.inflate.decompress(data, STEP)
        except zlib.error as error:
            raise ValueError(f"damaged member at {self.at}: {error}") from error
        if not data and not new and not self.inflate.eof:
            raise ValueError(f"archive ends inside the member at {self.at}")
        self.ready += new
        source.left = self.inflate.unused_data
        source.offset += len(data) - len(source.left) - len(self.inflate.unconsumed_tail)
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (end := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if not self._more():
                raise ValueError(f"no end of the header in the member at {self.at}")
        out = bytes(self.ready[:end])
        del self.ready[:end + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError(f"the record at {self.at} is shorter than its Content-Length")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def finish(self) -> bytes:
        while self._more():
            pass
        return bytes(self.ready)


def headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode().split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def read_records(stream) -> Iterator[dict]:
    """Records of one archive in order, checked."""
    members = Members(stream)
    while (member := members.next_member()) is not None:
        version, head = headers(member.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at {member.at}")
        block = member.exactly(int(head["content-length"]))
        if member.finish() != b"\r\n\r\n":
            raise ValueError(f"the record at {member.at} does not end where its Content-Length says")
        if head.get("warc-block-digest", f"sha1:{sha1(block)}") != f"sha1:{sha1(block)}":
            raise ValueError(f"wrong block digest at {member.at}")
        http, _, payload = block.partition(b"\r\n\r\n")
        kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
        full = int(headers(http)[1]["content-length"])
        if kind == "response" and (len(payload) != full or sha1(payload) != digest):
            raise ValueError(f"wrong payload at {member.at}")
        page, refers = head.get("x-page-id"), head.get("x-refers-to-page-id")
        yield {
            "offset": member.at, "record_id": head["warc-record-id"], "record_type": kind, "url": head["warc-target-uri"],
            "page_id": None if page is None else int(page), "payload_bytes": full, "payload_digest": digest,
            "refers_to": None if refers is None else int(refers), "payload": payload if kind == "response" else None,
        }


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives listed in the column ``archive``."""
    names = [f.split()[0].strip("`") for f in RECORDS.split(", ")][:None if with_payload else -1]
    schema = RECORDS if with_payload else RECORDS.removesuffix(", payload binary")
    types = dict(offset=pa.int64(), page_id=pa.int64(), payload_bytes=pa.int64(), refers_to=pa.int64(), payload=pa.binary())

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open_stream(name, "rb") as stream:
                    rows, size = [], 0
                    for row in read_records(stream):
                        rows.append({"archive": name, **row})
                        size += row["payload_bytes"] if with_payload else 0
                        if len(rows) == 4096 or size > 8 << 20:
                            yield as_batch(rows)
                            rows, size = [], 0
                    yield as_batch(rows)

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names=names)

    # One task per archive: names are too small for Spark to spread them by size.
    tasks = max(1, min(archives.count(), MOST_READERS))
    return archives.select("archive").repartitionByRange(tasks, "archive").mapInArrow(run, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives below the shared one."""
    folder = work_path(spark, "warc")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return folder
