"""WARC archives: a writer of one gzip member per record, and a reader that
salvages what damage leaves.

The reader checks every record: gzip checksum, header, content length, closing
line ends, block digest and payload digest.  After a failed check it searches on
for the next place where a valid record starts (a gzip member, or in plain files
a version line), reads on from there, and reports the bytes in between as a gap
with its reason.  Damage therefore costs the records it touches and no others.
Only the record at hand and a window of the file are held in memory.

Pages with equal payloads become one response (the largest page id) and revisit
records without a payload, which name the response and keep the payload's length
and digest in their header.  Payloads under ``min_bytes`` are always responses.
Repeated rows of one page id are all responses if their payload's response has
that id.  A null id never names a response: rows without an id are revisits of
one with an id, or else responses.  A null html is the empty payload, a null url
leaves its header out.  Extra columns are not stored; an empty table writes no
file.  Files get their final name when complete, so a task may run again.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, ships_by_value, to_table, whole
from .records import _open

VERSION = b"WARC/1.1"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
WINDOW = 1 << 20
MAX_HEADER = 1 << 16
LEVEL = 4


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(rid: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", rid or "")
    return int(m[1]) if m else None


def build_record(page_id: int | None, url: str | None, payload: bytes,
                 refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One uncompressed record."""
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", "2024-01-01T00:00:00Z")]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
             ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
             ("WARC-Payload-Length", len(payload)),  # extension field
             ("Content-Type", "application/http;msgtype=response"),
             ("Content-Length", len(block))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]


@dataclass
class Gap:
    """Bytes from ``offset`` on that hold no valid record."""
    offset: int
    length: int
    reason: str


class Damaged(Exception):
    pass


def _parse(head: bytes) -> tuple[dict[str, str], int]:
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise Damaged("no version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("malformed header line")
        headers[name.strip().lower()] = value.strip()
    size = headers.get("content-length", "")
    if not size.isdigit():
        raise Damaged("no content length")
    return headers, int(size)


def _verify(headers: dict[str, str], block: bytes) -> None:
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != sha1_base32(block):
        raise Damaged("block digest differs")
    digest = headers.get("warc-payload-digest", "")
    if (headers.get("warc-type") == "response" and digest.startswith("sha1:")
            and digest[5:] != sha1_base32(block.partition(b"\r\n\r\n")[2])):
        raise Damaged("payload digest differs")


def _member(f, size: int, at: int) -> Record:
    """The record in the gzip member at ``at``."""
    z, parts, place = zlib.decompressobj(31), [], at
    try:
        while not z.eof:
            chunk = f.read_at(min(WINDOW, size - place), place) if place < size else b""
            if not chunk:
                raise Damaged("member ends early")
            data = z.decompress(chunk)
            if not parts and data and not data.startswith(VERSION[:5]):
                raise Damaged("member holds no record")
            parts.append(data)
            place += len(chunk)
    except zlib.error as e:
        raise Damaged(f"gzip: {e}") from None
    data = b"".join(parts)
    head, end, rest = data.partition(b"\r\n\r\n")
    if not end:
        raise Damaged("no end of header")
    headers, n = _parse(head)
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise Damaged("content length differs")
    _verify(headers, rest[:n])
    return Record(at, place - len(z.unused_data) - at, headers, rest[:n])


def _plain(f, size: int, at: int) -> Record:
    """The uncompressed record at ``at``."""
    head, end, _ = f.read_at(min(MAX_HEADER, size - at), at).partition(b"\r\n\r\n")
    if not end:
        raise Damaged("no end of header")
    headers, n = _parse(head)
    start = at + len(head) + 4
    if start + n + 4 > size:
        raise Damaged("record ends early")
    block = f.read_at(n + 4, start)
    if block[n:] != b"\r\n\r\n":
        raise Damaged("content length differs")
    _verify(headers, block[:n])
    return Record(at, len(head) + n + 8, headers, block[:n])


def _record(f, size: int, at: int) -> Record:
    start = f.read_at(min(5, size - at), at)
    if start.startswith(MAGIC):
        return _member(f, size, at)
    if start == VERSION[:5]:
        return _plain(f, size, at)
    raise Damaged("neither a member nor a version line")


def _candidates(f, size: int, at: int) -> Iterator[int]:
    """Places from ``at`` on where a member or a version line might start."""
    while at < size:
        data = f.read_at(min(WINDOW, size - at), at)
        for m in re.finditer(rb"\x1f\x8b\x08|WARC/1\.", data):
            yield at + m.start()
        if len(data) < WINDOW:
            return
        at += len(data) - 6  # one may straddle the window's end


def salvage(f, size: int) -> Iterator[Record | Gap]:
    """Records and gaps of an open file, in order.  ``f`` has ``read_at(n, offset)``."""
    at = 0
    while at < size:
        try:
            found = _record(f, size, at)
        except Damaged as e:
            reason, found = str(e), None
            for place in _candidates(f, size, at + 1):
                try:
                    found = _record(f, size, place)
                    break
                except Damaged:
                    continue
            yield Gap(at, (found.offset if found else size) - at, reason)
            if not found:
                return
        yield found
        at = found.offset + found.length


def with_targets(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html`` and ``target``: the page id of the response, null for
    responses themselves.  Equal payloads are counted on (digest, id) alone; only
    groups of two or more reach the join, which Spark broadcasts when the written
    table is small enough."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        whole(F.col("html")).alias("html"))
    payload = F.col("html").cast("binary")
    digest = F.when(F.octet_length(payload) >= min_bytes, F.sha1(payload))
    groups = (rows.select(digest.alias("digest"), "page_id").where(F.col("digest").isNotNull())
              .groupBy("digest").agg(F.max("page_id").alias("target"), F.count("*").alias("n"))
              .where((F.col("n") > 1) & F.col("target").isNotNull()).select("digest", "target"))
    joined = rows.withColumn("digest", digest).join(to_table(groups, "warc-groups"), "digest", "left")
    other = ~F.col("target").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html",
                         F.when(other, F.col("target")).alias("target"))


def write_archives(pages: DataFrame, folder: str) -> list[str]:
    """Write ``page_id, url, html, target``; one file per partition, names returned."""
    def write(batches):
        own, part = uuid.uuid4().hex, TaskContext.get().partitionId()
        fs, root = _open(folder)
        final, out, n = f"part-{part:06d}.warc.gz", None, 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html", "target"))
            for page_id, url, html, target in zip(*columns):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{final}.{own}")
                out.write(gzip_member(build_record(
                    page_id, url, html.encode("utf-8", "surrogatepass"), target, target is not None)))
                n += 1
        if out is not None:
            out.close()
            fs.move(f"{root}/{final}.{own}", f"{root}/{final}")
            yield pa.RecordBatch.from_pydict({"file": pa.array([final]), "n": pa.array([n], pa.int64())})

    done = pages.mapInArrow(write, "file string, n bigint").collect()
    return sorted(r["file"] for r in done)


SCHEMA = ("file string, offset bigint, length bigint, gap string, page_id bigint, url string, "
          "record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
          "payload binary")


def read_archives(spark: SparkSession, folder: str, files: list[str], *,
                  payloads: bool = False) -> DataFrame:
    """A row per record, and a row per gap (``gap`` tells its reason)."""
    def read(frames):
        for pdf in frames:
            for name in pdf["file"]:
                fs, root = _open(folder)
                path = f"{root}/{name}"
                rows = []
                with fs.open_input_file(path) as f:
                    for x in salvage(f, f.size()):
                        rows.append(_row(name, x, payloads))
                        if len(rows) >= (64 if payloads else 2048):
                            yield frame(rows)
                            rows = []
                if rows:
                    yield frame(rows)

    def frame(rows):
        pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
        for c in ("page_id", "refers_to", "payload_bytes"):
            pdf[c] = pd.array(pdf[c].tolist(), dtype="Int64")
        return pdf

    plan = spark.createDataFrame([(x,) for x in files], "file string")
    return plan.repartition(max(1, len(files))).mapInPandas(read, SCHEMA)


def _row(name: str, x: Record | Gap, payloads: bool) -> tuple:
    if isinstance(x, Gap):
        return (name, x.offset, x.length, x.reason, None, None, None, None, None, None, None)
    h = x.headers
    revisit = h.get("warc-type") == "revisit"
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
    size = h.get("warc-payload-length", "")
    return (name, x.offset, x.length, None, page_of(h.get("warc-record-id")),
            h.get("warc-target-uri"), h.get("warc-type"),
            page_of(h.get("warc-refers-to")) if revisit else None,
            (int(size) if size.isdigit() else None) if revisit else len(x.payload),
            digest or None, x.payload if payloads and not revisit else None)


def round_trip(spark: SparkSession, pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` below the shared folder and read the archives back."""
    folder = shared_path(spark, "warc")
    files = write_archives(with_targets(pages, min_bytes=min_bytes), folder)
    return read_archives(spark, folder, files)


ships_by_value(__name__)
