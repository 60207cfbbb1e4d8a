"""WARC archives: one gzip member per record, written and read as streams.

``write`` turns page rows into archive segments, tables of ``(archive, segment, content)`` in the shared folder:
Spark's writers commit them as one, and any store that Spark reaches holds them. A segment is a whole archive file
of bounded size, so ``read`` gives each to one task and reads it from front to back, inflating as it goes and never
holding more than a record and a block. ``read_files`` reads ``.warc.gz`` files the same way.

Payloads that repeat are written once: of the pages with one payload the smallest page_id becomes the response
record, the others revisit records, which keep the HTTP header (with the length of the payload) and name the page
they refer to.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_dir

#: A segment is closed when it has this many compressed bytes.
SEGMENT_BYTES = 4 << 20
BLOCK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_PAGE = "urn:page:none"

SEGMENTS = "archive string, segment long, content binary"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "content_length long, digest_ok boolean, payload binary"
)


def payload_digest(payload: bytes) -> str:
    """SHA-1 in base32, without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return NO_PAGE if page_id is None else f"urn:page:{page_id}"


def urn_page(urn: str) -> int | None:
    return None if urn == NO_PAGE else int(urn.rpartition(":")[2])


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None = None) -> bytes:
    """One record as a gzip member: a response, or a revisit of page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    uri = (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <{page_urn(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
    ]
    if first is not None:
        head += [f"WARC-Refers-To: <{page_urn(first)}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return deflate.compress(whole) + deflate.flush()


def members(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """The inflated gzip members of a stream of blocks, one at a time; ValueError if the last one is cut short."""
    inflate, parts, rest = None, [], b""
    for block in blocks:
        rest = rest + block if rest else block
        while rest:
            inflate = inflate or zlib.decompressobj(31)
            parts.append(inflate.decompress(rest))
            rest = inflate.unused_data
            if not inflate.eof:
                rest = b""
                break
            yield b"".join(parts)
            inflate, parts = None, []
    if inflate is not None:
        raise ValueError("archive ends inside a record")


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def parse(member: bytes) -> dict:
    """A record's row. The block is framed by Content-Length, both digests are verified; a frame that does not
    match the member raises ValueError, a digest that does not match is told by ``digest_ok``."""
    head, found, rest = member.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = _headers(head)
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("the record's length is not its Content-Length")
    block = rest[:length]
    http, _, body = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    ok = fields.get("warc-block-digest", "").removeprefix("sha1:") == payload_digest(block)
    refers = None
    if kind == "revisit":
        refers = urn_page(fields["warc-refers-to"].strip("<>"))
        size = int(_headers(http)["content-length"])
    else:
        size = len(body)
        ok = ok and digest == payload_digest(body)
    uri = fields.get("warc-target-uri")
    return {
        "page_id": urn_page(fields["warc-record-id"].strip("<>")), "url": None if uri == "urn:none" else uri,
        "record_type": kind, "refers_to": refers, "payload_bytes": size, "payload_digest": digest,
        "content_length": length, "digest_ok": ok, "payload": None if kind == "revisit" else body,
    }


def with_digests(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_digest, n_bytes``: a page with its payload (null html: empty)."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", "url", html.alias("payload"), F.sha1(html).alias("_sha1"), F.length(html).cast("long").alias("n_bytes"))


def write(pages: DataFrame, path: str, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write every page (``page_id, url, html``; other columns are not used) as a record below ``path``.

    Of the pages with equal payloads of at least ``min_bytes`` bytes the smallest page_id is the response, the others
    revisit it; shorter payloads are all responses. Rows that share that smallest page_id, too, are all
    responses. Rows without a page_id are responses, and nothing refers to them. A null html is the empty payload;
    null urls stay null. The pages are joined to one narrow row per repeated payload, whose split Spark adapts when
    one payload is frequent; no pages: no segments.
    """
    whole = with_digests(pages)
    narrow = whole.select("page_id", "_sha1", "n_bytes").filter((F.col("n_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    firsts = narrow.groupBy("_sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    joined = whole.join(firsts, "_sha1", "left").select(
        "page_id", "url", "payload",
        F.when((F.col("n_bytes") >= min_bytes) & (F.col("page_id") != F.col("first")), F.col("first")).alias("first"),
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        name, number, parts, size = f"pages-{task.partitionId() if task else 0:05d}", 0, [], 0

        def close():
            return pa.RecordBatch.from_pydict(
                {"archive": [name], "segment": [number], "content": [b"".join(parts)]},
                schema=pa.schema([("archive", pa.string()), ("segment", pa.int64()), ("content", pa.binary())]),
            )

        for batch in batches:
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns)):
                parts.append(record(page_id, url, payload, first))
                size += len(parts[-1])
                if size >= segment_bytes:
                    yield close()
                    number, parts, size = number + 1, [], 0
        if parts:
            yield close()

    joined.mapInArrow(pack, SEGMENTS).write.parquet(path)


def _rows(names_and_blocks: Iterable[Iterable[bytes]], batch_rows: int = 200) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("content_length", pa.int64()),
        ("digest_ok", pa.bool_()), ("payload", pa.binary()),
    ])
    rows = []
    for blocks in names_and_blocks:
        for member in members(blocks):
            rows.append(parse(member))
            if len(rows) >= batch_rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _blocks(content: bytes) -> Iterator[bytes]:
    for i in range(0, len(content), BLOCK):
        yield content[i : i + BLOCK]


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _rows(_blocks(x.as_buffer()) for batch in batches for x in batch.column(0))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path`` (see ``RECORDS``), one row each, in no order; an empty archive gives no rows."""
    return spark.read.schema(SEGMENTS).parquet(path).select("content").mapInArrow(_read, RECORDS)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The records of ``.warc.gz`` files (one gzip member per record, under 2 GB each) that a path or glob names."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to the shared folder and read the records back."""
    path = scratch_dir(pages.sparkSession, f"warc-{uuid.uuid4().hex[:8]}")
    write(pages, path, min_bytes)
    return read(pages.sparkSession, path)
