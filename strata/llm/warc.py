"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding a group of
whole WARC records, closed by the seek table of the Zstandard seekable format
(a skippable frame with the sizes of all frames).  An index table maps every
record to its bundle, frame and offset inside the decompressed frame, so one
record is read by decompressing one frame.  Records whose payload repeats an
earlier one are ``revisit`` records without a payload.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, col, map_arrow, map_rows, materialise, record_batches
from strata.session import scratch_path

FRAME_BYTES = 256 * 1024
#: A longer record is spread over frames of this size.
MAX_FRAME_BYTES = 64 * 1024 * 1024
BUNDLE_BYTES = 32 * 1024 * 1024
MIN_REVISIT_BYTES = 100
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"
_INDEX = "record_id string, page_id {id}, bundle string, frame int, offset long, length long"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# ---------------------------------------------------------------- records
def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _header_value(value: str) -> str:
    """Control characters would end a header line; they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record; a revisit carries the HTTP header of the full payload only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """``(headers, block, end)`` of the record at ``at``."""
    split = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:split].decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    headers = dict(line.split(": ", 1) for line in lines)
    start, size = split + 4, int(headers["Content-Length"])
    if data[start + size:start + size + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} does not end after {size} bytes")
    return headers, data[start:start + size], start + size + 4


# ---------------------------------------------------------------- seekable bundles
class BundleWriter:
    """Writes records into frames and closes the file with the seek table."""

    def __init__(self, stream, level: int = 3):
        import zstandard

        self.stream, self.zstd = stream, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.buffer, self.sizes, self.written = bytearray(), [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        """``(frame, offset in the frame)`` at which the record begins."""
        if self.buffer and len(self.buffer) + len(data) > FRAME_BYTES:
            self._flush()
        place = len(self.sizes), len(self.buffer)
        view = memoryview(data)
        for lo in range(0, len(view), MAX_FRAME_BYTES):
            if lo:
                self._flush()
            self.buffer += view[lo:lo + MAX_FRAME_BYTES]
        return place

    def _flush(self) -> None:
        frame = self.zstd.compress(bytes(self.buffer))
        self.stream.write(frame)
        self.sizes.append((len(frame), len(self.buffer)))
        self.written += len(frame)
        self.buffer.clear()

    def close(self) -> None:
        if self.buffer:
            self._flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()


class BundleReader:
    """Random access to the frames of a bundle through its seek table."""

    def __init__(self, file):
        import zstandard

        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        end = file.size()
        count, flags, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8  # a writer may add a checksum to each entry
        size = count * width + 9
        head = struct.unpack("<II", file.read_at(8, end - size - 8))
        if head != (SKIPPABLE_MAGIC, size):
            raise ValueError("broken seek table")
        entries = file.read_at(count * width, end - size)
        self.frames, at = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", entries, k * width)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        return self.zstd.decompress(self.file.read_at(packed, at), max_output_size=plain)

    def read(self, frame: int, offset: int, length: int) -> bytes:
        """``length`` bytes from a place the index names."""
        out = bytearray(self.frame(frame)[offset:offset + length])
        while len(out) < length:
            frame += 1
            out += self.frame(frame)[:length - len(out)]
        return bytes(out)

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        rest = b""
        for k in range(len(self.frames)):
            data, at = rest + self.frame(k), 0
            rest = b""
            while at < len(data):
                try:
                    headers, block, at = parse(data, at)
                except (ValueError, KeyError):
                    if k + 1 == len(self.frames):
                        raise
                    rest = data[at:]  # a record longer than a frame goes on in the next
                    break
                yield headers, block


def read_record(uri: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry."""
    fs, path = _filesystem(uri)
    with fs.open_input_file(path) as f:
        headers, block, _ = parse(BundleReader(f).read(frame, offset, length))
    return headers, block


# ---------------------------------------------------------------- pages
def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, html, digest, size, refers_to)``; ``refers_to`` is set for revisits.

    Of the rows with one payload of at least ``MIN_REVISIT_BYTES`` bytes the
    smallest page_id is stored, the others refer to it.  Rows that share that
    smallest id are all stored; rows with a null id refer to it, or are all
    stored if every id is null.  A null html is an empty payload.
    """
    payload = F.coalesce(col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.sha2("payload", 256).alias("digest"),
                       F.octet_length("payload").cast("long").alias("size"))
    first = materialise(
        rows.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-first")
    later = ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest", "size", F.when(later, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write bundles below ``folder`` (a URI all executors reach) and return the record index.

    ``(record_id, page_id, bundle, frame, offset, length)``, written as a table.
    Every task attempt writes files of its own; only those of the attempts that
    Spark commits are in the index, so retries add no records.
    """
    rows = with_revisits(pages, id_col, url_col, html_col)
    schema = _INDEX.format(id=rows.schema["page_id"].dataType.simpleString())
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        writer, name, entries = None, "", []
        for batch in batches:
            for page_id, url, payload, digest, size, refers_to in zip(*(batch.column(i) for i in range(6))):
                if writer is None:
                    name = f"{base}/{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(fs.open_output_stream(name, compression=None))
                page, digest, refers = page_id.as_py(), digest.as_py(), refers_to.as_py()
                data = record(page, url.as_py(), payload.as_py(), digest, size.as_py(), refers, refers is not None)
                entries.append((record_id(page, digest), page, name, *writer.add(data), len(data)))
                if writer.written >= BUNDLE_BYTES:
                    writer.close()
                    yield record_batches(entries, out)
                    writer, entries = None, []
        if writer is not None:
            writer.close()
            yield record_batches(entries, out)

    return materialise(map_arrow(rows, run, schema), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, url)`` of every record in the index's bundles.

    Size and digest of a response are taken from the payload as read; a revisit
    names those of the payload it stands for.
    """
    import hashlib

    id_type = index.schema["page_id"].dataType.simpleString()

    def make():
        fs, _ = _filesystem(folder)
        as_id = (lambda v: v) if id_type == "string" else int

        def one(path, _):
            with fs.open_input_file(path) as f:
                for headers, block in BundleReader(f).records():
                    http, _, payload = block.partition(b"\r\n\r\n")
                    page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
                    kind = headers["WARC-Type"]
                    if kind == "response":
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    else:
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    yield (page if page is None else as_id(page), size, digest, kind,
                           refers if refers is None else as_id(refers), headers.get("WARC-Target-URI"))

        return one

    bundles = index.groupBy("bundle").agg(F.count("*").alias("n"))
    # a bundle is a unit of work however short its row is: as many tasks as bundles, not as few as their rows' bytes need
    bundles = bundles.repartition(max(1, min(bundles.count(), 100_000)))
    return map_rows(bundles, make, f"page_id {id_type}, payload_bytes long, payload_digest string, record_type string, "
                                   f"refers_to {id_type}, url string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to bundles in the shared folder and read the records back."""
    folder = scratch_path(pages.sparkSession, "llm-warc")
    return read_archives(write_archives(pages, folder), folder)
