import hashlib
import io
import struct

import pyarrow as pa
import pytest
import zstandard

from conftest import SF_SMALL
from strata.llm import queries, warc
from strata.session import scratch_path


class Sink(io.BytesIO):
    def close(self):
        self.done = self.getvalue()


def bundle(records, monkeypatch=None):
    sink = Sink()
    writer = warc.BundleWriter(sink)
    places = [writer.add(r) for r in records]
    writer.close()
    return sink.done, places


def test_bundle_is_standard_zstandard_with_a_seek_table(monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    monkeypatch.setattr(warc, "MAX_FRAME_BYTES", 1000)
    records = [warc.record(i, f"http://x/{i}", b"p" * n, hashlib.sha256(b"p" * n).hexdigest(), n)
               for i, n in enumerate([0, 5, 100, 5000, 3, 999, 1001])]
    data, places = bundle(records)
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(records)
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    assert magic == 0x8F92EAB1 and count > 3
    reader = warc.BundleReader(pa.BufferReader(data))
    assert [h["X-Page-ID"] for h, _ in reader.records()] == [str(i) for i in range(7)]
    for r, place in reversed(list(zip(records, places))):
        assert reader.read(*place, len(r)) == r


def test_headers_survive_line_breaks_in_addresses():
    headers, block, _ = warc.parse(warc.record(1, "http://x/a b\r\nWARC-Type: x", b"", "00", 0))
    assert headers["WARC-Target-URI"] == "http://x/a%20b%0D%0AWARC-Type:%20x" and headers["WARC-Type"] == "response"


def expected(pages):
    first = {}
    for i, html in pages:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    for i, html in pages:
        data = (html or "").encode()
        refers = first.get(data) if len(data) >= 100 and first.get(data) != i else None
        yield (i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers)


def rows_of(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()),
                  key=str)


def test_query_round_trips_every_page(spark):
    pages = [(r["page_id"], r["html"]) for r in queries.table(spark, SF_SMALL, "pages").collect()]
    assert rows_of(queries.op1_warc(spark, SF_SMALL)) == sorted(expected(pages), key=str)


CASES = [(1, "a" * 200), (2, "a" * 200), (2, "a" * 200), (None, "a" * 200), (3, "a" * 99), (4, "a" * 99), (5, None), (6, ""),
         (7, "é" * 60), (8, "é" * 60), (9, "\r\n\r\nWARC/1.1\r\n" * 20), (10, "z" * 700_000), (None, None)]


def test_edges(spark):
    rows = [(i, None if i == 3 else "http://h/\n", h, "x") for i, h in CASES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)
    assert rows_of(warc.round_trip(pages)) == sorted(expected(CASES), key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_index_finds_single_records(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 50_000) for i in range(8)], "page_id long, url string, html string")
    for r in warc.write_archives(pages, scratch_path(spark, "warc-test")).collect():
        headers, block = warc.read_record(r["bundle"], r["frame"], r["offset"], r["length"])
        assert headers["X-Page-ID"] == str(r["page_id"]) and headers["WARC-Record-ID"] == r["record_id"]
        assert block.endswith(f"<p>{r['page_id']}</p>".encode() * 50_000)


@pytest.mark.parametrize("cut", [1, 20])
def test_a_broken_bundle_is_an_error(cut):
    data, _ = bundle([warc.record(1, None, b"x", "00", 1)])
    with pytest.raises((ValueError, struct.error)):
        warc.BundleReader(pa.BufferReader(data[:-cut]))
