"""WARC: exact round trip, revisits, and what the reader must refuse."""

import base64
import hashlib
import io
import struct
import tracemalloc

import pytest
import zstandard as zstd

from quire.llm import warc
from quire.llm.entry import op1_warc


def expected(rows):
    out, first = [], {}
    body = lambda h: (h or "").encode()
    for page, _, html in rows:
        if page is not None:
            first[body(html)] = min(page, first.get(body(html), page))
    for page, _, html in rows:
        least = first.get(body(html))
        revisit = least is not None and page != least
        out.append((page, len(body(html)), base64.b32encode(hashlib.sha1(body(html)).digest()).decode(), "revisit" if revisit else "response", least if revisit else None))
    return sorted(map(repr, out))


def test_round_trip_with_every_odd_row(spark):
    rows = [(1, "http://a/x y", "<p>é</p>"), (2, None, None), (3, "", ""), (4, "u", "<p>é</p>"), (4, "u", "<p>é</p>"), (None, "u", "lone"), (7, "u", "x" * 300_000), (8, "u", "lone"), (9, "u\r\nEvil: 1", "\r\n\r\n")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, sha1 string")
    got = warc.round_trip(df).collect()
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected(rows)


def test_payloads_and_uris_come_back(spark):
    df = spark.createDataFrame([(1, "http://a/", "one"), (2, "http://b/", "two")], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(warc.with_revisits(df)), with_payload=True).collect()
    assert {(r.page_id, r.uri, bytes(r.payload)) for r in got} == {(1, "http://a/", b"one"), (2, "http://b/", b"two")}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_against_a_plain_reading(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(repr(tuple(r)) for r in op1_warc(spark, sf).collect()) == expected(rows)


def archive(records, words=b"WARC/1.1 dictionary words", magic=0x184D2A5D):
    packer = zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(words), write_checksum=True)
    return struct.pack("<II", magic, len(words)) + words + b"".join(packer.compress(r) for r in records)


GOOD = warc.encode({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:1>", "WARC-Date": "2024-01-01T00:00:00Z"}, b"block")


def test_reads_what_others_write():
    got = list(warc.records(io.BytesIO(archive([GOOD, GOOD])), size=7))
    assert [r.block for r in got] == [b"block"] * 2 and got[0].headers["warc-type"] == "response"
    words = b"WARC/1.1 dictionary words"
    squeezed = zstd.ZstdCompressor().compress(words)
    whole = archive([GOOD])
    packed = struct.pack("<II", 0x184D2A5D, len(squeezed)) + squeezed + whole[8 + len(words) :]
    assert next(warc.records(io.BytesIO(packed))).block == b"block"


@pytest.mark.parametrize(
    "data",
    [
        b"", archive([GOOD], magic=0x184D2A50), archive([GOOD])[:-3], archive([GOOD.replace(b"Content-Length: 5", b"Content-Length: 4")]), archive([GOOD.replace(b"Content-Length: 5", b"Content-Length: 6")]),
        archive([GOOD.replace(b"WARC/1.1", b"WARC/9.9")]), archive([GOOD.replace(b"WARC-Date", b"WARC-Fate")]), archive([GOOD.replace(b"WARC-Type: response", b"WARC-Type response")]), archive([GOOD + b"x"]), archive([GOOD])[:20],
    ],
)
def test_refuses_bad_archives(data):
    with pytest.raises(warc.BadArchive):
        list(warc.records(io.BytesIO(data)))


def test_a_flipped_bit_is_found():
    data = bytearray(archive([GOOD * 1]))
    data[-2] ^= 1
    with pytest.raises(warc.BadArchive):
        list(warc.records(io.BytesIO(bytes(data))))


def test_a_record_that_decodes_to_too_much_is_refused():
    bomb = warc.encode({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:1>", "WARC-Date": "2024-01-01T00:00:00Z"}, b"0" * 5_000_000)
    data = archive([GOOD, bomb])
    assert len(data) < 10_000 and len(list(warc.records(io.BytesIO(data)))) == 2
    with pytest.raises(warc.BadArchive, match="record 1: more than"):
        list(warc.records(io.BytesIO(data), most=1_000_000))


def test_a_bomb_is_refused_in_little_memory():
    bomb = warc.encode({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:1>", "WARC-Date": "2024-01-01T00:00:00Z"}, bytes(600_000_000))
    data = archive([GOOD, bomb])
    del bomb
    assert len(data) < 60_000
    tracemalloc.start()
    with pytest.raises(warc.BadArchive, match="record 1: more than"):
        list(warc.records(io.BytesIO(data), most=1_000_000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_revisits_that_do_not_match_what_they_refer_to(spark):
    rows = [(1, 3, "A", "response", None), (2, 3, "A", "revisit", 1), (3, 4, "A", "revisit", 1), (4, 3, "B", "revisit", 1), (5, 3, "A", "revisit", 9)]
    df = spark.createDataFrame(rows, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    assert sorted(r.page_id for r in warc.bad_revisits(df).collect()) == [3, 4, 5]
    pages = spark.createDataFrame([(i, "u", "same" if i % 2 else f"p{i}") for i in range(40)] + [(50, "u", "y" * 3_000_000)], "page_id long, url string, html string")
    assert warc.bad_revisits(warc.round_trip(pages)).count() == 0


def test_many_equal_payloads_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", -1)
    rows = [(i, "u", "same" if i % 3 else f"p{i % 5}") for i in range(200)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected(rows)
