import base64
import hashlib
import io
import struct

import pytest
import zstandard

from clickloom.llm import files, warc

PAGES = [(i, f"http://host/{i}", f"<html><body>page {i % 37} " + "shared words of many pages " * 20 + "</body></html>") for i in range(300)]
PAGES += [(1000, None, None), (1001, "http://bad\r\nX-Header: 1/é ", ""), (None, "http://none", "page without id"), (1002, "http://same", "twice"), (1002, "http://same", "twice"), (None, None, "twice")]


def expected(rows, least=0):
    found, seen = [], {}
    for page_id, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = len(raw) >= least and raw in seen
        found.append((page_id, len(raw), digest, "revisit" if again else "response", seen[raw] if again else None))
        seen.setdefault(raw, page_id)
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, payload string, HTML int")


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip_equals_brute_force(pages, least):
    assert sorted(map(tuple, warc.round_trip(pages, least).collect()), key=str) == expected(PAGES, least)


def test_empty_table_and_long_payload(pages, spark):
    assert warc.round_trip(pages.limit(0)).count() == 0
    long = [(1, "u", "long " * 400_000)]
    assert [tuple(r) for r in warc.round_trip(spark.createDataFrame(long, "page_id long, url string, html string")).collect()] == expected(long)


def test_files_hold_a_dictionary_and_single_records(pages):
    listed = warc.write_pages(pages.coalesce(1), files.new_folder(pages.sparkSession, "warc")).collect()
    raw = b""
    for row in listed:
        with files.open_stream(row.path) as file:
            content = file.read()
        raw = max(raw, content, key=len)
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]))
    # every record is a frame of its own
    rest, frames = raw[8 + size :], []
    while rest:
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        frames.append(reader.decompress(rest))
        rest = reader.unused_data
    assert len(frames) == max(r.n_records for r in listed) + 1 and all(f.startswith(b"WARC/1.1\r\n") for f in frames)
    headers = [h for h, _ in warc.read_archive(io.BytesIO(raw))]
    assert headers[0]["WARC-Type"] == "warcinfo" and not any("X-Header" in h for h in headers)
    ids = [h["WARC-Record-ID"] for h in headers]
    assert {h["WARC-Refers-To"] for h in headers if "WARC-Refers-To" in h} and len(ids) == len(frames)


@pytest.mark.parametrize("records", [
    [b"WARC/1.1\r\n\r\n"], [b"WARC/1.1\r\nx: 1\r\n\r\n" * 3, b"tiny"], [b"same record " * 40] * 9, [b"one long record of many words " * 20_000],
])
def test_every_archive_has_a_dictionary(records):
    """Also of one short record, of copies, and of a single long one."""
    out = io.BytesIO()
    warc.write_archive(records, out)
    raw = out.getvalue()
    magic, size = struct.unpack("<II", raw[:8])
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]))
    assert magic == 0x184D2A5D and len(dictionary.as_bytes()) >= 8
    rest, found = raw[8 + size :], []
    while rest:
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        found.append(reader.decompress(rest))
        rest = reader.unused_data
    assert found == records


def test_files_are_stored_as_written(pages):
    """A Zstandard frame on disk, not one inside another."""
    listed = warc.write_pages(pages.limit(40), files.new_folder(pages.sparkSession, "warc")).collect()
    assert listed
    for row in listed:
        system, path = files._located(row.path)
        with system.open_input_stream(path, compression=None) as file:
            assert struct.unpack("<I", file.read(4))[0] == 0x184D2A5D


def test_a_row_repeated_often_is_combined_before_it_is_shuffled(spark):
    many = spark.range(5000).selectExpr("7L AS page_id", "'u' AS url", "'copied payload' AS html")
    found = warc.round_trip(many.union(spark.createDataFrame([(9, "v", "copied payload")], many.schema))).groupBy("page_id", "record_type", "refers_to").count().collect()
    assert sorted(map(tuple, found), key=str) == [(7, "response", None, 1), (7, "revisit", 7, 4999), (9, "revisit", 7, 1)]
