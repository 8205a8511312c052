"""WARC archives compressed record by record with a dictionary of their own.

Each file is a .warc.zst: a skippable frame in front holds a Zstandard dictionary
trained on records of the file, then every record is a frame compressed with it, so
any record can be read alone. Pages with equal payloads are stored once: the one with
the smallest page id as a response, the others as revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from clickloom.llm import files
from clickloom.llm.frames import in_tasks, row_key, take
from clickloom.session import stage

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

FILE_BYTES = 24 << 20  # records of a file before compression, unless one is larger
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES, SAMPLE_RECORD = 4 << 20, 64 << 10  # of the records the dictionary is trained on
SAMPLES = 10  # fewest samples to train on
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # the tables hold no time of capture


def _record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url}#{page_id}')}>"


def _target(page_id: int | None, url: str | None) -> str:
    """The address without characters that could end a header line."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:page:{page_id}"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, sha1: bytes, revisit: bool, first_id, first_url) -> bytes:
    digest = base64.b32encode(sha1).decode()
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, url)),
        ("WARC-Date", DATE), ("WARC-Target-URI", _target(page_id, url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"), ("X-Page-Id", page_id), ("X-Payload-Length", len(payload)),
    ]
    if not revisit:
        return _record(fields, HTTP + payload)
    fields += [
        ("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first_id, first_url)),
        ("WARC-Refers-To-Target-URI", _target(first_id, first_url)), ("X-Refers-To-Page-Id", first_id),
    ]
    return _record(fields, HTTP)


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from records spread over the file.

    Of few records each is several samples. Where there is too little to train on, or
    records are too alike, the records themselves are the dictionary.
    """
    step = max(1, sum(min(len(r), SAMPLE_RECORD) for r in records) // SAMPLE_BYTES)
    samples = [r[:SAMPLE_RECORD] for r in records[::step]]
    whole = b"".join(samples)
    if len(samples) < SAMPLES:
        size = max(256, len(whole) // (4 * SAMPLES))
        samples = [whole[at : at + size] for at in range(0, len(whole), size)]
    size = min(DICTIONARY_BYTES, len(whole) // 10)
    if len(samples) >= SAMPLES and size >= 1024:
        try:
            return zstandard.train_dictionary(size, samples, k=200, d=8)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(whole[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(records: list[bytes], out) -> None:
    dictionary = train(records)
    raw = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
    out.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
    for record in records:
        out.write(compressor.compress(record))


def read_archive(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a .warc.zst stream."""
    head = file.read(8)
    dictionary, front = None, head
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_FRAME:
        raw = file.read(struct.unpack("<II", head)[1])
        dictionary, front = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw)), b""

    class Joined(io.RawIOBase):
        def readable(self) -> bool:
            return True

        def readinto(self, buffer) -> int:
            nonlocal front
            data, front = (front[: len(buffer)], front[len(buffer) :]) if front else (file.read(len(buffer)), b"")
            buffer[: len(data)] = data
            return len(data)

    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    with io.BufferedReader(decompressor.stream_reader(Joined(), read_across_frames=True), 1 << 20) as stream:
        while line := stream.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"no record begins with {line[:40]!r}")
            headers = {}
            while (line := stream.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                headers[name] = value
            block = stream.read(int(headers["Content-Length"]))
            if stream.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield headers, block


def write_pages(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` (page_id, url, html); returns the list of files: path, n_records.

    Equal payloads of at least ``least_bytes`` share one response. Only digests and
    ids are grouped; a payload is shuffled once, by its row and not by its digest, so
    a payload that many pages share does not meet in one task.
    """
    rows = take(pages, {"page_id": "page_id", "url": "url", "html": "html"}).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("payload"),
        row_key("page_id", "url", "html").alias("key"),
    ).select("page_id", "url", "payload", "key.*")
    digests = stage(
        rows.select("a", "b", "page_id", "url", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n_bytes")),
        "page-digests",
    )
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", F.col("url").isNull().alias("bare"), "url", "a", "b")
    shared = (
        digests.filter(F.col("n_bytes") >= least_bytes).groupBy("sha1", "n_bytes")
        .agg(F.count("*").alias("n"), F.min(order).alias("first")).filter("n > 1")
    )
    known = digests.join(shared, ["sha1", "n_bytes"]).select(
        "a", "b", ((F.col("a") == F.col("first.a")) & (F.col("b") == F.col("first.b"))).alias("is_first"),
        F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
    ).distinct()
    # equal rows are combined before they are shuffled, and told apart when they are written
    single = rows.groupBy("a", "b").agg(*[F.first(c).alias(c) for c in ("page_id", "url", "payload")], F.count("*").alias("copies"))
    ready = single.join(known, ["a", "b"], "left").select("page_id", "url", "payload", "copies", "is_first", "first_id", "first_url")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal records, size
            path, out = files.create(folder, f"-{count:04d}.warc.zst")
            info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(count, path)), ("WARC-Date", DATE)], b"")
            with out:
                write_archive([info, *records], out)
            row = {"path": path, "n_records": len(records)}
            records, size = [], 0
            return pa.RecordBatch.from_pylist([row])

        count = 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                page_id, url, text, copies, is_first, *first = row
                payload = text.encode()
                digest = hashlib.sha1(payload).digest()
                for copy in range(copies):
                    # of equal rows the first one written is the response
                    revisit = is_first is not None and not (is_first and copy == 0)
                    records.append(page_record(page_id, url, payload, digest, revisit, *first))
                    size += len(records[-1])
                    if size >= FILE_BYTES:
                        yield flush()
                        count += 1
        if records:
            yield flush()

    return stage(in_tasks(ready, written, "path string, n_records long"), "warc-files")


def read_pages(written: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the archived pages.

    The payload of a response is measured and its digest checked; a revisit carries both.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [c.split()[0] for c in schema.split(", ")]

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with files.open_stream(path) as file:
                    for headers, block in read_archive(file):
                        kind = headers["WARC-Type"]
                        if kind not in ("response", "revisit"):
                            continue
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(headers["X-Payload-Length"])
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            size = len(payload)
                            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                                raise ValueError(f"a payload in {path} has another digest")
                        first = number(headers.get("X-Refers-To-Page-Id"))
                        rows.append((number(headers.get("X-Page-Id")), size, digest, kind, first))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return in_tasks(files.one_task_each(written.select("path")), parsed, schema)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive all pages and report each as read back from the archives.

    A null html is an empty payload. Pages without an id are archived without one and
    come after all others when a response is chosen; of equal rows one is the response.
    A page without a url gets one made of its id. Other columns are ignored; an empty
    table writes no archive and gives no rows.
    """
    return read_pages(write_pages(pages, files.new_folder(pages.sparkSession, "warc"), least_bytes))
