"""Fill-in-the-middle over texts kept in seekable compressed frames.

A file holds texts one after another, each cut into pieces of fixed size that are
independent Zstandard frames, and at its end an index in a skippable frame, so any
Zstandard reader sees plain text. For every frame the index has where it lies and how
many units (lines), code points and bytes of its text end with it. Prefix, middle and
suffix are cut between units: the cumulative counts name the frame of a cut, and only
that frame is decompressed to place it. Outputs are then streams of frames in the
order of their form, never a whole text, and so is the text rebuilt from an output.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from clickloom.llm import files
from clickloom.llm.frames import in_tasks, take
from clickloom.session import stage

MAGIC = b"SEEKTXT1"
INDEX_FRAME = 0x184D2A5D  # a skippable frame
TRAILER = struct.Struct("<QQQ8s")  # documents, frames, bytes of the packed index, magic
FRAME_BYTES = 1 << 16  # text in a frame
FILE_BYTES = 256 << 20  # a task begins a new file after so many
READ_BYTES = 1 << 20  # read at once from a file
LEVEL = 3
NEWLINE = b"\n"


@dataclass(frozen=True)
class Fim:
    """How documents are drawn and marked; shares in percent."""

    seed: int = 7
    share: int = 100  # of documents with any units to move
    spm: int = 50  # of those, with the suffix in front
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def marks(self, form: str) -> list[bytes]:
        front = [self.prefix, self.suffix] if form == "psm" else [self.suffix, self.prefix]
        return [*front, self.middle]


def _chars(raw: bytes) -> int:
    """Code points: bytes that do not continue one."""
    return int(np.count_nonzero(np.frombuffer(raw, dtype=np.int8) >= -64))


class TextWriter:
    """Writes texts to a stream as frames; holds the index."""

    def __init__(self, out, marks: list[bytes], frame_bytes: int = FRAME_BYTES):
        self.out, self.marks, self.frame_bytes = out, marks, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.docs: list[int | None] = []
        self.marked: list[bool] = []
        self.firsts = [0]
        self.offsets = [0]
        self.units: list[int] = []
        self.chars: list[int] = []
        self.bytes: list[int] = []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        self.docs.append(doc_id)
        self.marked.append(any(m in raw for m in self.marks))
        units = chars = 0
        for at in range(0, len(raw), self.frame_bytes):
            piece = raw[at : at + self.frame_bytes]
            frame = self.compressor.compress(piece)
            self.out.write(frame)
            units, chars = units + piece.count(NEWLINE), chars + _chars(piece)
            self.offsets.append(self.offsets[-1] + len(frame))
            self.units.append(units)
            self.chars.append(chars)
            self.bytes.append(at + len(piece))
        if raw and not raw.endswith(NEWLINE):
            self.units[-1] += 1  # the last line ends with the text
        self.firsts.append(len(self.units))

    def close(self) -> None:
        columns = [[d or 0 for d in self.docs], [d is not None for d in self.docs], self.marked, self.firsts,
                   self.offsets, self.units, self.chars, self.bytes]
        packed = self.compressor.compress(b"".join(np.array(c, dtype="<i8").tobytes() for c in columns))
        body = packed + TRAILER.pack(len(self.docs), len(self.units), len(packed), MAGIC)
        self.out.write(struct.pack("<II", INDEX_FRAME, len(body)) + body)


class TextFile:
    """Random access to the texts of a file."""

    def __init__(self, file):
        self.file, self.at, self.window = file, 0, b""
        size = file.size()
        docs, frames, packed, magic = TRAILER.unpack(self._read(size - TRAILER.size, size))
        if magic != MAGIC:
            raise ValueError("not a file of seekable texts")
        raw = zstandard.ZstdDecompressor().decompress(self._read(size - TRAILER.size - packed, size - TRAILER.size))
        values = np.frombuffer(raw, dtype="<i8")
        bounds = np.cumsum([docs, docs, docs, docs + 1, frames + 1, frames, frames])
        self.doc_ids, known, marked, self.firsts, self.offsets, self.units, self.chars, self.bytes = np.split(values, bounds)
        self.known, self.marked = known.astype(bool), marked.astype(bool)
        self.decompressor = zstandard.ZstdDecompressor()
        self.held: tuple[int, bytes] = (-1, b"")

    def _read(self, start: int, stop: int) -> bytes:
        if start < self.at or stop > self.at + len(self.window):
            self.file.seek(start)
            self.at, self.window = start, self.file.read(max(stop - start, READ_BYTES))
        return self.window[start - self.at : stop - self.at]

    def frame(self, i: int) -> bytes:
        """The text of a frame; the last one asked for is kept."""
        if self.held[0] != i:
            raw = self._read(int(self.offsets[i]), int(self.offsets[i + 1]))
            self.held = (i, self.decompressor.decompress(raw))
        return self.held[1]

    def text(self, i: int) -> Text:
        return Text(self, int(self.firsts[i]), int(self.firsts[i + 1]))


class Text:
    """A text of a file, by its frames from ``first`` up to ``last``."""

    def __init__(self, file: TextFile, first: int, last: int):
        self.file, self.first, self.last = file, first, last
        self.n_units, self.n_chars, self.n_bytes = (
            (int(file.units[last - 1]), int(file.chars[last - 1]), int(file.bytes[last - 1])) if last > first else (0, 0, 0)
        )

    def _before(self, frame: int, counts: np.ndarray) -> int:
        return int(counts[frame - 1]) if frame > self.first else 0

    def cut(self, unit: int) -> tuple[int, int]:
        """Bytes and code points up to the end of so many units."""
        if unit == 0:
            return 0, 0
        if unit == self.n_units:
            return self.n_bytes, self.n_chars
        i = self.first + int(np.searchsorted(self.file.units[self.first : self.last], unit))
        raw = self.file.frame(i)
        lines = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == NEWLINE[0])
        end = int(lines[unit - self._before(i, self.file.units) - 1]) + 1
        return self._before(i, self.file.bytes) + end, self._before(i, self.file.chars) + _chars(raw[:end])

    def stream(self, start: int, stop: int) -> Iterator[bytes]:
        """The bytes from ``start`` up to ``stop``, frame by frame."""
        if stop <= start:
            return
        ends = self.file.bytes[self.first : self.last]
        for i in range(self.first + int(np.searchsorted(ends, start, side="right")), self.last):
            at = self._before(i, self.file.bytes)
            if at >= stop:
                return
            yield self.file.frame(i)[max(0, start - at) : stop - at]


@dataclass(frozen=True)
class Cuts:
    """A document's form, and where its prefix and middle end in bytes and code points."""

    form: str
    prefix: tuple[int, int] = (0, 0)
    middle: tuple[int, int] = (0, 0)


def cuts(doc_id: int | None, text: Text, marked: bool, fim: Fim) -> Cuts:
    key = f"{fim.seed}:{'null' if doc_id is None else doc_id}"
    h = struct.unpack(">4I", hashlib.sha256(key.encode()).digest()[:16])
    if not text.n_bytes or marked or h[2] % 100 >= fim.share:
        return Cuts("plain")
    first, second = sorted(x % (text.n_units + 1) for x in h[:2])
    return Cuts("spm" if h[3] % 100 < fim.spm else "psm", text.cut(first), text.cut(second))


def output(text: Text, found: Cuts, fim: Fim) -> Iterator[bytes]:
    """The document in its form, as a stream."""
    if found.form == "plain":
        yield from text.stream(0, text.n_bytes)
        return
    spans = {
        fim.prefix: (0, found.prefix[0]), fim.middle: (found.prefix[0], found.middle[0]), fim.suffix: (found.middle[0], text.n_bytes),
    }
    for mark in fim.marks(found.form):
        yield mark
        yield from text.stream(*spans[mark])


def sections(chunks: Iterator[bytes], marks: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """What stands behind each mark, in pieces. Marks may lie across two chunks.

    No text holds a mark, and none arises where a text meets one: only the first
    character of a mark is ``<``.
    """
    held, at = b"", -1
    for chunk in chunks:
        held += chunk
        while at + 1 < len(marks) and (found := held.find(marks[at + 1])) >= 0:
            if at < 0 < found:
                raise ValueError("text in front of the first mark")
            if found:
                yield at, held[:found]
            held, at = held[found + len(marks[at + 1]) :], at + 1
        if at >= 0:
            # a mark may have begun
            ready = len(held) - (len(marks[at + 1]) - 1 if at + 1 < len(marks) else 0)
            if ready > 0:
                yield at, held[:ready]
                held = held[ready:]
    if at + 1 < len(marks):
        raise ValueError(f"no {marks[at + 1]!r} in the output")
    if held:
        yield at, held


def restored(form: str, chunks: Callable[[], Iterator[bytes]], fim: Fim) -> Iterator[bytes]:
    """The text rebuilt from an output and its form alone.

    The output is read twice, the second time for the suffix, so that nothing is kept.
    """
    if form == "plain":
        yield from chunks()
        return
    marks = fim.marks(form)
    suffix = marks.index(fim.suffix)
    yield from (piece for at, piece in sections(chunks(), marks) if at != suffix)
    yield from (piece for at, piece in sections(chunks(), marks) if at == suffix)


def _digest(chunks: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for chunk in chunks:
        digest.update(chunk)
    return digest.hexdigest()


def write_texts(docs: DataFrame, folder: str, fim: Fim = Fim(), frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the whole texts of ``docs`` (doc_id, text) as frames; returns the list of files: path, n_docs.

    Every task writes what it reads, without a shuffle.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = stream = path = None

        def closed() -> pa.RecordBatch:
            writer.close()
            stream.close()
            return pa.RecordBatch.from_pylist([{"path": path, "n_docs": len(writer.docs)}])

        count = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for doc_id, raw in zip(batch.column(0).to_pylist(), texts):
                if writer is None:
                    path, stream = files.create(folder, f"-{count:04d}.txt.zst")
                    writer, count = TextWriter(stream, fim.marks("psm"), frame_bytes), count + 1
                writer.add(doc_id, raw.as_py() or b"")
                if writer.offsets[-1] >= FILE_BYTES:
                    yield closed()
                    writer = None
        if writer is not None:
            yield closed()

    rows = take(docs, {"doc_id": "doc_id", "text": "text"}).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stage(in_tasks(rows, written, "path string, n_docs long"), "text-files")


def _over_texts(written: DataFrame, fim: Fim, row: Callable[[Text, Cuts], tuple], schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """doc_id, n and form of every text in the listed files, with further columns."""
    names = ["doc_id", "n", "form", *[c.split()[0] for c in schema.split(", ")]]
    kinds = [pa.int64(), pa.int64(), pa.string(), *kinds]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_random(path) as raw:
                    file = TextFile(raw)
                    rows: list[tuple] = []
                    size = 0
                    for i, doc_id in enumerate(file.doc_ids.tolist()):
                        doc_id, text = doc_id if file.known[i] else None, file.text(i)
                        found = cuts(doc_id, text, bool(file.marked[i]), fim)
                        rows.append((doc_id, text.n_units, found.form, *row(text, found)))
                        size += text.n_bytes
                        if len(rows) == 4096 or size >= 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return in_tasks(files.one_task_each(written.select("path")), read, f"doc_id long, n long, form string, {schema}")


def outputs(written: DataFrame, fim: Fim = Fim()) -> DataFrame:
    """(doc_id, n, form, output) of every text in the listed files."""

    def row(text: Text, found: Cuts) -> tuple:
        return (b"".join(output(text, found, fim)).decode(),)

    return _over_texts(written, fim, row, "output string", [pa.string()])


def digests(written: DataFrame, fim: Fim = Fim()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every text.

    Both digests are taken over streams; the restored one over the text that is rebuilt
    from the output and its form.
    """

    def row(text: Text, found: Cuts) -> tuple:
        def chunks() -> Iterator[bytes]:
            return output(text, found, fim)

        plain = found.form == "plain"
        return (
            None if plain else found.prefix[1], None if plain else found.middle[1] - found.prefix[1],
            _digest(chunks()), _digest(restored(found.form, chunks, fim)),
        )

    schema = "prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return _over_texts(written, fim, row, schema, [pa.int64(), pa.int64(), pa.string(), pa.string()])


def round_trip(docs: DataFrame, fim: Fim = Fim(), frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write all texts and report each with its output and what is rebuilt from it.

    A null text is empty; empty texts and those that hold a mark are plain, without
    lengths. A row without a doc_id is drawn by the word ``null``. Repeated rows give
    repeated results. Other columns are ignored; an empty table writes no file and
    gives no rows.
    """
    folder = files.new_folder(docs.sparkSession, "texts")
    return digests(write_texts(docs, folder, fim, frame_bytes), fim)
