"""Token ids in files of fixed-width bit fields.

Each id takes as many bits as the largest id of the vocabulary needs. Ids are
packed in blocks of fixed length, least significant bit first, every block from a
whole byte on, so numpy unpacks a block at once and any id is found by arithmetic.

Layout: magic; blocks; doc ids (int64); whether they are known (uint8); first id of
each document and the total (uint64); offset of each block and of their end
(uint64); trailer with the counts, block length and width; magic.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from clickloom.llm import files
from clickloom.llm.frames import in_tasks, take
from clickloom.llm.tokens import encoder, share, slices
from clickloom.session import stage

MAGIC = b"FWTOKEN1"
TRAILER = struct.Struct("<QQQII8s")  # documents, ids, blocks, ids per block, width, magic
BLOCK_IDS = 1 << 16


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids[:, None].astype(np.uint32) >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(raw: bytes, count: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(raw, dtype=f"<u{width // 8}", count=count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=count * width, bitorder="little")
    return bits.reshape(count, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


class TokenWriter:
    """Writes documents to a stream; holds one incomplete block and the index."""

    def __init__(self, out, width: int, block_ids: int = BLOCK_IDS):
        self.out, self.width, self.block_ids = out, width, block_ids
        self.rest = np.empty(0, dtype=np.uint32)
        self.docs: list[int | None] = []
        self.starts, self.blocks = [0], [len(MAGIC)]
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> None:
        """Documents with their ids one after another, ``ends`` being the end of each."""
        if len(ids) and int(ids.max()) >> self.width:
            raise ValueError(f"id {ids.max()} needs more than {self.width} bits")
        first = self.starts[-1]
        self.docs += doc_ids
        self.starts += (first + ends).tolist()
        self.rest = np.concatenate([self.rest, ids])
        while len(self.rest) >= self.block_ids:
            self._block(self.rest[: self.block_ids])
            self.rest = self.rest[self.block_ids :]

    def _block(self, ids: np.ndarray) -> None:
        raw = pack_bits(ids, self.width)
        self.out.write(raw)
        self.blocks.append(self.blocks[-1] + len(raw))

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        known = np.array([d is not None for d in self.docs], dtype=np.uint8)
        self.out.write(np.array([d or 0 for d in self.docs], dtype="<i8").tobytes())
        self.out.write(known.tobytes())
        self.out.write(np.array(self.starts, dtype="<u8").tobytes())
        self.out.write(np.array(self.blocks, dtype="<u8").tobytes())
        counts = len(self.docs), self.starts[-1], len(self.blocks) - 1
        self.out.write(TRAILER.pack(*counts, self.block_ids, self.width, MAGIC))


class TokenFile:
    """Random access to a file of token ids."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        raw = self._read(size - TRAILER.size, size)
        docs, self.n_ids, blocks, self.block_ids, self.width, magic = TRAILER.unpack(raw)
        if magic != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of token ids")
        at = size - TRAILER.size - 8 * (blocks + 1) - 8 * (docs + 1) - docs - 8 * docs
        raw = self._read(at, size - TRAILER.size)
        self.doc_ids = np.frombuffer(raw, "<i8", docs)
        self.known = np.frombuffer(raw, np.uint8, docs, 8 * docs).astype(bool)
        self.starts = np.frombuffer(raw, "<u8", docs + 1, 9 * docs).astype(np.int64)
        self.blocks = np.frombuffer(raw, "<u8", blocks + 1, 9 * docs + 8 * (docs + 1)).astype(np.int64)

    def _read(self, start: int, stop: int) -> bytes:
        self.file.seek(start)
        return self.file.read(stop - start)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, reading only the blocks that hold them."""
        if stop <= start:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        raw = self._read(self.blocks[first], self.blocks[last + 1])
        parts = []
        for b in range(first, last + 1):
            count = min(self.block_ids, self.n_ids - b * self.block_ids)
            own = raw[self.blocks[b] - self.blocks[first] : self.blocks[b + 1] - self.blocks[first]]
            parts.append(unpack_bits(own, count, self.width))
        return np.concatenate(parts)[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end: int = 0) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text), each row's followed by ``end``.

    Files and rows are in ascending order of doc_id (null first; equal ids by a hash
    of their text). Returns the list of files: part (their order), path, n_docs, n_ids.
    """
    spec = share(docs.sparkSession, tokenizer)
    width = max(1, (vocabulary - 1).bit_length())

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = stream = path = None
        for batch in batches:
            for at, stop in slices(batch.column(1)):
                if writer is None:
                    path, stream = files.create(folder, ".fwt")
                    writer = TokenWriter(stream, width)
                ids, ends = encoder(spec, end).encode(batch.column(1).slice(at, stop - at))
                writer.add(batch.column(0).slice(at, stop - at).to_pylist(), ids, ends[1:])
        if writer is not None:
            writer.close()
            stream.close()
            pa.default_memory_pool().release_unused()  # the worker waits for further tasks
            row = {"part": TaskContext.get().partitionId(), "path": path, "n_docs": len(writer.docs), "n_ids": writer.starts[-1]}
            yield pa.RecordBatch.from_pylist([row])

    rows = take(docs, {"doc_id": "doc_id", "text": "text"}).select(F.col("doc_id").cast("long"), "text")
    # a second key, so that many rows of one id do not meet in one task
    order = ["doc_id", F.xxhash64("text")]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(in_tasks(parts, written, "part long, path string, n_docs long, n_ids long"), "token-files")


def read_tokens(written: DataFrame) -> DataFrame:
    """What the listed files hold: doc_id, start (ids before it in all files), n_tokens, ids_crc32."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    listed = written.select("path", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).cast("long").alias("first"))

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_random(path) as raw:
                    file = TokenFile(raw)
                    crcs = np.zeros(len(file.doc_ids), dtype=np.int64)
                    chunk = 64 * file.block_ids
                    for start in range(0, file.n_ids, chunk):
                        stop = min(start + chunk, file.n_ids)
                        data = memoryview(file.ids(start, stop).astype("<u4").tobytes())
                        at = int(np.searchsorted(file.starts, start, side="right")) - 1
                        while at < len(crcs) and file.starts[at] < stop:
                            a, b = max(start, file.starts[at]) - start, min(stop, file.starts[at + 1]) - start
                            crcs[at] = zlib.crc32(data[4 * a : 4 * b], int(crcs[at]))
                            at += 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids, mask=~file.known), pa.array(first + file.starts[:-1]),
                            pa.array(np.diff(file.starts)), pa.array(crcs),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return in_tasks(files.one_task_each(listed), checked, schema)


def round_trip(docs: DataFrame, tokenizer: str, vocabulary: int, end: int = 0) -> DataFrame:
    """Write the ids of all rows and report each row as read back from the files.

    A null text is empty and has the end id alone. Repeated rows and rows without a
    doc_id are written like others. Other columns are ignored; an empty table
    writes no file and gives no rows.
    """
    folder = files.new_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer, vocabulary, end))
