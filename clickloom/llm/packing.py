"""Packing of examples into training sequences under several limits at once.

Vector bin packing: an example needs tokens, one segment and loss-bearing tokens;
a sequence offers so much of each. The open sequence takes the example that fits
and whose needs, as a share of the limits, have the largest dot product with what
is left. Pieces as long as a sequence are sequences of their own. What no whole
example fills is filled with the front of a cut one.

Each task packs the rows it reads in groups of bounded size and carries the last,
incomplete sequence of a group into the next one, so nothing is shuffled. The
last sequence of a task is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.frames import in_tasks, take
from clickloom.llm.tokens import encoder, share, slices

GROUP_ROWS = 2048
GROUP_TOKENS = 8_000_000


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 128
    loss: int = 1024


@dataclass
class Piece:
    item: int  # the example
    start: int  # tokens of the example before the piece
    length: int
    free: int  # tokens of the example, from its first, that bear no loss

    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.free))

    def cut(self, length: int) -> tuple["Piece", "Piece"]:
        return (
            Piece(self.item, self.start, length, self.free),
            Piece(self.item, self.start + length, self.length - length, self.free),
        )


def power_of_two(n: int) -> bool:
    return n & (n - 1) == 0


def without_padding(pieces: list[Piece], limits: Limits) -> Iterator[list[Piece]]:
    """The pieces as sequences of full length or of a power of two."""
    rest = list(pieces)
    while rest:
        size = sum(p.length for p in rest)
        room = min(limits.tokens, size)
        if room < limits.tokens:
            room = 1 << (room.bit_length() - 1)
        sequence: list[Piece] = []
        while room:
            first = rest.pop(0)
            if first.length > room:
                first, behind = first.cut(room)
                rest.insert(0, behind)
            sequence.append(first)
            room -= first.length
        yield sequence


def longest(piece: Piece, room: int, loss: int) -> int:
    """The longest front of the piece that fits the room and the loss that is left."""
    return min(piece.length, room, max(0, piece.free - piece.start) + loss)


def place(pieces: list[Piece], limits: Limits, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Complete sequences of the pieces, and those of the last one unless ``last``."""
    most = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
    done: list[list[Piece]] = []
    items: list[Piece] = []
    for piece in pieces:
        while (front := longest(piece, limits.tokens, limits.loss)) == limits.tokens or front < piece.length:
            whole, piece = piece.cut(front)
            done += [[whole]] if front == limits.tokens else list(without_padding([whole], limits))
        if piece.length:
            items.append(piece)
    needs = np.array([(p.length, 1, p.loss()) for p in items], dtype=np.float64).reshape(-1, 3)
    shares = needs / most
    open_, left = [], most.copy()
    while items:
        alive = needs[:, 0] > 0
        if not alive.any():
            break
        if alive.sum() * 2 < len(items):  # drop what is placed
            items = [p for p, keep in zip(items, alive) if keep]
            needs, shares = needs[alive], shares[alive]
            continue
        score = shares @ (left / most)
        fits = alive & (needs <= left).all(axis=1)
        if fits.any():
            at = int(np.argmax(np.where(fits, score, -1.0)))
            piece = items[at]
            needs[at] = 0
        else:
            at = int(np.argmax(np.where(alive, score, -1.0)))
            length = longest(items[at], int(left[0]), int(left[2])) if left[1] >= 1 else 0
            if not length:
                done += list(without_padding(open_, limits))
                open_, left = [], most.copy()
                continue
            piece, items[at] = items[at].cut(length)
            needs[at] = items[at].length, 1, items[at].loss()
            shares[at] = needs[at] / most
        open_.append(piece)
        left -= piece.length, 1, piece.loss()
        if not left[0]:
            done.append(open_)
            open_, left = [], most.copy()
    if last and open_:
        done += list(without_padding(open_, limits))
        open_ = []
    return done, open_


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def pack(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end: int = 0, free: int = 1, with_ids: bool = False,
    prompt: str | None = None,
) -> DataFrame:
    """Pieces of the token ids of every row of ``docs`` (doc_id, text), in sequences.

    A row's ids are those of its whole text, then ``end``; the first ``free`` bear
    no loss. For instruction data ``prompt`` names a column whose ids stand in front of
    those of the text and bear no loss at all; a null prompt is empty. Returns per piece doc_id, start (ids of its row before it), length,
    ids_crc32 (of the ids as little-endian 32-bit numbers), doc_tokens,
    sequence_id, offset (tokens of the sequence before it) and, ``with_ids``, the
    ids as such bytes. Every id lies in exactly one piece.

    A null text is empty and gives the end id alone. Repeated rows are packed like
    others, each on its own; rows without a doc_id too. Other columns are ignored.
    An empty table gives no rows.
    """
    spec = share(docs.sparkSession, tokenizer)
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["ids"] * with_ids

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(spec, end)
        first = TaskContext.get().partitionId() << 36
        held: dict[int, tuple[int | None, memoryview]] = {}  # example -> doc_id, ids
        waiting: list[Piece] = []
        tokens = example = sequences = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, held, tokens, sequences
            done, waiting = place(waiting, limits, last)
            rows = []
            for sequence in done:
                offset = 0
                for p in sequence:
                    doc_id, ids = held[p.item]
                    own = ids[4 * p.start : 4 * (p.start + p.length)]
                    row = (doc_id, p.start, p.length, zlib.crc32(own), len(ids) // 4, first + sequences, offset)
                    rows.append(row + (bytes(own),) * with_ids)
                    offset += p.length
                sequences += 1
            held = {p.item: held[p.item] for p in waiting}
            tokens = sum(len(ids) // 4 for _, ids in held.values())
            kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for at, stop in slices(batch.column(1)):
                ids, ends = code.encode(batch.column(1).slice(at, stop - at))
                raw = memoryview(ids.astype("<u4").tobytes())
                asked = [b""] * (stop - at)
                if prompt is not None:
                    asked = code.encode_apart(batch.column(2).slice(at, stop - at))
                for k, doc_id in enumerate(batch.column(0).slice(at, stop - at).to_pylist()):
                    own = raw[4 * ends[k] : 4 * ends[k + 1]]
                    held[example] = doc_id, memoryview(asked[k] + own) if asked[k] else own
                    size = int(ends[k + 1] - ends[k]) + len(asked[k]) // 4
                    waiting.append(Piece(example, 0, size, len(asked[k]) // 4 if prompt is not None else free))
                    example += 1
                    tokens += size
                    if len(waiting) >= GROUP_ROWS or tokens >= GROUP_TOKENS:
                        yield from flush(False)
        yield from flush(True)
        pa.default_memory_pool().release_unused()  # the worker waits for further tasks

    columns = {"doc_id": "doc_id", "text": "text"} | ({} if prompt is None else {"prompt": prompt})
    rows = take(docs, columns).withColumn("doc_id", F.col("doc_id").cast("long"))
    return in_tasks(rows, packed, SCHEMA + ", ids binary" * with_ids)
