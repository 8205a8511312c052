"""Token ids of whole texts with the tokenizers library, one encoding per distinct word.

A byte-level BPE with the usual pattern never joins what stands before a space
that is followed by a non-space with what follows. So a text can be cut there,
and equal chunks have equal ids. A task encodes each distinct chunk of a batch
once and keeps those of earlier batches, up to a bound. Texts with a space before
other white space or at their end are encoded whole.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

ODD = r" (?:[\s\p{Z}\x0b\x1c-\x1f\x{85}]|\z)"
KEPT_CHUNKS = 300_000  # distinct chunks a worker keeps between batches
BATCH_BYTES = 8 << 20  # text encoded at once, unless one text is longer
AT_ONCE = 4096  # texts given to the tokenizer together: what it returns for each is large
JOINED = 64  # chunks encoded as one text


class Encoder:
    def __init__(self, spec: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # tokens that begin with a space
        self.spaced = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.end = np.array([end], dtype="<u4").tobytes()
        self.kept: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        ids: list[bytes] = []
        for at in range(0, len(texts), AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False)
            ids += [array("I", x.ids).tobytes() for x in found]
        return ids

    def _after_space(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk after a space, many chunks to a text.

        A chunk holds no space, so each begins at the next token that begins with one.
        """
        found: list[bytes] = []
        for at in range(0, len(chunks), AT_ONCE):
            part = chunks[at : at + AT_ONCE]
            texts = [" " + " ".join(part[i : i + JOINED]) for i in range(0, len(part), JOINED)]
            ids = np.concatenate([np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(part) or starts[0]:  # a tokenizer of another kind
                found += self._encoded([" " + c for c in part])
                continue
            raw, bounds = ids.tobytes(), (4 * starts).tolist()
            found += [raw[a:b] for a, b in zip(bounds, [*bounds[1:], len(raw)])]
        return found

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk after a space."""
        get = self.kept.get
        known = [get(c) for c in chunks]
        new = [i for i, ids in enumerate(known) if ids is None]
        for i, ids in zip(new, self._after_space([chunks[i] for i in new])):
            known[i] = ids
            if len(self.kept) < KEPT_CHUNKS:
                self.kept[chunks[i]] = ids
        return known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and the offsets of the texts.

        A null text is empty.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, ODD)
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        parts = split.values.dictionary_encode()
        codes = parts.indices.to_numpy().copy()
        chunks = parts.dictionary.to_pylist()
        # the first part of a text follows no space; an odd text is one first part
        firsts = pc.if_else(odd, texts, split.values.take(pa.array(bounds[:-1]))).to_pylist()
        codes[bounds[:-1]] = len(chunks) + np.arange(len(firsts))
        codes = np.insert(codes, bounds[1:], len(chunks) + len(firsts))
        pieces = [*self._chunks(chunks), *self._encoded(firsts), self.end]
        table = np.frombuffer(b"".join(pieces), dtype="<u4")
        # a batch holds far fewer ids than 32 bits count
        sizes = np.fromiter(map(len, pieces), dtype=np.int32, count=len(pieces)) // 4
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        counts = sizes[codes]
        ends = np.cumsum(counts, dtype=np.int32)
        at = np.repeat(starts[codes] - (ends - counts), counts)
        at += np.arange(ends[-1], dtype=np.int32)
        return table[at], np.r_[0, ends[bounds[1:] + np.arange(len(firsts))].astype(np.int64)]


    def encode_apart(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, without an end id, as little-endian 32-bit numbers."""
        ids, ends = self.encode(texts)
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a : 4 * (b - 1)] for a, b in zip(ends[:-1], ends[1:])]


_encoders: dict[tuple[int, int], Encoder] = {}


def share(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file (a vocabulary of fixed size) as text, sent to each executor once."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encoder(spec: Broadcast, end: int) -> Encoder:
    """The encoder of this Python worker."""
    key = (hash(spec.value), end)
    if key not in _encoders:
        _encoders[key] = Encoder(spec.value, end)
    return _encoders[key]


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most BATCH_BYTES of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + BATCH_BYTES, side="right")))
        yield at, stop
        at = stop
