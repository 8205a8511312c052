"""SimHash near-duplicates, candidates filtered by chains of segments.

The 64 bits of a fingerprint are cut into a ring of 8 segments. If two
fingerprints differ in at most T bits, some segment starts a chain in which the
first l segments together differ in at most l*T/8 bits, for every l (the
pigeonring principle). For T = 3 such a chain begins with two equal segments and
has at most one differing bit in its first five. So at least two of its third to
fifth segments are equal as well: each fingerprint is indexed under 8 starts and
3 choices of those two, 32 equal bits per key. Inside a key the remaining
budgets prune the pairs before the full distance is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.frames import in_tasks, numbered, position, take
from clickloom.llm.graph import components, settle
from clickloom.session import stage

SEGMENTS, BITS = 8, 8
SEED = 42
BLOCK = 4096  # fingerprints of one key that meet in one task; more are dealt to pairs of blocks
HASHES = 1 << 16  # shingle hashes unpacked at once


def fingerprint(text: str | None, size: int) -> int:
    """SimHash of the word shingles, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    if len(words) < size:
        grams: Iterator[bytes] = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(size)]))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), HASHES):
        part = hashes[at : at + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_hash, fp) per row, fp as a signed long."""
    schema = "doc_id long, text_hash long, fp long"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), size) for x in batch.column(2)]
            column = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], column], ["doc_id", "text_hash", "fp"])

    rows = take(docs, {"doc_id": "doc_id", "text": "text"})
    return in_tasks(rows.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text"), hashed, schema)


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, (i % SEGMENTS) * BITS).bitwiseAND(F.lit(255).cast("long"))


def index_keys(fp: Column, distance: int) -> Column:
    """The index keys of a fingerprint as an array of longs.

    With up to three bits two of the third to fifth segments of a chain are equal
    beside its first two; without any budget, all eight.
    """
    if distance > 3:
        raise ValueError("the index is laid out for at most 3 differing bits")
    keys = []
    for start in range(SEGMENTS):
        for choice, picked in enumerate(((2, 3), (2, 4), (3, 4))):
            parts = [_segment(fp, start + k) for k in (0, 1, *picked)]
            value = sum((F.shiftleft(p, 8 * k) for k, p in enumerate(parts[1:], 1)), parts[0])
            keys.append(value + F.lit((start * 3 + choice) << 32))
    return F.array(*keys)


def _chained(x: np.ndarray, start: np.ndarray, distance: int) -> np.ndarray:
    """Whether differing bits keep every budget of the chain, the whole ring last."""
    shift = (start * np.uint64(BITS)).astype(np.uint64)
    ring = (x >> shift) | np.where(shift == 0, np.uint64(0), x << ((np.uint64(64) - shift) % np.uint64(64)))
    good = np.ones(ring.shape, dtype=bool)
    for length in range(1, SEGMENTS + 1):
        mask = np.uint64((1 << (length * BITS)) - 1)
        good &= np.bitwise_count(ring & mask) <= length * distance // SEGMENTS
    return good


def _linked(fp: np.ndarray, start: np.ndarray, side: np.ndarray, group: np.ndarray, labels: np.ndarray, distance: int) -> np.ndarray:
    """Labels of the rows after linking rows of the same group (rows sorted by it)."""
    bounds = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    sizes = np.diff(bounds)
    small = np.repeat(sizes <= 32, sizes)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for step in range(1, min(32, int(sizes.max(initial=1)))):
        at = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        if len(at):
            good = _chained(fp[at] ^ fp[at + step], start[at], distance)
            found.append((at[good], at[good] + step))
    if found:
        labels = settle(labels, np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found]))
    for g in np.flatnonzero(sizes > 32):
        lo, hi = bounds[g], bounds[g + 1]
        rows = np.arange(lo, hi)
        # of two blocks only the pairs across, else all
        ends = [(rows, rows)] if side[lo] == side[hi - 1] else [(rows[side[lo:hi] == side[lo]], rows[side[lo:hi] != side[lo]])]
        for left, right in ends:
            for at in range(0, len(left), 128):
                part = left[at : at + 128]
                near = _chained(fp[part][:, None] ^ fp[right][None, :], start[part][:, None], distance)
                i, j = np.nonzero(near)
                labels = settle(labels, part[i], right[j])
    return labels


def links(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the distance.

    ``fps`` holds distinct fingerprints. Of the pairs that meet under a key, a
    task only returns what ties its members together, never the pairs.
    """
    keys = fps.select("fp", F.explode(index_keys(F.col("fp"), distance)).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (
        keys.join(shared, "key")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "fp")
    )

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key, lo, hi, own, fp = (c.to_numpy() for c in table.columns)
            new = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            group = np.r_[0, np.cumsum(new)]
            values, node = np.unique(fp.astype(np.int64).view(np.uint64), return_inverse=True)
            start = ((key >> 32) // 3).astype(np.uint64)
            labels = _linked(values[node], start, own, group, np.arange(len(fp)), distance)
            # rows of one fingerprint are one node: tie them, too, before writing
            first = np.full(len(values), len(fp))
            np.minimum.at(first, node, np.arange(len(fp)))
            labels = settle(labels, np.arange(len(fp)), first[node])
            a, b = values[node], values[node[labels]]
            tied = np.unique(np.stack([a, b], axis=1)[a != b], axis=0).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(tied[:, 0]), pa.array(tied[:, 1])], ["a", "b"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 100_000:
                table = pa.Table.from_batches(held).combine_chunks()
                key, lo, hi = (table.column(i).to_numpy() for i in range(3))
                last = (key == key[-1]) & (lo == lo[-1]) & (hi == hi[-1])
                cut = int(np.argmax(last))  # the last group may go on in the next batch
                if cut:
                    yield from flush(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows -= cut
        if rows:
            yield from flush(pa.Table.from_batches(held).combine_chunks())

    sorted_keys = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "own")
    return in_tasks(sorted_keys, tie, "a long, b long")


def _with_components(docs: DataFrame, size: int, distance: int) -> DataFrame:
    held = stage(fingerprints(docs, size), "fingerprints")
    firsts = stage(held.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(firsts.select("fp"), distance))
    tree = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = tree.groupBy("root").agg(F.min("first").alias("component_id"))
    return held.join(tree.join(lowest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text).

    Fingerprints are linked at ``distance`` or fewer differing bits; component_id
    is the smallest doc_id reachable over links, null when no row of the component
    has an id. A null or wordless text has fingerprint zero and links like any
    other; fewer words than ``size`` are one shingle. Repeated rows give repeated
    rows, equal texts one fingerprint. Other columns are ignored, an empty table
    gives no rows.
    """
    fingerprint_hex = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return _with_components(docs, size, distance).select("doc_id", fingerprint_hex, "component_id")


def keep_one(docs: DataFrame, size: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component its smallest doc_id.

    All columns of ``docs`` come back. Of rows that share the smallest doc_id, or of a
    component without any, the one whose text has the smallest hash is kept, once.
    """
    names = ["_id", "_null", "_hash"]
    doc_id, text = f"_{position(docs, 'doc_id')}", f"_{position(docs, 'text')}"

    def key(doc_id: str, text_hash: Column) -> list[Column]:
        known = F.col(doc_id).cast("long")
        return [F.coalesce(known, F.lit(0).cast("long")).alias("_id"), known.isNull().alias("_null"), text_hash.alias("_hash")]

    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    kept = _with_components(docs, size, distance).groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    rows = numbered(docs).select("*", *key(doc_id, F.xxhash64(text)))
    found = rows.join(kept.select(*key("doc_id", F.col("text_hash"))).distinct(), names)
    return found.dropDuplicates(names).drop(*names).toDF(*docs.columns)
