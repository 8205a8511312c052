"""Records of text files that are cut into many tasks, whatever line breaks and brackets they hold.

A task reads a split of a file, which may begin amid a record: inside a quoted CSV value
with line breaks, or deep in a JSON array. Whether it does depends on all that stands
before, but only through a small state: inside quotes or not, and the depth of brackets.
So a first pass turns every split into a function of its first state, for both states
of the quotes; the functions are chained file by file, one row per split; and a second
pass starts each split in its true state. Records within a split are put together by
its task, and only the pieces at its two ends meet those of the neighbouring splits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.session import send_package, stage

HEAD_BYTES = 1 << 16  # read at once from the beginning of a file
HEAD_READERS = 16  # files whose beginnings are read at a time


@dataclass(frozen=True)
class File:
    path: str
    number: int  # a hash of the path, as tasks see it


def list_files(spark: SparkSession, path: str) -> list[File]:
    """The files that Spark finds below ``path``; nothing of them is read."""
    found = spark.read.format("binaryFile").load(path).select("path", F.xxhash64("_metadata.file_path").alias("number"))
    listed = sorted((File(row["path"], row["number"]) for row in found.collect()), key=lambda f: f.path)
    if len({f.number for f in listed}) < len(listed):
        raise ValueError(f"two files below {path} have one hash: read them apart")
    return listed


def read_heads(spark: SparkSession, files: list[File], found: Callable[[str, bool], str | None]) -> list[str | None]:
    """What ``found`` finds at the beginning of each file, reading no more of it than that takes.

    ``found`` gets the first characters and whether they are all there are; None asks for
    more. Like the list of files itself, this is work of the driver: one small read a file.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(file: File) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(file.path)
        size = HEAD_BYTES
        while True:
            stream = path.getFileSystem(conf).open(path)
            codec = codecs.getCodec(path)
            if codec is not None:
                stream = codec.createInputStream(stream)
            try:
                raw = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)))
            finally:
                stream.close()
            whole = len(raw) < size
            text = found(raw.decode("utf-8", "ignore").lstrip("﻿"), whole)
            if text is not None or whole:
                return text
            size *= 16

    with ThreadPoolExecutor(max_workers=HEAD_READERS) as pool:
        return list(pool.map(head, files))


class Csv:
    """Lines; a record ends with a line that ends outside quotes."""

    separator = "\n"
    level = 0  # depth at which records end
    # a field in quotes ends at a quote that no other follows; what follows up to the comma belongs to it
    _INSIDE = '(?:[^"]|"")*'
    _FIELD = f'(?:"{_INSIDE}"(?:[^",][^,]*)?|[^",][^,]*|)'
    _OPENS = f'(?:{_FIELD},)*"{_INSIDE}'
    from_outside = f"(?s)^{_OPENS}$"
    from_inside = f'(?s)^{_INSIDE}(?:"(?:[^",][^,]*)?,{_OPENS})?$'

    def functions(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per line whether it ends inside quotes if it begins outside and inside, and the change of depth."""
        quoted = np.flatnonzero(pc.match_substring(texts, '"').to_numpy(zero_copy_only=False))
        outside, inside = np.zeros(len(texts), dtype=bool), np.ones(len(texts), dtype=bool)
        if len(quoted):
            some = texts.take(pa.array(quoted))
            outside[quoted] = pc.match_substring_regex(some, self.from_outside).to_numpy(zero_copy_only=False)
            inside[quoted] = pc.match_substring_regex(some, self.from_inside).to_numpy(zero_copy_only=False)
        depth = np.zeros(len(texts), dtype=np.int64)
        return outside, inside, depth, depth

    def record(self, texts: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(texts, "\r$", "")


class JsonArray:
    """Pieces between closing braces; a record ends with one that leaves only the array open."""

    separator = "}"
    level = 1

    def functions(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        plain = pc.replace_substring_regex(texts, r"(?s)\\.", "")  # no escapes
        odd = pc.count_substring(plain, '"').to_numpy() % 2 == 1
        changes = []
        for start, ends_inside in ((plain, odd), (pc.binary_join_element_wise('"', plain, ""), ~odd)):
            bare = pc.replace_substring_regex(start, r'(?s)"[^"]*(?:"|$)', "")  # no strings
            opened = pc.count_substring(bare, "{").to_numpy() + pc.count_substring(bare, "[").to_numpy()
            changes.append(opened - pc.count_substring(bare, "]").to_numpy() - ~ends_inside)
        return odd, ~odd, changes[0].astype(np.int64), changes[1].astype(np.int64)

    def record(self, texts: pa.Array) -> pa.Array:
        bare = pc.replace_substring_regex(texts, "^[\\s,\\[﻿]*", "")
        return pc.binary_join_element_wise(bare, pa.scalar("}", bare.type), "")


def _states(outside: np.ndarray, inside: np.ndarray, start: bool) -> np.ndarray:
    """Whether each piece ends inside quotes, the first one beginning in the state ``start``."""
    at = np.arange(len(outside))
    fixed = np.maximum.accumulate(np.where(outside == inside, at, -1))  # the last piece that ends alike from either state
    turns = np.cumsum(outside & ~inside)
    known = np.where(fixed >= 0, outside[fixed], start)
    since = turns - np.where(fixed >= 0, turns[fixed], 0)
    return known ^ (since % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The rows of a batch (file, start, value), split by split."""
    file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = np.flatnonzero(np.r_[True, (file[1:] != file[:-1]) | (start[1:] != start[:-1]), True])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi > lo:
            yield (int(file[lo]), int(start[lo])), batch.column(2).slice(lo, hi - lo)


@dataclass(frozen=True)
class Split:
    """How a split begins: inside quotes, at which depth, and whether with a new record."""

    inside: bool
    depth: int
    fresh: bool


class RecordFiles:
    """Files of one grammar. Both passes see the same splits, as the session they are read
    with keeps the settings that the size of splits depends on."""

    def __init__(self, spark: SparkSession, files: list[File], grammar: Csv | JsonArray):
        self.spark, self.files, self.grammar = spark, files, grammar
        send_package(spark)
        reader = _steady(spark).read.option("lineSep", grammar.separator)
        self.pieces = reader.text([f.path for f in files]).select(
            F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
        )

    def summaries(self) -> list[dict]:
        """Per split its last state and change of depth from either first state, and whether any piece ends inside quotes."""
        grammar = self.grammar

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, state = None, None

            def row() -> pa.RecordBatch:
                values = [*split, *(v for s in state for v in s)]
                return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], [c.split()[0] for c in schema.split(", ")])

            for batch in batches:
                for key, texts in _runs(batch):
                    if key != split:
                        if split is not None:
                            yield row()
                        split, state = key, [[False, 0, False], [True, 0, False]]
                    outside, inside, depth_out, depth_in = grammar.functions(texts)
                    for held in state:
                        after = _states(outside, inside, held[0])
                        before = np.r_[held[0], after[:-1]]
                        held[1] += int(np.where(before, depth_in, depth_out).sum())
                        held[0], held[2] = bool(after[-1]), held[2] or bool(after.any())
            if split is not None:
                yield row()

        schema = "file long, start long, end0 boolean, depth0 long, any0 boolean, end1 boolean, depth1 long, any1 boolean"
        found = self.pieces.mapInArrow(summed, schema).collect()  # a row per split, as the driver plans them anyway
        return sorted((row.asDict() for row in found), key=lambda r: (r["file"], r["start"]))

    def splits(self, summaries: list[dict]) -> tuple[dict[tuple[int, int], Split], set[int]]:
        """How every split begins, and the files with a piece that ends inside quotes."""
        begins: dict[tuple[int, int], Split] = {}
        broken: set[int] = set()
        file, inside, depth = None, False, 0
        for row in summaries:
            if row["file"] != file:
                file, inside, depth = row["file"], False, 0
                fresh = True
            else:
                fresh = not inside and depth == self.grammar.level
            begins[file, row["start"]] = Split(inside, depth, fresh)
            taken = int(inside)
            if row[f"any{taken}"]:
                broken.add(file)
            inside, depth = row[f"end{taken}"], depth + row[f"depth{taken}"]
        return begins, broken

    def records(self, begins: dict[tuple[int, int], Split]) -> DataFrame:
        """(record, first): all records, and whether one is the first of its file that is not blank."""
        whole = self._pass(begins, fragments=False)
        pieces = stage(self._pass(begins, fragments=True), "record-pieces")
        by_file = Window.partitionBy("file").orderBy("start", "place")  # two rows per split at most
        group = F.sum(F.when(F.col("place") == 1, 1).otherwise(0)).over(by_file.rowsBetween(Window.unboundedPreceding, 0))
        parts = F.array_sort(F.collect_list(F.struct("start", "place", "text")))
        joined = pieces.withColumn("group", group).groupBy("file", "group").agg(
            F.array_join(F.transform(parts, lambda p: p["text"]), self.grammar.separator).alias("record"), F.max("closes").alias("closed")
        )
        if isinstance(self.grammar, JsonArray):  # the last piece closes the array, not a record
            tidy = F.concat(F.regexp_replace("record", "^[\\s,\\[﻿]*", ""), F.lit("}"))
            joined = joined.filter("closed").withColumn("record", tidy)
        else:
            joined = joined.withColumn("record", F.regexp_replace("record", "\r$", ""))
        return whole.select("record", "first").unionByName(joined.select("record", F.lit(False).alias("first")))

    def _pass(self, begins: dict[tuple[int, int], Split], fragments: bool) -> DataFrame:
        """The records within splits, or else what their first and last record have in them."""
        grammar = self.grammar

        def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, inside, depth, waiting, lead, due = None, False, 0, [], False, False

            def piece(place: int, closes: bool) -> pa.RecordBatch:
                text = grammar.separator.join(waiting)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
                values = (*split, place, closes, text)
                return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["file", "start", "place", "closes", "text"])

            for batch in batches:
                for key, texts in _runs(batch):
                    if key != split:
                        if fragments and waiting:
                            yield piece(0 if lead else 1, False)
                        if key not in begins:
                            raise RuntimeError("the files or their splits changed between two passes: read them again")
                        begin = begins[key]
                        split, inside, depth, waiting, lead, due = key, begin.inside, begin.depth, [], not begin.fresh, key[1] == 0
                    outside, within, depth_out, depth_in = grammar.functions(texts)
                    after = _states(outside, within, inside)
                    before = np.r_[inside, after[:-1]]
                    depths = depth + np.cumsum(np.where(before, depth_in, depth_out))
                    ends = ~after & (depths == grammar.level)
                    inside, depth = bool(after[-1]), int(depths[-1])
                    closed = np.r_[not waiting and not lead, ends[:-1]]
                    single = closed & ends
                    several: list[tuple[int, str]] = []
                    for i in np.flatnonzero(~single):
                        waiting.append(texts[i].as_py())
                        if ends[i]:
                            if lead and fragments:
                                yield piece(0, True)
                            elif not lead:
                                several.append((int(i), grammar.separator.join(waiting)))
                            waiting, lead = [], False
                    if fragments:
                        continue
                    places = np.r_[np.flatnonzero(single), [i for i, _ in several]].astype(np.int64)
                    joined = pa.array([text for _, text in several], texts.type)
                    found = grammar.record(pa.concat_arrays([texts.filter(pa.array(single)), joined]))
                    order = pa.array(np.argsort(places, kind="stable"))
                    found = found.take(order)
                    filled = pc.not_equal(pc.utf8_trim_whitespace(found), "")
                    found = found.filter(filled)
                    first = np.zeros(len(found), dtype=bool)
                    if due and len(found):
                        first[0], due = True, False
                    yield pa.RecordBatch.from_arrays([found.cast(pa.string()), pa.array(first)], ["record", "first"])
            if fragments and waiting:
                yield piece(0 if lead else 1, False)

        schema = "file long, start long, place int, closes boolean, text string" if fragments else "record string, first boolean"
        return self.pieces.mapInArrow(walked, schema)


_sessions: dict[str, SparkSession] = {}


def _steady(spark: SparkSession) -> SparkSession:
    """A session whose splits do not depend on how many executors there are just now."""
    application = spark.sparkContext.applicationId
    if application not in _sessions:
        own = spark.newSession()
        own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
        _sessions[application] = own
    own = _sessions[application]
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, spark.conf.get(name))
    return own


def first_csv_record(text: str, whole: bool) -> str | None:
    """The first record that is not blank; None if the text ends before it does, "" if there is none."""
    lines = text.split("\n")
    if not whole:
        lines.pop()  # may go on
    held: list[str] = []
    for line in lines:
        if not held and not line.strip():
            continue
        held.append(line)
        record = "\n".join(held)
        if not re.match(Csv.from_outside.replace("(?s)", "", 1), record, re.DOTALL):
            return record.rstrip("\r")
    return "\n".join(held) if whole else None


def first_mark(text: str, whole: bool) -> str | None:
    """The first character that is not blank; None if there is none yet."""
    return text.strip()[:1] or ("" if whole else None)
