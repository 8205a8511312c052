"""Spelling variants: words one edit apart, by dense tiles of prefixes and suffixes.

Two different words are one inserted, deleted or replaced code point apart if and only
if their lengths differ by at most one and their common prefix and common suffix
together reach the longer length minus one. Words are held in matrices of code points,
padded at the end for prefixes and at the front for suffixes, and blocks of rows are
compared pair by pair of blocks.

Which blocks meet follows from the same sum. Of a pair with the longer length M either
the prefix or the suffix reaches half of M - 1, so words meet in groups of an equal
prefix and in groups of an equal suffix. A group that is still large is divided again:
what lies between its prefix and suffix holds the edit, and half of that is again equal
in front or behind. Each pair belongs to exactly one group: it goes with the prefix if
its own is long enough, else with the suffix. A group that cannot be divided differs in
one place only, so it is no larger than the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.frames import in_tasks, take
from clickloom.session import stage

GROUP = 1024  # larger groups are divided
TILE = 128  # rows of a block
RUN_ROWS = 50_000  # rows a task compares at a time
KEPT_WORDS = 500_000  # distinct words a task counts before it hands them on
PAD = "\U0010ffff"  # no character


@dataclass(frozen=True)
class Variants:
    least_chars: int = 7
    least_count: int = 2
    drop: int = 31  # a run whose hash this divides loses a code point
    ratio: int = 10  # a form occurs so many times as often


def word_counts(docs: DataFrame, rule: Variants = Variants()) -> DataFrame:
    """(word, n): the words of all whole texts (doc_id, text) and how often they occur.

    Runs of letters up to U+00FF, A-Z lowered. Tasks count what they read before
    anything is shuffled, so a frequent word is a few rows.
    """
    # the code points up to U+00FF are the bytes of Latin-1; all others become a question mark
    run = re.compile(rb"[a-z\xc0-\xff]{%d,}" % rule.least_chars)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[bytes] = Counter()

        def ready() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in totals]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(totals.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(run.findall((text.as_py() or "").encode("latin-1", "replace").lower()))
                seed = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                    if h % rule.drop == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < rule.least_chars:
                            continue
                    totals[word] += n
            if len(totals) >= KEPT_WORDS:
                yield ready()
                totals.clear()
        if totals:
            yield ready()

    rows = take(docs, {"doc_id": "doc_id", "text": "text"}).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = in_tasks(rows, counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rule.least_count)


KEY = ["size", "front", "back", "cap", "prefix", "suffix"]


def _placed(rows: DataFrame) -> DataFrame:
    """Add what a group shares: the first ``front`` and the last ``back`` code points."""
    return rows.withColumns(
        {"prefix": F.substring("word", F.lit(1), F.col("front")), "suffix": F.right("word", F.col("back"))}
    )


def _groups(words: DataFrame) -> DataFrame:
    """The rows of KEY, word and n, so that pairs one edit apart share exactly one group.

    ``size`` is the longer length of the pairs sought, ``cap`` a bound that their common
    prefix stays below. Each round only goes on with the groups that are too large.
    """
    # a word is the longer of its pairs, or the shorter by one
    sizes = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("size")
    zero = F.lit(0)
    rest = _placed(words.select("word", "n", sizes).withColumns({"front": zero, "back": zero, "cap": F.col("size") + 1}))
    done: list[DataFrame] = []
    while True:
        rest = stage(rest, "variant-groups")
        counts = rest.groupBy(*KEY).agg(F.count("*").alias("rows"))
        large = stage(counts.filter((F.col("rows") > GROUP) & (F.col("size") - F.col("front") - F.col("back") > 1)).select(*KEY), "variant-groups")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rest])
        done.append(rest.join(large, KEY, "left_anti"))
        half = F.ceil((F.col("size") - F.col("front") - F.col("back") - 1) / F.lit(2)).cast("int")

        def child(front: Column, back: Column, cap: Column) -> Column:
            return F.struct(front.alias("front"), back.alias("back"), cap.alias("cap"))

        front, back, cap = F.col("front"), F.col("back"), F.col("cap")
        both = F.array(child(front + half, back, cap), child(front, back + half, F.least(cap, front + half)))
        divided = rest.join(large, KEY, "left_semi").select("word", "n", "size", F.explode(both).alias("c"))
        rest = _placed(divided.select("word", "n", "size", "c.*").filter("front < cap"))


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)


def _near(words: list[str], group: np.ndarray, size: int, front: int, back: int, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of one group that are one edit apart; rows lie in the order of their group."""
    ahead, behind = _codes([w.ljust(size, PAD) for w in words]), _codes([w.rjust(size, PAD) for w in words])
    full = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) == size
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def common(alive: np.ndarray, codes: np.ndarray, left: slice, right: slice, places: range, start: int) -> np.ndarray:
        """How many code points are equal from one end on, ``start`` being known."""
        length = np.full(alive.shape, start, dtype=np.int32)
        for at in places:
            alive = alive & (codes[left, at][:, None] == codes[right, at][None, :])
            if not alive.any():
                break
            length += alive
        return length

    for i in range(0, len(words), TILE):
        left = slice(i, min(i + TILE, len(words)))
        j = i
        while j < len(words) and (j == i or group[j] == group[left.stop - 1]):
            right = slice(j, min(j + TILE, len(words)))
            alive = (group[left][:, None] == group[right][None, :]) & (full[left][:, None] | full[right][None, :])
            if i == j:
                alive = np.triu(alive, 1)
            prefix = common(alive, ahead, left, right, range(front, min(cap, size)), front)
            alive &= prefix < cap
            if alive.any():
                suffix = common(alive, behind, left, right, range(size - 1 - back, -1, -1), back)
                a, b = np.nonzero(alive & (prefix + suffix >= size - 1))
                found.append((a + i, b + j))
            j += TILE
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Per word of the rows, which hold whole groups: its near words, counted, and the best of them."""
    columns = [table.column(name).combine_chunks() for name in KEY]
    changes = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False) for c in columns]
    group = np.r_[0, np.cumsum(np.logical_or.reduce(changes))]
    # within a run only prefix and suffix change
    cuts = np.flatnonzero(np.r_[True, np.logical_or.reduce(changes[:4]), True])
    size, front, back, cap = (c.to_numpy() for c in columns[:4])
    every, counts = table.column("word").to_pylist(), table.column("n").to_numpy()
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        words, n = every[lo:hi], counts[lo:hi]
        a, b = _near(words, group[lo:hi], int(size[lo]), int(front[lo]), int(back[lo]), int(cap[lo]))
        if not len(a):
            continue
        rank = np.empty(hi - lo, dtype=np.int64)
        rank[sorted(range(hi - lo), key=words.__getitem__)] = np.arange(hi - lo)
        word, other = np.r_[a, b], np.r_[b, a]
        order = np.lexsort((rank[other], -n[other], word))
        word, other = word[order], other[order]
        firsts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = other[firsts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in word[firsts]]), pa.array(np.diff(np.r_[firsts, len(word)])), pa.array(n[best]),
                pa.array([words[i] for i in best]),
            ],
            ["word", "n_near", "best_n", "best"],
        )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words.

    Words are distinct and without U+10FFFF. ``best`` is the near word that occurs most
    often, the smallest of equals.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= RUN_ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                same = [pc.equal(table.column(name), table.column(name)[-1]).to_numpy() for name in KEY]
                cut = int(np.argmax(np.logical_and.reduce(same)))  # the last group may go on in the next batch
                if cut:
                    yield from _compared(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows -= cut
        if rows:
            yield from _compared(pa.Table.from_batches(held))

    dealt = _groups(words).select(*KEY, "word", "n").repartition(*KEY).sortWithinPartitions(*KEY)
    found = in_tasks(dealt, compared, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct(-F.col("best_n"), F.col("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.col1")).alias("best_n"), F.col("b.best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words (word, form) that have a form: the last one reached over forms.

    Forms are strictly more frequent, so there are no circles. Every round doubles the
    steps taken.
    """
    known = stage(forms.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("at"), F.col("root").alias("next"))
        known = stage(
            known.join(further, F.col("root") == F.col("at"), "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if known.filter("moved").isEmpty():
            return known.select("word", "root")


def variants(words: DataFrame, rule: Variants = Variants()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n).

    A form is the best near word if it occurs ``ratio`` times as often, else null; the
    root of a word without a form is the word itself.
    """
    held = stage(words.select("word", "n"), "words")
    is_form = F.col("best_n") >= rule.ratio * F.col("n")
    forms = stage(
        held.join(near_words(held), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    joined = forms.join(roots(forms), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(docs: DataFrame, rule: Variants = Variants()) -> DataFrame:
    """The words of all texts with their near words, forms and roots, as ``variants``.

    Null, empty and wordless texts have no words. A row without a doc_id is hashed by
    the word ``null``. Repeated rows count each time. Other columns are ignored, an
    empty table gives no rows.
    """
    return variants(word_counts(docs, rule), rule)
