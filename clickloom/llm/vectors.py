"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors are turned onto their principal axes, so the leading coordinates spread
most. A grid with cells as wide as the largest distance of a link is laid over the
leading coordinates, and vectors are sorted by cell, coordinate after coordinate.
Runs of the sorted sequence become blocks with bounding boxes. Two intervals of the
sequence are joined recursively: if their boxes are further apart than a link allows,
all of it is skipped; else both are divided, until they are small and are compared.
The first levels of the recursion are joins of boxes, from groups of partitions down to
blocks; the rest runs inside tasks. A task gets the blocks of two groups, a tile, and
joins the pairs of them that are near, so a block is sent once per tile and not per pair.
A leaf compares the leading coordinates first: what the others can add is bounded by
their lengths, and only pairs that this leaves open are multiplied out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.frames import in_tasks, take
from clickloom.llm.graph import components, settle
from clickloom.session import stage

GRID_AXES = 4  # coordinates whose cells order the sequence
BOX_AXES = 16  # coordinates of the bounding boxes
BLOCK_ROWS = 1024
GROUP = 8  # neighbouring blocks that a tile takes together
FANOUT = 32  # groups, and groups of those, that are first compared as one
PLACES = 24  # bits for the blocks of a partition
LEAF = 256
TASK_TILES = 2  # tiles a task joins
SLACK = 1e-6  # boxes are rounded; no link may be lost by that
TIE = 1e-9  # cosines so close to the bound are computed from the given vectors


def classes(vectors: DataFrame) -> DataFrame:
    """(class_id, label, vector, members, first) of equal vectors that can link, written.

    class_id is a number of its own, since ids of rows may repeat; first is the smallest.

    Leaves out rows without an id, label or vector, and vectors that are empty, zero or
    hold null or non-finite numbers.
    """
    rows = take(vectors, {"vec_id": "vec_id", "vector": "embedding", "label": "label"}).select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("vector").cast("array<double>")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.filter("vec_id is not null and label is not null and vector is not null").filter(
        finite & F.exists("vector", lambda x: x != 0)
    )
    grouped = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("members"))
    label = F.concat_ws("/", F.size("vector"), "label").alias("label")
    numbers = F.monotonically_increasing_id().alias("class_id")
    return stage(grouped.select(numbers, label, "vector", "members", "first"), "vector-classes")


def _given(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows, padded with zeros to the width."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    rows = np.zeros((len(column), width))
    rows[np.arange(width)[None, :] < sizes[:, None]] = values
    return rows


def _units(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Unit rows, padded with zeros to the width."""
    return _units(_given(column, width))


def principal_axes(known: DataFrame, width: int) -> np.ndarray:
    """Columns are the axes, the widest first; only width x width sums reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["at", "value"])

    parts = in_tasks(known.select("vector"), sums, "at long, value double")
    moments = np.zeros(width * width)
    for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        moments[row["at"]] = row["value"]
    _, axes = np.linalg.eigh(moments.reshape(width, width))
    return np.ascontiguousarray(axes[:, ::-1])


def blocks(known: DataFrame, width: int, axes: Broadcast, reach: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Runs of the epsilon grid order, written: place, label, low, high, ids, members, rows (packed doubles).

    ``place`` numbers the blocks in the order of the sequence, the partition in its upper bits.
    """
    n_box = min(BOX_AXES, width)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = (_matrix(batch.column(2), width) @ axes.value)[:, :n_box]
            cells = np.floor(lead[:, :GRID_AXES] / reach).astype(np.int32)
            packed = pa.array([r.tobytes() for r in _given(batch.column(2), width)], pa.binary())
            leading = pa.array([r.tobytes() for r in np.ascontiguousarray(lead)], pa.binary())
            grid = pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), cells.shape[1]).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), grid, packed, leading], ["class_id", "label", "members", "cells", "row", "lead"]
            )

    ordered = in_tasks(
        known.select("class_id", "label", "vector", "members"), placed,
        "class_id long, label string, members long, cells array<int>, row binary, lead binary",
    )
    # rows of one cell are told apart by their id, so no cell has to fit into a task
    run = ordered.repartitionByRange("label", "cells", "class_id").sortWithinPartitions("label", "cells", "class_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << PLACES

        def block() -> pa.RecordBatch:
            matrix = np.frombuffer(b"".join(leads)).reshape(-1, n_box)
            one = {
                "place": place, "label": label, "low": matrix.min(axis=0).tolist(), "high": matrix.max(axis=0).tolist(),
                "ids": ids, "members": members, "rows": b"".join(rows),
            }
            return pa.RecordBatch.from_pylist([one], schema=schema)

        schema = pa.schema([
            ("place", pa.int64()), ("label", pa.string()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
            ("ids", pa.list_(pa.int64())), ("members", pa.list_(pa.int64())), ("rows", pa.binary()),
        ])
        label, ids, members, rows, leads = None, [], [], [], []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("class_id", "label", "members", "row", "lead"))
            for i, of, n, row, lead in zip(*columns):
                if ids and (of != label or len(ids) == block_rows):
                    yield block()
                    place += 1
                    ids, members, rows, leads = [], [], [], []
                label = of
                ids.append(i)
                members.append(n)
                rows.append(row)
                leads.append(lead)
        if ids:
            yield block()

    made = "place long, label string, low array<double>, high array<double>, ids array<long>, members array<long>, rows binary"
    return stage(in_tasks(run, cut, made), "vector-blocks")


def _near(a: str, b: str, reach: float) -> Column:
    """Whether boxes a and b are no further apart than the reach."""
    gap = lambda lo, hi: F.greatest(lo - hi, F.lit(0.0))
    one = F.zip_with(f"{a}_low", f"{b}_high", gap)
    other = F.zip_with(f"{b}_low", f"{a}_high", gap)
    squares = F.zip_with(one, other, lambda x, y: x * x + y * y)
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x) <= (reach + SLACK) ** 2


def block_pairs(cut: DataFrame, width: int, reach: float) -> DataFrame:
    """(x, y, x_group, y_group): places x <= y of blocks of one label whose boxes are near, and their groups.

    Boxes of groups are joined level by level, children of near ones only; every join is
    on the label and a group of at most FANOUT.
    """
    n_box = min(BOX_AXES, width)
    boxes = stage(cut.select("label", "low", "high", F.col("place").alias("id")), "vector-boxes")
    partitions = F.shiftright("id", PLACES)
    last = boxes.agg(F.max(partitions)).first()[0] or 0
    # the group that each block belongs to, level by level: in its partition, the partition, and groups of partitions
    in_partition = F.col("id").bitwiseAND(F.lit((1 << PLACES) - 1))
    ids = [F.col("id"), F.shiftleft(partitions, PLACES) + F.floor(in_partition / GROUP), partitions]
    size = 1
    while size <= last:
        size *= FANOUT
        ids.append(F.floor(partitions / size))
    sides = lambda f, c: F.array(*[f(F.get(c, F.lit(i))) for i in range(n_box)])

    def level(k: int) -> DataFrame:
        parent = (ids[k + 1] if k + 1 < len(ids) else F.lit(0)).cast("long").alias("parent")
        rows = boxes.select("label", ids[k].cast("long").alias("id"), parent, "low", "high")
        return rows if k == 0 else rows.groupBy("label", "parent", "id").agg(sides(F.min, "low").alias("low"), sides(F.max, "high").alias("high"))

    def named(df: DataFrame, a: str) -> DataFrame:
        return df.select("label", *[F.col(c).alias(f"{a}_{c}") for c in ("parent", "id", "low", "high")])

    # one group of all partitions on top
    pairs = boxes.select("label").distinct().select("label", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    for k in reversed(range(len(ids))):
        children = level(k)
        parents = pairs.select("label", F.col("x").alias("a_parent"), F.col("y").alias("b_parent"))
        joined = parents.join(named(children, "a"), ["label", "a_parent"]).join(named(children, "b"), ["label", "b_parent"])
        near = joined.filter("a_id <= b_id").filter(_near("a", "b", reach))
        pairs = near.select("label", F.col("a_id").alias("x"), F.col("b_id").alias("y"), F.col("a_parent").alias("x_group"), F.col("b_parent").alias("y_group"))
    return pairs.drop("label")


def _boxes_near(a: np.ndarray, b: np.ndarray, reach: float) -> bool:
    gap = np.maximum(np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)), 0.0)
    return float(gap @ gap) <= (reach + SLACK) ** 2


def _linked(a: np.ndarray, b: np.ndarray, least: float, exact: Callable[[int, int], float] | None) -> np.ndarray:
    """Which rows have at least that cosine; ``exact`` decides those that are as good as equal to it."""
    lead = min(BOX_AXES, a.shape[1])
    cosines = a[:, :lead] @ b[:, :lead].T
    if lead < a.shape[1]:
        rest = np.linalg.norm(a[:, lead:], axis=1)[:, None] * np.linalg.norm(b[:, lead:], axis=1)[None, :]
        i, j = np.nonzero(cosines + rest >= least - TIE)
        found = np.full(cosines.shape, -1.0)
        if len(i) * 8 > cosines.size:
            found = a @ b.T
        elif len(i):
            found[i, j] = cosines[i, j] + np.einsum("ij,ij->i", a[i, lead:], b[j, lead:])
        cosines = found
    linked = cosines >= least
    if exact is not None:
        for i, j in zip(*np.nonzero(np.abs(cosines - least) <= TIE)):
            linked[i, j] = exact(int(i), int(j)) >= least
    return linked


def join_intervals(
    a: np.ndarray, b: np.ndarray, same: bool, least: float, reach: float, leaf: int = LEAF,
    exact: Callable[[int, int], float] | None = None,
) -> Iterator[tuple[int, int, np.ndarray]]:
    """Leaves (offset in a, offset in b, linked?) of the recursive join of two intervals.

    With ``same``, b is a: each pair of its sub-intervals once, a vector not with itself.
    """
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if not _boxes_near(a[a0:a1, :BOX_AXES], b[b0:b1, :BOX_AXES], reach):
            continue
        if a1 - a0 > leaf or b1 - b0 > leaf:
            am, bm = (a0 + a1) // 2, (b0 + b1) // 2
            lefts = [(a0, am), (am, a1)] if a1 - a0 > leaf else [(a0, a1)]
            rights = [(b0, bm), (bm, b1)] if b1 - b0 > leaf else [(b0, b1)]
            todo += [(*x, *y) for x in lefts for y in rights if not same or x[0] <= y[0]]
            continue
        at = None if exact is None else lambda i, j, a0=a0, b0=b0: exact(a0 + i, b0 + j)
        linked = _linked(a[a0:a1], b[b0:b1], least, at)
        if same and a0 == b0:
            linked &= np.triu(np.ones(linked.shape, dtype=bool), 1)
        if linked.any():
            yield a0, b0, linked


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine of two vectors as given, summed from their first number to the last."""
    if max(np.abs(a).max(), np.abs(b).max()) > 1e150 or min(np.abs(a).max(), np.abs(b).max()) < 1e-150:
        a, b = a / np.abs(a).max(), b / np.abs(b).max()  # the squares would leave the range
    dot = aa = bb = 0.0
    for x, y in zip(a.tolist(), b.tolist()):
        dot += x * y
        aa += x * x
        bb += y * y
    return dot / (math.sqrt(aa) * math.sqrt(bb))


def linked_pairs(
    cut: DataFrame, pairs: DataFrame, width: int, axes: Broadcast, least: float, reach: float, leaf: int = LEAF
) -> DataFrame:
    """Per tile and vector with links: id, n_links there, root it is tied to."""
    schema = "id long, n_links long, root long"
    names = ["id", "n_links", "root"]

    def tile(rows: list[dict]) -> pa.RecordBatch:
        given = {r["place"]: np.frombuffer(r["rows"]).reshape(-1, width) for r in rows}
        turned = {place: _units(matrix) @ axes.value for place, matrix in given.items()}
        starts = dict(zip(given, np.cumsum([0, *map(len, given.values())]).tolist()))
        ids = np.concatenate([np.array(r["ids"]) for r in rows])
        members = np.concatenate([np.array(r["members"]) for r in rows])
        counts = np.zeros(len(ids), dtype=np.int64)
        labels = np.arange(len(ids))
        for x, y in ((r["place"], y) for r in rows for y in r["partners"]):
            def exact(i: int, j: int) -> float:
                return cosine(given[x][i], given[y][j])

            for a0, b0, linked in join_intervals(turned[x], turned[y], x == y, least, reach, leaf, exact):
                i, j = np.nonzero(linked)
                i, j = i + a0 + starts[x], j + b0 + starts[y]
                np.add.at(counts, i, members[j])
                np.add.at(counts, j, members[i])
                labels = settle(labels, i, j)
        hit = counts > 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[hit], counts[hit], ids[labels[hit]])], names)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["x_group"], row["y_group"]) != of:
                    yield tile(held)
                    held = []
                of = row["x_group"], row["y_group"]
                held.append(row)
        if held:
            yield tile(held)

    groups = ["x_group", "y_group"]
    as_first = pairs.select(*groups, F.col("x").alias("place"), F.col("y").alias("partner"))
    as_second = pairs.select(*groups, F.col("y").alias("place"), F.lit(None).cast("long").alias("partner"))
    # at most GROUP partners for each block of a tile
    wanted = as_first.union(as_second).groupBy(*groups, "place").agg(F.sort_array(F.collect_set("partner")).alias("partners"))
    wide = wanted.join(cut.select("place", "ids", "members", "rows"), "place")
    # a tile is some MB, so a task must not get many in one batch
    tasks = -(-pairs.select(*groups).distinct().count() // TASK_TILES) or 1
    return in_tasks(wide.repartition(tasks, *groups).sortWithinPartitions(*groups, "place"), joined, schema)


def near_duplicates(
    vectors: DataFrame, least: float = 0.93, block_rows: int = BLOCK_ROWS, leaf: int = LEAF
) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, embedding, label).

    Rows link when their labels are equal and the cosine in double precision is at
    least ``least``. Rows without a label, and vectors that are null, empty, zero or
    hold null or non-finite numbers, link with nothing, nor do vectors of different
    length. n_links counts the other rows linked directly, component_id is the smallest
    vec_id reachable. Rows that repeat a vec_id are rows like others, and link if their
    vectors do. A row without a vec_id links with nothing and is kept. Other columns are ignored, an empty table gives no rows.
    """
    spark: SparkSession = vectors.sparkSession
    known = classes(vectors)
    width = known.agg(F.coalesce(F.max(F.size("vector")), F.lit(1))).first()[0]
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) or 1e-9
    axes = spark.sparkContext.broadcast(principal_axes(known, width))
    cut = blocks(known, width, axes, reach, block_rows)
    pairs = stage(block_pairs(cut, width, reach), "vector-pairs")
    found = stage(linked_pairs(cut, pairs, width, axes, least, reach, leaf), "vector-links")
    links = found.groupBy("id").agg(F.sum("n_links").alias("n"))
    roots = components(found.select("id", "root"), "id", "root")
    tied = (
        known.join(links, F.col("class_id") == F.col("id"), "left")
        .join(roots, F.col("class_id") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "class_id"))
    )
    lowest = tied.groupBy("root").agg(F.min("first").alias("component"))
    named = tied.join(lowest, "root").select("label", "vector", "members", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "component")
    rows = take(vectors, {"vec_id": "vec_id", "vector": "embedding", "of": "label"}).select(
        F.col("vec_id").cast("long"), F.col("vector").cast("array<double>"), F.col("of").cast("string")
    )
    key = F.when(F.col("vec_id").isNotNull(), F.concat_ws("/", F.size("vector"), "of"))
    joined = rows.withColumn("label", F.when(F.col("of").isNotNull(), key)).join(named, ["label", "vector"], "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id", F.coalesce(F.col("n") + F.col("members") - 1, F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
