"""Gradient-boosted trees on Huber loss, grown for several sets of rows in step.

A round takes the residuals' size at a given share as the bound of the loss, fits a
tree to the residuals cut off at that bound, and then sets every leaf to the median of
its residuals plus the mean of what they differ by, again cut off. Bounds and medians
are exact order statistics. All rows carry their prediction along, fitted or not, so
the rows that are held out are scored by the same passes.

The trees are those of Spark's regression tree: features are cut into bins, once for all
rounds and from all rows, and a level of all trees is one aggregation of counts and sums per node, feature
and bin. Tasks sum up what they read and Spark adds the sums, so a round is about ten
passes, however many trees grow. Up to a number of rows the passes are jobs on blocks of
rows that stay cached on the executors, which saves planning a query for each of them.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.models.blocks import BINS, Batch, Grown, among, order_bits
from clickloom.session import ROWS_PER_TASK, send_package, stage

STAGE_ROUNDS = 5  # rounds after which the predictions are written; those between evaluate the newest trees anew
SHARE = 0.9  # of residuals that lie within the bound
VALUES_PER_SLICE = 1_000_000  # values of features that a task puts in order for the bins
HERE_ROWS = 64 * ROWS_PER_TASK  # up to which blocks are cached and the findings of tasks are added on the driver
DENSE_KEYS = 1 << 20  # keys below which sums are added up in an array
LAST_ROWS = 100_000  # values that are sorted at the end of a selection


@dataclass(frozen=True)
class Tree:
    """Nodes in pre-order; a leaf has feature -1 and its value, other nodes their right child."""

    feature: np.ndarray
    threshold: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), dtype=np.int64)
        while (inner := self.feature[at] >= 0).any():
            below = rows[np.arange(len(rows)), np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(below, at + 1, self.right[at]), at)
        return self.value[at]


@dataclass(frozen=True)
class HuberModel:
    """An initial value and trees whose values are added at the learning rate."""

    initial: float
    rate: float
    trees: list[Tree]
    featureImportances: np.ndarray  # named as in Spark's models

    def transform(self, df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
        """Add the prediction of each row's vector, by Arrow batches."""
        send_package(df.sparkSession)

        @F.pandas_udf("double")
        def predicted(rows: pd.Series) -> pd.Series:
            total = np.full(len(rows), self.initial)
            if len(rows):
                matrix = np.stack(rows.to_numpy())
                for tree in self.trees:
                    total += self.rate * tree.predict(matrix)
            return pd.Series(total)

        return df.withColumn(prediction, predicted(vector_to_array(features)))

    def save(self, spark: SparkSession, path: str) -> None:
        """Two tables below ``path``: the nodes of all trees, and the rest."""
        nodes = [
            (i, j, int(t.feature[j]), float(t.threshold[j]), int(t.right[j]), float(t.value[j]))
            for i, t in enumerate(self.trees) for j in range(len(t.feature))
        ]
        schema = "tree int, node int, feature int, threshold double, right int, value double"
        spark.createDataFrame(nodes, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        rest = {"initial": self.initial, "rate": self.rate, "trees": len(self.trees), "importances": self.featureImportances.tolist()}
        spark.createDataFrame([(json.dumps(rest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> HuberModel:
        rest = json.loads(spark.read.text(f"{path}/model").first()[0])
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()  # as many as the trees have nodes
        parts = {i: part for i, part in nodes.groupby("tree")}
        trees = [Tree(*(parts[i][c].to_numpy() for c in ("feature", "threshold", "right", "value"))) for i in range(rest["trees"])]
        return HuberModel(rest["initial"], rest["rate"], trees, np.array(rest["importances"]))


def _listed(tree: Grown, thresholds: list[np.ndarray], values: np.ndarray) -> Tree:
    """The tree with thresholds in place of bins; ``values`` as ``step`` has them."""
    feature, threshold, right, value = [], [], [], []
    last = len(tree.feature) // 2

    def add(node: int) -> None:
        here, of = len(feature), int(tree.feature[node])
        feature.append(of)
        threshold.append(float(thresholds[of][tree.cut[node]]) if of >= 0 else math.nan)
        right.append(-1)
        value.append(0.0 if of >= 0 else float(values[node * (last >> (node.bit_length() - 1))]))
        if of >= 0:
            add(2 * node)
            right[here] = len(feature)
            add(2 * node + 1)

    add(1)
    return Tree(np.array(feature), np.array(threshold), np.array(right), np.array(value))


def _from_order_bits(k: int) -> float:
    return float(np.array([k if k >= 0 else k ^ (2**63 - 1)], dtype=np.int64).view(np.float64)[0])


def _lower(share: float, n: int) -> int:
    """The rank of the smallest value that at least the share of ``n`` values do not exceed."""
    return max(math.ceil(share * n) - 1, 0)


def _thresholds(rows: DataFrame, size: int, width: int, fits: int) -> dict[tuple[int, int], list[float]]:
    """Per fit and feature the ascending thresholds between its bins, from all rows of the fit.

    With few values they lie between all of them, else between about as many rows each: the
    k-th lies below the first value whose rows have their middle beyond k shares, but above
    the threshold before. That is at most a few values behind such a one, so slices of the
    order of all values return these neighbourhoods only, with places counted over all slices.
    """
    flags = [f"_in{i}" for i in range(fits)]
    values = rows.select(*flags, F.posexplode("_values").alias("feature", "v")).groupBy("feature", "v")
    counted = values.agg(*[F.count_if(flag).alias(f"n{i}") for i, flag in enumerate(flags)])
    slices = max(math.ceil(size * width / VALUES_PER_SLICE), 1)
    counted = stage(counted.repartitionByRange(slices, "feature", "v").withColumn("slice", F.spark_partition_id()), "values")
    sums = counted.groupBy("feature", "slice").agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(fits)], *[F.count_if(F.col(f"n{i}") > 0).alias(f"m{i}") for i in range(fits)]
    )
    ends: dict[int, np.ndarray] = {}  # rows and values per fit, up to a slice and in the end of all
    starts: dict[tuple[int, int], np.ndarray] = {}
    for r in sums.orderBy("feature", "slice").collect():
        here = np.array([[r[f"n{i}"], r[f"m{i}"]] for i in range(fits)])
        starts[r["feature"], r["slice"]] = ends.get(r["feature"], np.zeros_like(here))
        ends[r["feature"]] = starts[r["feature"], r["slice"]] + here

    def near(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("v")
        feature, part = int(group["feature"].iloc[0]), int(group["slice"].iloc[0])
        found = []
        for i in range(fits):
            n = group[f"n{i}"].to_numpy()
            some = np.flatnonzero(n)
            v, n, (before, first) = group["v"].to_numpy()[some] + 0.0, n[some], starts[feature, part][i]
            middle = 2 * (before + np.cumsum(n)) - n  # twice the middle of the value's rows
            hits = np.searchsorted(BINS * middle, 2 * ends[feature][i, 0] * np.arange(1, BINS), side="right")
            wanted = np.concatenate([np.arange(BINS + 1), [len(v) - 1], (hits[:, None] + np.arange(-1, BINS)).ravel()])
            wanted = np.unique(wanted[(wanted >= 0) & (wanted < len(v))])
            found.append(pd.DataFrame({"fit": i, "feature": feature, "place": first + wanted, "v": v[wanted], "middle": middle[wanted]}))
        return pd.concat(found)

    def cut(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        fit, feature = int(group["fit"].iloc[0]), int(group["feature"].iloc[0])
        n, m = ends[feature][fit].tolist()
        value = dict(zip(group["place"].tolist(), group["v"].tolist()))
        if m <= BINS:
            kept = list(range(1, m))
        else:
            kept = []
            for place, middle in zip(group["place"].tolist(), group["middle"].tolist()):
                if place and BINS * middle > 2 * n * (len(kept) + 1):
                    kept.append(place)
        cuts = [(value[place - 1] + value[place]) / 2 for place in kept]
        return pd.DataFrame({"fit": [fit], "feature": [feature], "cuts": [cuts]})

    nearby = counted.groupBy("feature", "slice").applyInPandas(near, "fit int, feature int, place long, v double, middle long")
    found = nearby.groupBy("fit", "feature").applyInPandas(cut, "fit int, feature int, cuts array<double>").collect()
    return {(r["fit"], r["feature"]): r["cuts"] for r in found}


@dataclass(frozen=True)
class _Rows:
    """The written rows, how many they are, the trees that came after them, and the shape of their bins.

    ``blocks`` has a cached RDD of batches for the written rows and for every round after
    them, unless the rows are many; a lost block is made anew from the written rows.
    """

    frame: DataFrame
    size: int
    later: list[list[Grown]]
    width: int
    fits: int
    blocks: tuple[RDD, ...] = ()

    def cached(self) -> _Rows:
        if self.size > HERE_ROWS:
            return self
        read = self.reader()

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(read(batch), pickle.HIGHEST_PROTOCOL)]})

        packed = self.frame.select(*self.columns()).mapInArrow(pack, "block binary").rdd
        return replace(self, blocks=(packed.map(lambda row: pickle.loads(row[0])).persist(StorageLevel.MEMORY_AND_DISK),))

    def moved(self, trees: list[Grown]) -> _Rows:
        """The rows after one more tree per fit."""
        after = replace(self, later=[*self.later, trees])
        if not self.blocks:
            return after
        for old in self.blocks[:-1]:  # the newest is read to make the next one
            old.unpersist()
        newest = self.blocks[-1].map(lambda batch: batch.moved(trees)).persist(StorageLevel.MEMORY_AND_DISK)
        return replace(after, blocks=(self.blocks[-1], newest))

    def dropped(self) -> None:
        for blocks in self.blocks:
            blocks.unpersist()

    def reader(self) -> Callable[[pa.RecordBatch], Batch]:
        later, width, fits = self.later, self.width, self.fits

        def read(batch: pa.RecordBatch) -> Batch:
            packed = batch.column("_bins").cast(pa.large_binary())
            first = int(np.frombuffer(packed.buffers()[1], dtype=np.int64)[packed.offset])
            bins = np.frombuffer(packed.buffers()[2], dtype=np.uint8)[first : first + batch.num_rows * fits * width]
            starts = [np.arange(batch.num_rows) * (fits * width) + i * width for i in range(fits)]
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            used = np.stack([batch.column(f"_in{i}").to_numpy(zero_copy_only=False).astype(bool) for i in range(fits)], axis=1)
            at = np.stack([batch.column(f"prediction{i}").to_numpy(zero_copy_only=False) for i in range(fits)], axis=1)
            read = Batch(label, used, bins, starts, at)
            for trees in later:
                read = read.moved(trees)
            return read

        return read

    def columns(self) -> list[str]:
        return ["label", "_bins", *[f"{c}{i}" for c in ("_in", "prediction") for i in range(self.fits)]]

    def written(self) -> DataFrame:
        """The rows with their predictions brought up to date."""
        read, fits = self.reader(), self.fits

        def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = read(batch).at if batch.num_rows else np.zeros((0, fits))
                for i in range(fits):
                    place = batch.schema.get_field_index(f"prediction{i}")
                    batch = batch.set_column(place, f"prediction{i}", pa.array(at[:, i]))
                yield batch

        return self.frame.mapInArrow(update, self.frame.schema)

    def sums(self, of_batch: Callable[[Batch], dict[str, np.ndarray]], schema: str) -> dict[str, np.ndarray]:
        """What tasks find in their batches, as rows of ``key`` and sums, added up per key.

        The findings of a few tasks are added here, which saves a shuffle; the keys are
        nodes, features and bins, so a task's findings have a size of their own.
        """
        names = [field.split()[0] for field in schema.split(", ")][1:]
        if self.blocks:
            values = self._here(of_batch, schema)
        else:
            table = self._found(of_batch, schema).groupBy("key").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
            values = {c: table.column(c).to_numpy() for c in ("key", *names)}
        keys = values.pop("key")
        if len(keys) and keys.max() < DENSE_KEYS:  # places of a histogram need no sorting
            found = np.flatnonzero(np.bincount(keys))
            return {"key": found} | {c: np.bincount(keys, v)[found].astype(v.dtype) for c, v in values.items()}
        keys, at = np.unique(keys, return_inverse=True)
        return {"key": keys} | {c: np.bincount(at, v, len(keys)).astype(v.dtype) for c, v in values.items()}

    def values(self, of_batch: Callable[[Batch], dict[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Keys and values as tasks find them; they have to be few."""
        schema = "key long, v double"
        if self.blocks:
            found = self._here(of_batch, schema)
            return found["key"], found["v"]
        table = self._found(of_batch, schema).toArrow()
        return table.column("key").to_numpy(), table.column("v").to_numpy()

    def _here(self, of_batch: Callable[[Batch], dict[str, np.ndarray]], schema: str) -> dict[str, np.ndarray]:
        parts = self.blocks[-1].map(of_batch).collect()
        kinds = {"long": np.int64, "double": np.float64}
        named = [field.split() for field in schema.split(", ")]
        return {c: np.concatenate([np.zeros(0, kinds[kind]), *[part[c] for part in parts]]) for c, kind in named}

    def _found(self, of_batch: Callable[[Batch], dict[str, np.ndarray]], schema: str) -> DataFrame:
        read = self.reader()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_pydict(of_batch(read(batch)))

        return self.frame.select(*self.columns()).mapInArrow(run, schema)


Keyed = Callable[[Batch], tuple[np.ndarray, np.ndarray]]


def _ranked(rows: _Rows, keyed: Keyed, share: float, most: int) -> tuple[dict[int, float], dict[int, np.ndarray] | None]:
    """Per key the exact value at a share of its values, and all values if there are few.

    Radix selection: the leading sixteen bits are counted, and only the buckets that hold a
    wanted rank are looked into, sixteen bits a pass, until they have few values, which are
    sorted. ``most`` says how many values there can be.
    """

    def sorted_values(chosen: Keyed) -> dict[int, np.ndarray]:
        def found(batch: Batch) -> dict[str, np.ndarray]:
            key, v = chosen(batch)
            return {"key": key, "v": v}

        key, v = rows.values(found)
        order = np.lexsort((v, key))
        key, v = key[order], v[order]
        keys, starts = np.unique(key, return_index=True)
        return {int(k): part for k, part in zip(keys, np.split(v, starts[1:]))}

    if most <= LAST_ROWS:
        lists = sorted_values(keyed)
        return {k: float(v[_lower(share, len(v))]) for k, v in lists.items()}, lists

    prefixes: dict[int, int] = {}  # of the wanted values, by key
    ranks: dict[int, int] = {}
    left = 0
    for shift in (48, 32, 16, 0):

        def inside(batch: Batch, shift: int = shift, known: dict[int, int] = dict(prefixes)) -> tuple[np.ndarray, np.ndarray]:
            key, v = keyed(batch)
            if known:
                chosen = among(key, order_bits(v) >> (shift + 16), known)
                key, v = key[chosen], v[chosen]
            return key, v

        if prefixes and left <= LAST_ROWS:
            return {k: float(v[ranks[k]]) for k, v in sorted_values(inside).items()}, None

        def counted(batch: Batch, shift: int = shift, inside: Keyed = inside) -> dict[str, np.ndarray]:
            key, v = inside(batch)
            bucket = (order_bits(v) >> shift) & 0xFFFF if shift < 48 else (order_bits(v) >> 48) + 0x8000
            pairs, n = np.unique(key * 0x10000 + bucket, return_counts=True)
            return {"key": pairs, "n": n}

        table = rows.sums(counted, "key long, n long")
        order = np.argsort(table["key"])
        pairs, n = table["key"][order], table["n"][order]
        keys, starts = np.unique(pairs >> 16, return_index=True)
        left = 0
        for k, bucket, sizes in zip(keys.tolist(), np.split(pairs & 0xFFFF, starts[1:]), np.split(n, starts[1:])):
            ends = np.cumsum(sizes)
            rank = ranks[k] if k in ranks else _lower(share, int(ends[-1]))
            hit = int(np.searchsorted(ends, rank, side="right"))
            ranks[k] = rank - int(ends[hit] - sizes[hit])
            prefixes[k] = (prefixes[k] << 16) + int(bucket[hit]) if k in prefixes else int(bucket[hit]) - 0x8000
            left += int(sizes[hit])
    return {k: _from_order_bits(bits) for k, bits in prefixes.items()}, None


def _variance(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    n = np.maximum(n, 1)
    return (q - s * s / n) / n


def _grow(
    rows: _Rows, thresholds: list[list[np.ndarray]], bounds: list[float], used: list[int], max_depth: int, min_rows: int
) -> tuple[list[Grown], list[np.ndarray]]:
    """Trees on the residuals cut off at the bounds, and their importances: of every node
    the split with the largest drop of variance, the first of equal ones."""
    fits, width = rows.fits, rows.width
    features = np.arange(width)
    trees = [Grown.of_depth(max_depth) for _ in range(fits)]
    means = [np.zeros(2 << max_depth) for _ in range(fits)]
    gains = [np.zeros(2 << max_depth) for _ in range(fits)]
    impurity = [np.zeros(2 << max_depth) for _ in range(fits)]
    growing = {i: {1} for i in used}

    for depth in range(max_depth):
        first = nodes = 1 << depth
        opened = {i: np.isin(np.arange(first, 2 * first), list(open_)) for i, open_ in growing.items() if open_}
        if not opened:
            break

        def histogram(batch: Batch) -> dict[str, np.ndarray]:
            found = []
            for i, open_ in opened.items():
                node = batch.places(trees[i], i, depth) - first
                mine = np.flatnonzero(batch.used[:, i] & open_[node])
                target = np.clip(batch.residual(i)[mine], -bounds[i], bounds[i])
                bins = batch.bins[batch.starts[i][mine][:, None] + features]
                place = (bins + (node[mine] * BINS)[:, None] + features * (nodes * BINS)).ravel()
                n = np.bincount(place, minlength=width * nodes * BINS)
                s, q = (np.bincount(place, np.repeat(w, width), len(n)) for w in (target, target * target))
                some = np.flatnonzero(n)
                found.append((i * width * nodes * BINS + some, n[some], s[some], q[some]))
            return {name: np.concatenate(part) for name, part in zip(("key", "n", "s", "q"), zip(*found))}

        table = rows.sums(histogram, "key long, n long, s double, q double")
        n, s, q = (np.zeros(fits * width * nodes * BINS) for _ in range(3))
        for total, name in ((n, "n"), (s, "s"), (q, "q")):
            total[table["key"]] = table[name]
        shape = (fits, width, nodes, BINS)
        n, s, q = (np.cumsum(x.reshape(shape), axis=3) for x in (n, s, q))
        left = n[..., :-1], s[..., :-1], q[..., :-1]
        right = [x[..., -1:] - x[..., :-1] for x in (n, s, q)]
        if depth == 0:
            for i in opened:  # added up as Spark does, so that equal splits round alike
                f = int(np.argmax([len(cuts) > 0 for cuts in thresholds[i]]))
                impurity[i][1] = _variance(*(x[i, f, 0, 0] + y[i, f, 0, 0] for x, y in zip(left, right)))
        of = np.maximum(n[..., -1:], 1)
        spread = left[0] / of * _variance(*left), right[0] / of * _variance(*right)
        for i, open_ in opened.items():
            growing[i] = set()
            for at in np.flatnonzero(open_).tolist():
                node = first + at
                allowed = (left[0][i, :, at] >= min_rows) & (right[0][i, :, at] >= min_rows)
                gain = np.where(allowed, impurity[i][node] - spread[0][i, :, at] - spread[1][i, :, at], -np.inf)
                f, cut = np.unravel_index(np.argmax(gain), gain.shape)
                if not gain[f, cut] > 0:
                    continue
                trees[i].feature[node], trees[i].cut[node] = f, cut
                gains[i][node] = gain[f, cut] * n[i, f, at, -1]
                for child, (cn, cs, cq) in ((2 * node, left), (2 * node + 1, right)):
                    sums = cn[i, f, at, cut], cs[i, f, at, cut], cq[i, f, at, cut]
                    means[i][child], impurity[i][child] = sums[1] / sums[0], _variance(*sums)
                    if abs(impurity[i][child]) >= 1e-16:
                        growing[i].add(child)

    importances = []
    for tree, mean, gain in zip(trees, means, gains):
        for node in range((1 << max_depth) - 1, 0, -1):  # leaves of equal means are one
            ends = tree.feature[2 * node] < 0 and tree.feature[2 * node + 1] < 0
            if tree.feature[node] >= 0 and ends and mean[2 * node] == mean[2 * node + 1]:
                tree.feature[node] = -1
        inner = tree.feature >= 0
        found = np.bincount(tree.feature[inner], gain[inner], width)
        importances.append(found / found.sum() if found.sum() else found)
    return trees, importances


def boost(
    rows: DataFrame, fitted: list[Column], iterations: int, max_depth: int, rate: float, seed: int, min_rows: int = 10,
) -> tuple[DataFrame, list[HuberModel]]:
    """``rows`` with the columns prediction0, prediction1, ..., and one model per condition
    in ``fitted``, fitted on the rows that meet it.

    ``rows`` have ``label`` and ``features`` and are best a written table of many files, as
    every round passes over them several times. The models grow in step: bounds, levels of
    trees, medians and means are those of all models in one pass. A model without rows predicts 0.
    Nothing is drawn, so the result does not depend on ``seed``.
    """
    fits = range(len(fitted))
    send_package(rows.sparkSession)
    columns = rows.columns
    flagged = rows.withColumns({f"_in{i}": F.coalesce(c, F.lit(False)) for i, c in enumerate(fitted)})
    sizes = flagged.agg(F.count("*").alias("n"), *[F.count_if(f"_in{i}").alias(f"n{i}") for i in fits], F.first(F.size(vector_to_array("features"))).alias("width")).first()
    counts, width = [sizes[f"n{i}"] for i in fits], sizes["width"] or 0
    used, most = [i for i in fits if counts[i]], sum(counts)
    if not used:
        empty = [HuberModel(0.0, rate, [], np.zeros(0)) for _ in fits]
        return rows.withColumns({f"prediction{i}": F.lit(0.0) for i in fits}), empty

    valued = flagged.withColumn("_values", vector_to_array("features"))
    cuts = _thresholds(valued, sizes["n"], width, len(fitted))
    thresholds = [[np.array(cuts.get((i, f), [])) for f in range(width)] for i in fits]

    @F.pandas_udf("binary")
    def binned(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        matrix = np.stack(values.to_numpy())
        parts = [np.searchsorted(cut, matrix[:, f]).astype(np.uint8) for of_fit in thresholds for f, cut in enumerate(of_fit)]
        return pd.Series([row.tobytes() for row in np.ascontiguousarray(np.stack(parts, axis=1))])

    state = valued.withColumns({"_bins": binned("_values")} | {f"prediction{i}": F.lit(0.0) for i in fits}).drop("_values")
    at = _Rows(stage(state, "boosting"), sizes["n"], [], width, len(fitted)).cached()

    def of_fits(value: Callable[[Batch, int], np.ndarray], key: Callable[[Batch, int], np.ndarray]) -> Keyed:
        def keyed(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
            mine = [batch.used[:, i] for i in used]
            return (
                np.concatenate([key(batch, i)[m] for i, m in zip(used, mine)]),
                np.concatenate([value(batch, i)[m] for i, m in zip(used, mine)]),
            )

        return keyed

    def fit_only(batch: Batch, i: int) -> np.ndarray:
        return np.full(len(batch.label), i, dtype=np.int64)

    found, _ = _ranked(at, of_fits(lambda batch, i: batch.label, fit_only), 0.5, most)
    initial = [found.get(i, 0.0) for i in fits]
    start = [Grown(np.full(2, -1), np.zeros(2, dtype=np.int64), np.full(2, initial[i])) for i in fits]
    at = at.moved(start)
    models: list[list[Tree]] = [[] for _ in fits]
    importances = [np.zeros(width) for _ in fits]
    for done in range(iterations):
        if done and done % STAGE_ROUNDS == 0:
            at.dropped()
            at = replace(at, frame=stage(at.written(), "boosting"), later=[]).cached()
        found, _ = _ranked(at, of_fits(lambda batch, i: np.abs(batch.residual(i)), fit_only), SHARE, most)
        bounds = [found.get(i, 0.0) for i in fits]
        grown, important = _grow(at, thresholds, bounds, used, max_depth, min_rows)
        nodes = 2 << max_depth

        def leaf(batch: Batch, i: int, grown: list[Grown] = grown, nodes: int = nodes) -> np.ndarray:
            return batch.places(grown[i], i) + i * nodes

        leaves = of_fits(lambda batch, i: batch.residual(i), leaf)
        medians, lists = _ranked(at, leaves, 0.5, most)
        if lists is not None:
            means = {k: float(np.cumsum(np.clip(v - medians[k], -bounds[k // nodes], bounds[k // nodes]))[-1] / len(v)) for k, v in lists.items()}
        else:
            middle, bound = np.zeros(nodes * len(fitted)), np.repeat(bounds, nodes)
            middle[list(medians)] = list(medians.values())

            def apart(batch: Batch, leaves: Keyed = leaves, middle: np.ndarray = middle, bound: np.ndarray = bound) -> dict[str, np.ndarray]:
                key, v = leaves(batch)
                n, s = np.bincount(key), np.bincount(key, np.clip(v - middle[key], -bound[key], bound[key]))
                some = np.flatnonzero(n)
                return {"key": some, "n": n[some], "s": s[some]}

            table = at.sums(apart, "key long, n long, s double")
            means = dict(zip(table["key"].tolist(), (table["s"] / table["n"]).tolist()))
        for i in used:
            values = np.array([medians[k] + means[k] if (k := i * nodes + j) in medians else 0.0 for j in range(nodes)])
            grown[i].step[:] = rate * values
            models[i].append(_listed(grown[i], thresholds[i], values))
            importances[i] += important[i]
        at = at.moved(grown)
    at.dropped()
    scaled = [x / x.sum() if x.sum() else x for x in importances]
    predicted = at.written().select(*columns, *[f"prediction{i}" for i in fits])
    return predicted, [HuberModel(initial[i], rate, models[i], scaled[i] if counts[i] else np.zeros(0)) for i in fits]
