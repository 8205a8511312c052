"""Huber boosting against the same algorithm in plain Python."""

import math
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from clickloom.models import boosting
from clickloom.models.boosting import HuberModel
from clickloom.session import shared_dir, stage


def lower(values, share):
    return sorted(values)[max(math.ceil(share * len(values)) - 1, 0)]


def grow(xs, target, rows, depth, min_rows):
    """Leaves (lists of rows) of the tree with the largest drop of squared error at each split,
    and a function from a row's features to its leaf."""
    best = None
    if depth:
        parent = np.var([target[r] for r in rows]) * len(rows)
        for f in range(len(xs[0])):
            seen = sorted({xs[r][f] for r in rows})
            for a, b in zip(seen, seen[1:]):
                left, right = [r for r in rows if xs[r][f] <= a], [r for r in rows if xs[r][f] > a]
                if min(len(left), len(right)) < min_rows:
                    continue
                gain = parent - sum(np.var([target[r] for r in side]) * len(side) for side in (left, right))
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = gain, f, (a + b) / 2, left, right
    if best is None:
        return [rows], lambda x: 0
    _, f, cut, left, right = best
    (lefts, at_left), (rights, at_right) = grow(xs, target, left, depth - 1, min_rows), grow(xs, target, right, depth - 1, min_rows)
    # thresholds between values that only some rows of the node have do not matter to these rows
    return lefts + rights, lambda x: at_left(x) if x[f] <= cut else len(lefts) + at_right(x)


def plain(xs, ys, fitted, rounds, depth, rate):
    """Predictions of all rows after every round."""
    initial = lower([ys[r] for r in fitted], 0.5)
    at = [initial] * len(ys)
    for _ in range(rounds):
        residual = [y - p for y, p in zip(ys, at)]
        bound = lower([abs(residual[r]) for r in fitted], 0.9)
        leaves, leaf_of = grow(xs, np.clip(residual, -bound, bound), fitted, depth, 10)
        values = []
        for rows in leaves:
            middle = lower([residual[r] for r in rows], 0.5)
            values.append(middle + np.mean(np.clip([residual[r] - middle for r in rows], -bound, bound)))
        at = [p + rate * values[leaf_of(x)] for p, x in zip(at, xs)]
    return at


@pytest.fixture(scope="module")
def sample():
    """500 rows with a few far outliers; features have every value of a small grid often."""
    draw = random.Random(8)
    xs = [[float(draw.randrange(8)), float(draw.randrange(6)), float(draw.randrange(4))] for _ in range(500)]
    ys = [3 * x[0] + x[1] * x[2] + draw.gauss(0, 1) + (500 if draw.random() < 0.02 else 0) for x in xs]
    return xs, ys


def frame_of(spark, xs, ys):
    rows = [(i, y, i % 4 == 0, Vectors.dense(x)) for i, (x, y) in enumerate(zip(xs, ys))]
    return stage(spark.createDataFrame(rows, ["id", "label", "is_test", "features"]), "boost-test")


@pytest.mark.parametrize("few", [True, False])
def test_equals_plain_python(spark, sample, monkeypatch, few):
    if not few:
        monkeypatch.setattr(boosting, "LAST_ROWS", 0)  # the plan for many rows
    xs, ys = sample
    rounds = 6 if few else 2
    predicted, models = boosting.boost(frame_of(spark, xs, ys), [~F.col("is_test"), F.col("id") % 5 != 1], rounds, 3, 0.1, 1)
    got = {r.id: (r.prediction0, r.prediction1) for r in predicted.collect()}
    for i, fitted in enumerate(([r for r in range(500) if r % 4], [r for r in range(500) if r % 5 != 1])):
        expected = plain(xs, ys, fitted, rounds, 3, 0.1)
        assert [got[r][i] for r in range(500)] == pytest.approx(expected, abs=1e-9)
        assert len(models[i].trees) == rounds and models[i].featureImportances.sum() == pytest.approx(1)


def test_loss_falls_and_outliers_do_not_pull(spark, sample):
    xs, ys = sample
    rows = frame_of(spark, xs, ys)
    error = []
    for rounds in (1, 5, 15):
        predicted, _ = boosting.boost(rows, [F.lit(True)], rounds, 3, 0.2, 1)
        error.append(np.median([abs(r.label - r.prediction0) for r in predicted.collect()]))
    assert error[0] > error[1] > error[2] and error[2] < 3


def test_stored_model_scores_alike(spark, sample, tmp_path):
    xs, ys = sample
    predicted, models = boosting.boost(frame_of(spark, xs, ys), [~F.col("is_test")], 4, 4, 0.1, 1)
    models[0].save(spark, str(tmp_path / "m"))
    loaded = HuberModel.load(spark, str(tmp_path / "m"))
    rows = loaded.transform(predicted).select("prediction0", "prediction").collect()
    assert len(rows) == 500 and all(r.prediction == pytest.approx(r.prediction0, abs=1e-9) for r in rows)
    assert loaded.featureImportances.tolist() == models[0].featureImportances.tolist()


def test_without_rows_to_fit_everything_is_zero(spark, sample):
    xs, ys = sample
    predicted, models = boosting.boost(frame_of(spark, xs[:20], ys[:20]), [F.lit(False), F.col("id") < 12], 2, 2, 0.1, 1)
    assert {r.prediction0 for r in predicted.collect()} == {0.0} and not models[0].trees and len(models[1].trees) == 2


def test_local_sessions_without_a_shared_folder_get_one(spark):
    """The setting cannot be changed in a running session, so the folder is kept beside it."""

    class Bare:
        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    assert shared_dir(Bare) == shared_dir(Bare) and shared_dir(Bare).startswith("/")


def test_passes_of_a_round_do_not_grow_with_the_models(spark, sample):
    """Six models once took about sixty jobs a round, one after another within each model."""
    xs, ys = sample
    rows = frame_of(spark, xs, ys)
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()

    def jobs(models, rounds):
        before = scheduler.numTotalJobs()
        predicted, grown = boosting.boost(rows, [F.col("id") % 7 != i for i in range(models)], rounds, 3, 0.1, 1)
        assert all(len(m.trees) == rounds for m in grown) and predicted.count() == 500
        return scheduler.numTotalJobs() - before

    assert jobs(6, 3) - jobs(6, 1) == jobs(2, 3) - jobs(2, 1) <= 2 * 8


def test_trees_are_those_of_spark(spark, sample):
    """The first tree is Spark's regression tree on the residuals that are cut off."""
    xs, ys = sample
    draw = random.Random(3)
    xs = [[x[0], draw.gauss(0, 1), draw.random() if draw.random() < 0.3 else 0.0] for x in xs]  # more values than bins
    ys = [y + 5 * x[1] + (9 if x[2] > 0.5 else 0) for x, y in zip(xs, ys)]
    rows = frame_of(spark, xs, ys)
    _, (model,) = boosting.boost(rows, [F.lit(True)], 1, 4, 0.1, 1)
    residual = [y - lower(ys, 0.5) for y in ys]
    bound = lower([abs(r) for r in residual], 0.9)
    target = F.greatest(F.least(F.col("label") - lower(ys, 0.5), F.lit(bound)), F.lit(-bound))
    learner = DecisionTreeRegressor(labelCol="target", maxDepth=4, minInstancesPerNode=10, seed=1)
    spark_tree = learner.fit(rows.select(F.col("features").alias("features", metadata={}), target.alias("target")))
    expected = [(int(f), float(t)) for f, t in re.findall(r"If \(feature (\d+) <= (\S+)\)", spark_tree.toDebugString)]
    tree = model.trees[0]
    assert [(int(f), float(t)) for f, t in zip(tree.feature, tree.threshold) if f >= 0] == expected and len(expected) > 3
    assert model.featureImportances == pytest.approx(spark_tree.featureImportances.toArray())


def test_adding_up_on_executors_is_the_same(spark, sample, monkeypatch):
    xs, ys = sample
    rows = frame_of(spark, xs, ys)
    few = {r.id: r.prediction0 for r in boosting.boost(rows, [~F.col("is_test")], 2, 3, 0.1, 1)[0].collect()}
    monkeypatch.setattr(boosting, "HERE_ROWS", 0)
    many = {r.id: r.prediction0 for r in boosting.boost(rows, [~F.col("is_test")], 2, 3, 0.1, 1)[0].collect()}
    assert many == pytest.approx(few, abs=1e-9)


def test_few_rows_pass_over_cached_blocks_and_give_the_same(spark, sample, monkeypatch):
    rows, fitted = frame_of(spark, *sample), [~F.col("is_test"), F.col("id") % 3 != 0]
    held = spark.sparkContext._jsc.getPersistentRDDs
    before = held().size()
    with monkeypatch.context() as patch:
        patch.setattr(boosting._Rows, "_found", None)  # a pass plans no query
        _, cached = boosting.boost(rows, fitted, 7, 3, 0.1, 42)
    assert held().size() == before
    monkeypatch.setattr(boosting, "HERE_ROWS", 0)
    _, queried = boosting.boost(rows, fitted, 7, 3, 0.1, 42)
    for a, b in zip(cached, queried):
        assert a.initial == b.initial and len(a.trees) == len(b.trees) == 7
        for x, y in zip(a.trees, b.trees):
            assert x.feature.tolist() == y.feature.tolist()
            np.testing.assert_allclose(x.value, y.value, rtol=1e-12)


def test_tasks_import_numpy_only():
    code = "import sys, clickloom.models.blocks; sys.exit('pandas' in sys.modules or 'pyspark' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], check=False).returncode == 0


def cuts_of(values):
    """Spark's rule for candidate thresholds, over all values."""
    seen, counts = np.unique(values, return_counts=True)
    between = ((seen[:-1] + seen[1:]) / 2).tolist()
    if len(between) < 32:
        return between
    kept, target, total = [], len(values) / 32, counts[0]
    for i in range(1, len(seen)):
        before, total = total, total + counts[i]
        if abs(before - target) < abs(total - target):
            kept.append(between[i - 1])
            target += len(values) / 32
    return kept


@pytest.mark.parametrize("per_slice", [1_000_000, 700])
def test_bins_come_from_all_rows(spark, monkeypatch, per_slice):
    """They came from a sample of 10,000 rows; now whatever the slices, from every row of a fit."""
    monkeypatch.setattr(boosting, "VALUES_PER_SLICE", per_slice, raising=False)
    draw = np.random.default_rng(5)
    n = 12_000 if per_slice > 1000 else 3_000
    flat, few = draw.normal(size=n), draw.integers(0, 5, n) * 1.0
    heavy = np.where(draw.random(n) < 0.6, 0.0, np.round(draw.exponential(3, n), 2))  # thresholds catch up behind a common value
    ends = np.where(draw.random(n) < 0.7, 9.0, np.round(draw.random(n) * 9, 1))
    matrix = np.stack([flat, few, heavy, ends, np.full(n, 2.0)], axis=1)
    rows = [(i, float(3 * x[0] + x[1] + x[2] * x[3]), Vectors.dense(x)) for i, x in enumerate(matrix)]
    rows = stage(spark.createDataFrame(rows, ["id", "label", "features"]).repartition(4), "bins-test")
    masks = [np.ones(n, dtype=bool), np.arange(n) % 3 > 0, np.arange(n) < 40, np.zeros(n, dtype=bool)]
    fitted = [F.lit(True), F.col("id") % 3 > 0, F.col("id") < 40, F.lit(False)]
    found = []
    thresholds = boosting._thresholds
    monkeypatch.setattr(boosting, "_thresholds", lambda *a: found.append(thresholds(*a)) or found[0])
    _, models = boosting.boost(rows, fitted, 1, 4, 0.1, 1)
    for i, mask in enumerate(masks):
        for f in range(5):
            assert found[0].get((i, f), []) == cuts_of(matrix[mask, f])
    tree = models[0].trees[0]
    inner = [(int(f), float(t)) for f, t in zip(tree.feature, tree.threshold) if f >= 0]
    assert len(inner) > 8 and all(t in cuts_of(matrix[:, f]) for f, t in inner)
