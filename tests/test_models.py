"""Feature, split and training properties."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from clickloom import session
from clickloom.models import features as feat, metrics as met, training
from clickloom.models.predictions import ModelSize, run_ml_models, run_model
from clickloom.plans.lake import REGISTERED, Lake
from clickloom.session import spread


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return Lake.of(spark, sf_dir)


def test_text_with_many_values_is_encoded_sparse(spark):
    rows = spark.range(5000).select(F.concat(F.lit("r"), "id").alias("referrer"), F.lit(1.0).alias("n"))
    rows = rows.union(spark.createDataFrame([(None, 1.0)], "referrer string, n double"))
    coded, values = training.encoded(rows, ["n", "referrer"])
    assert len(values["referrer"]) == 5000
    found = {r.referrer.size: r for r in coded.select("referrer").collect()}
    assert set(found) == {5000}
    ones = sorted(int(r.referrer.indices[0]) for r in coded.collect() if len(r.referrer.indices))
    assert ones == list(range(5000))


def test_one_hot_null_has_no_level(frame):
    rows = feat.one_hot(frame([("a",), ("b",), (None,)], "c string"), "c", "c").collect()
    assert [(r.c_a, r.c_b) for r in rows] == [(1, 0), (0, 1), (0, 0)]


@pytest.mark.parametrize("table, row_id, numeric", [
    ("conversion_features", "session_id", feat.CONVERSION_NUMERIC),
    ("churn_features", "user_id", feat.CHURN_NUMERIC),
    ("ltv_features", "user_id", feat.LTV_NUMERIC),
])
def test_features_have_no_gaps(lake, table, row_id, numeric):
    df = lake[table]
    names = training.feature_names(df, row_id)
    assert names[: len(numeric)] == numeric
    bad = df.agg(*[F.count_if(F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`"))).alias(f"n{i}") for i, c in enumerate(names)])
    assert set(bad.first()) == {0}


def test_split_is_exact_per_class_and_folds_are_even(lake):
    df = lake["conversion_features"]
    split = training.split_and_fold(df, "session_id", "label", 5)
    # a session over midnight has several rows: they share a side, a fold and, for the draw, a class
    ids = split.groupBy("session_id").agg(
        F.max("label").alias("label"), F.first("is_test").alias("is_test"), F.first("fold").alias("fold"),
        F.countDistinct("is_test", "fold").alias("places"),
    )
    assert ids.filter("places > 1").count() == 0 and ids.count() < split.count()
    sizes = {(r.label, r.is_test): r["count"] for r in ids.groupBy("label", "is_test").count().collect()}
    for label in (0, 1):
        n = sizes[label, True] + sizes[label, False]
        assert sizes[label, True] == int(n * 0.2 + 0.5)
    per_fold = [r["count"] for r in ids.groupBy("label", "fold").count().filter("label = 0").collect()]
    assert len(per_fold) == 5 and max(per_fold) - min(per_fold) <= 1
    again = training.split_and_fold(df.repartition(3), "session_id", "label", 5)
    assert split.exceptAll(again).count() == 0


def test_balanced_weights(frame):
    rows = met.balanced_weights(frame([(0,)] * 6 + [(1,)] * 2, "label int"), "label").collect()
    assert {r.label: r.weight for r in rows} == pytest.approx({0: 8 / 12, 1: 2.0})


def test_metrics_of_one_class_are_zero_or_null(frame):
    pred = frame([(0, 0, 0.2), (0, 0, 0.4)], "actual int, predicted int, score double")
    values = {r.metric: r.value for r in met.classification_metrics(pred).collect()}
    assert values == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0, "roc_auc": None}


def test_roc_curve_keeps_its_corners(frame, monkeypatch):
    """As numpy's second differences, over many slices, with long straight stretches."""
    import numpy as np

    monkeypatch.setattr(met.running_totals, "__defaults__", (20,))
    rows = [(int(i % 9 == 0 or i < 60), i / 400.0) for i in range(400)] + [(0, 0.5), (1, 0.5)]
    got = met.roc_curve(frame(rows, "actual int, score double")).orderBy(F.desc("threshold")).collect()
    whole = met.roc_curve(frame(rows, "actual int, score double"), drop_intermediate=False).orderBy(F.desc("threshold")).collect()
    thresholds = sorted({s for _, s in rows}, reverse=True)
    fp = np.array([sum(a == 0 for a, s in rows if s >= t) for t in thresholds])
    tp = np.array([sum(a == 1 for a, s in rows if s >= t) for t in thresholds])
    kept = np.r_[True, (np.diff(fp, 2) != 0) | (np.diff(tp, 2) != 0), True]
    assert [r.threshold for r in got[1:]] == [t for t, k in zip(thresholds, kept) if k]
    assert [r.threshold for r in whole[1:]] == thresholds and len(got) < len(whole)
    assert [r.fpr for r in got[1:]] == pytest.approx((fp / fp[-1])[kept].tolist(), abs=1e-8)


def test_regression_mape_ignores_zero_actuals(frame):
    pred = frame([(0.0, 5.0), (10.0, 9.0)], "actual double, predicted double")
    values = {r.metric: r.value for r in met.regression_metrics(pred).collect()}
    assert values["mape"] == pytest.approx(10.0) and values["mae"] == pytest.approx(3.0)
    zeros = frame([(0.0, 5.0), (0.0, 1.0)], "actual double, predicted double")
    assert {r.metric: r.value for r in met.regression_metrics(zeros).collect()}["mape"] == 0.0


def test_models_end_to_end(spark, lake, tmp_path):
    size = ModelSize(trees=3, tree_depth=3, boosting_rounds=2, boosting_depth=2, folds=2)
    trained = run_ml_models(lake["sessions"], lake["users"], str(tmp_path), size)
    for name in ("conversion", "churn"):
        values = {r.metric: r.value for r in trained[name].metrics.collect()}
        assert {"accuracy", "precision", "recall", "f1", "roc_auc", "cv_roc_auc_mean", "cv_roc_auc_std"} <= set(values)
        assert all(0 <= values[m] <= 1 for m in ("accuracy", "precision", "recall", "f1", "roc_auc"))
        stored = spark.read.parquet(f"{tmp_path}/predictions/{name}_predictions")
        probability = f"{name}_probability"
        assert stored.filter(~F.col(probability).between(0, 1)).count() == 0
        assert stored.count() == values["train_size"] + values["test_size"]
        importance = {r.feature: r.importance for r in trained[name].importance.collect()}
        assert sum(importance.values()) == pytest.approx(1.0)
    churn = spark.read.parquet(f"{tmp_path}/predictions/churn_predictions")
    assert churn.filter(F.abs(F.col("retention_priority") - F.col("churn_probability") * F.col("total_revenue")) > 1e-9).count() == 0
    ltv = {r.metric: r.value for r in trained["ltv"].metrics.collect()}
    assert {"rmse", "mae", "r2", "mape", "cv_r2_mean", "cv_r2_std"} <= set(ltv) and ltv["rmse"] >= ltv["mae"] >= 0


def test_folds_are_fitted_on_a_part_and_scored_whole(spark):
    """Also the number of rows that were fitted is reported, beside the size of the split."""
    rows = spark.range(100).select("id", F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("label"))
    folded = rows.withColumn("fold", (F.col("id") % 2).cast("int"))
    fits = []

    class Counted:
        def fit(self, df):
            fits.append(df.count())
            return self

        def transform(self, df):
            return df

    few = folded.filter("id < 20")
    assert training.cross_validate(Counted(), lambda df: df.count(), folded, 2, fitted=few) == (50, 0)
    assert fits == [10, 10]
    labels = rows.withColumn("label", (F.col("id") % 2).cast("int"))
    sizes = training.train_classifier(labels, "id", num_trees=1, max_depth=1, folds=2, max_rows=40).metrics.collect()
    sizes = {r.metric: r.value for r in sizes}
    assert sizes["train_size"] == 80 and 0 < sizes["fit_size"] < 60
    # the value model knows no bound
    sizes = training.train_regressor(rows, "id", iterations=1, max_depth=1, folds=2).metrics.collect()
    sizes = {r.metric: r.value for r in sizes}
    assert sizes["train_size"] == sizes["fit_size"] == 80


def test_many_rows_are_scored_by_many_tasks(spark, monkeypatch):
    """A table of few bytes was one file, so that one task scored all rows."""
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    rows = spark.range(1000).selectExpr("id", "cast(id % 13 as double) a", "cast(id % 7 as double) b", "cast(id % 13 > 6 as int) label")
    trained = training.train_classifier(rows.coalesce(1), "id", num_trees=3, max_depth=2, folds=2, max_rows=400)
    assert len(trained.scored.inputFiles()) >= 4 and trained.scored.count() == 1000
    assert spread(rows, 100).rdd.getNumPartitions() == rows.rdd.getNumPartitions()


def test_a_part_to_fit_on_is_written_once(spark):
    rows = spark.range(1000).withColumn("label", F.lit(1))
    assert training.bounded(rows, "id", 1000) is rows
    part = training.bounded(rows, "id", 300)
    assert 200 < part.count() < 400 and len(part.inputFiles()) >= 1


def test_registered_models_are_fitted_on_all_rows(spark, tmp_path, monkeypatch):
    """The classifiers were fitted on at most 5,000 rows, in every fold and for the stored model."""
    fits = []
    fit = training.RandomForestClassifier.fit
    monkeypatch.setattr(training.RandomForestClassifier, "fit", lambda self, df: fits.append(df.count()) or fit(self, df))
    size = replace(REGISTERED, trees=1, tree_depth=1, folds=2)
    rows = spark.range(12000).selectExpr("cast(id as string) key", "cast(id % 13 as double) total_revenue", "cast(id % 13 > 6 as int) label")
    for model, key in (("conversion", "session_id"), ("churn", "user_id")):
        trained = run_model(model, rows.withColumnRenamed("key", key), str(tmp_path), size)
        sizes = {r.metric: r.value for r in trained.metrics.collect()}
        assert sizes["fit_size"] == sizes["train_size"] == 9600 and sizes["test_size"] == 2400
        assert fits[0] == 9600 and sum(fits[1:]) == 12000
        fits.clear()
