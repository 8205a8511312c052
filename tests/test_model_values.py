"""Rows of trained models against values recomputed from what is written."""

import numpy as np
import pytest

from clickloom.models import features as feat
from clickloom.plans import registry
from clickloom.plans.lake import Lake

COLUMNS = {
    "conversion": ("session_id", "actual_converted", "conversion_probability", "predicted_converted"),
    "churn": ("user_id", "actual_churned", "churn_probability", "predicted_churned"),
    "ltv": ("user_id", "actual_revenue", "predicted_ltv_90days", None),
}


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return Lake.of(spark, sf_dir)


@pytest.fixture(scope="module")
def held(lake):
    """(actual, score, predicted) of the held-out rows by model, from the written predictions."""
    found = {}
    for model, (key, *columns) in COLUMNS.items():
        ids = lake.trained(model).tested.select(key).distinct()
        rows = lake.predictions(model).join(ids, key).select(*[c for c in columns if c]).collect()
        found[model] = [np.array([r[i] for r in rows], dtype=float) for i in range(len(rows[0]))]
    return found


def metrics(spark, sf_dir, query):
    return registry.queries()[query](spark, sf_dir).collect()


def auc(actual, score):
    pos, neg = score[actual == 1], score[actual == 0]
    return float(((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg)))


def test_train_classifier_reports_its_written_scores(spark, sf_dir, held):
    actual, score, predicted = held["conversion"]
    got = {r.metric: r.value for r in metrics(spark, sf_dir, "train_classifier")}
    assert got["accuracy"] == pytest.approx((actual == predicted).mean(), abs=1e-8)
    assert got["roc_auc"] == pytest.approx(auc(actual, score), abs=1e-8)
    assert got["precision"] == pytest.approx(actual[predicted == 1].mean() if (predicted == 1).any() else 0, abs=1e-8)
    assert got["recall"] == pytest.approx(predicted[actual == 1].mean(), abs=1e-8)
    assert ((score >= 0.5) == (predicted == 1)).all() and got["test_size"] == len(actual)


def test_train_regressor_reports_its_written_predictions(spark, sf_dir, held, lake):
    actual, predicted = held["ltv"]
    got = {r.metric: r.value for r in metrics(spark, sf_dir, "train_regressor")}
    error = actual - predicted
    assert got["rmse"] == pytest.approx(np.sqrt((error**2).mean()), abs=1e-6) and got["mae"] == pytest.approx(np.abs(error).mean(), abs=1e-6)
    assert got["r2"] == pytest.approx(1 - (error**2).sum() / ((actual - actual.mean()) ** 2).sum(), abs=1e-8)
    # all rows of the training part, no bound
    assert got["fit_size"] == got["train_size"] == lake["ltv_training"].count() - got["test_size"]


def test_metric_rows_of_all_models_agree(spark, sf_dir, lake):
    every = {(r.model, r.metric): r.value for r in lake.metrics().collect()}
    for query in ("run_ml_models", "run_ml_pipeline"):
        assert {(r.model, r.metric): r.value for r in metrics(spark, sf_dir, query)} == every
    for query, model in (("train_classifier", "conversion"), ("train_regressor", "ltv")):
        assert {(model, r.metric): r.value for r in metrics(spark, sf_dir, query)} == {k: v for k, v in every.items() if k[0] == model}
    folds = {(r.model, r.metric): r.value for r in metrics(spark, sf_dir, "cross_validate")}
    assert folds == {k: v for k, v in every.items() if k[1].startswith("cv_")} and len(folds) == 6
    assert all(0 <= folds[m, "cv_roc_auc_mean"] <= 1 for m in ("conversion", "churn")) and folds["ltv", "cv_r2_mean"] <= 1
    shown = metrics(spark, sf_dir, "nb_model_metrics")
    values = set(every.values())
    assert shown and all(v in values or any(v == pytest.approx(x, abs=1e-3) for x in values) for r in shown for v in r if isinstance(v, float))


def test_importances_name_every_feature(spark, sf_dir, lake):
    rows = metrics(spark, sf_dir, "feature_importance")
    names = {m: {r.feature for r in rows if r.model == m} for m in COLUMNS}
    assert set(feat.CONVERSION_NUMERIC) < names["conversion"] and {"device_mobile", "browser_Chrome"} < names["conversion"]
    assert set(feat.CHURN_NUMERIC) < names["churn"] and set(feat.LTV_NUMERIC) < names["ltv"]
    for m in COLUMNS:
        mine = [r.importance for r in rows if r.model == m]
        assert sum(mine) == pytest.approx(1) and min(mine) >= 0
    # the label of the churn model is made of one feature, so that one leads
    best = max((r for r in rows if r.model == "churn"), key=lambda r: r.importance)
    assert best.feature == "days_since_last_seen"
    top = metrics(spark, sf_dir, "dash_feature_importance_top10")
    for m in COLUMNS:
        expected = sorted((r.importance for r in rows if r.model == m), reverse=True)[:10]
        assert sorted((r.importance for r in top if r.model == m), reverse=True) == pytest.approx(expected)


def test_performance_summary_counts_the_written_rows(spark, sf_dir, lake):
    rows = metrics(spark, sf_dir, "ml_performance_summary")
    counts = sorted(lake.predictions(m).count() for m in COLUMNS)
    assert sorted(next(v for v in r if isinstance(v, int)) for r in rows) == counts


def test_reloaded_model_predicts_alike(spark, sf_dir, lake):
    stored = {}
    for r in lake.predictions("conversion").collect():
        stored.setdefault(r.session_id, []).append(float(r.predicted_converted))
    again = {}
    for r in metrics(spark, sf_dir, "save_model"):
        again.setdefault(r.session_id, []).append(r.prediction)
    # Spark's own prediction breaks the tie at one half differently
    same = sum(sorted(again[k]) == sorted(v) for k, v in stored.items())
    assert again.keys() == stored.keys() and same >= 0.999 * len(stored)
