"""Prediction tables with risk and value bands, and the end-to-end model run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.models.features import churn_features, conversion_features, ltv_features
from clickloom.models.training import Trained, train_classifier, train_regressor
from clickloom.sources.writers import save_model, write_features, write_metrics, write_predictions


def risk_band(score: str | Column) -> Column:
    """Low up to 0.3, Medium up to 0.7, High up to 1; NULL outside 0..1."""
    p = F.col(score) if isinstance(score, str) else score
    return F.when((p >= 0) & (p <= 0.3), "Low").when((p > 0.3) & (p <= 0.7), "Medium").when((p > 0.7) & (p <= 1), "High")


def ltv_band(value: str | Column) -> Column:
    """Low up to 50 (negatives included), Medium up to 200, High up to 500, VIP above."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v <= 50, "Low").when(v <= 200, "Medium").when(v <= 500, "High").when(v > 500, "VIP")


def risk_bands(df: DataFrame, score: str, output: str = "risk") -> DataFrame:
    return df.withColumn(output, risk_band(score))


def ltv_bands(df: DataFrame, value: str, output: str = "ltv_category") -> DataFrame:
    return df.withColumn(output, ltv_band(value))


def conversion_predictions(scored: DataFrame) -> DataFrame:
    return scored.select(
        "session_id",
        F.col("actual").alias("actual_converted"),
        F.col("score").alias("conversion_probability"),
        F.col("predicted").alias("predicted_converted"),
        risk_band("score").alias("conversion_risk"),
    )


def churn_predictions(scored: DataFrame) -> DataFrame:
    """Retention priority is the churn probability times the revenue at stake."""
    return scored.select(
        "user_id",
        F.col("actual").alias("actual_churned"),
        F.col("score").alias("churn_probability"),
        F.col("predicted").alias("predicted_churned"),
        risk_band("score").alias("churn_risk"),
        "total_revenue",
        (F.col("score") * F.col("total_revenue")).alias("retention_priority"),
    )


def ltv_predictions(scored: DataFrame) -> DataFrame:
    return scored.select(
        "user_id",
        F.col("actual").alias("actual_revenue"),
        F.col("predicted").alias("predicted_ltv_90days"),
        ltv_band("predicted").alias("ltv_category"),
    )


@dataclass(frozen=True)
class ModelSize:
    """Training effort. The defaults are the specified model sizes.

    All models are fitted on all rows of the training part, and all rows are scored.
    """

    trees: int = 100
    tree_depth: int = 10
    boosting_rounds: int = 100
    boosting_depth: int = 5
    folds: int = 5


MODELS = ("conversion", "churn", "ltv")


def build_features(model: str, sessions: DataFrame | None, users: DataFrame | None) -> DataFrame:
    if model == "conversion":
        return conversion_features(sessions, encode=False)
    return churn_features(users) if model == "churn" else ltv_features(users)


def train(model: str, features: DataFrame, size: ModelSize = ModelSize()) -> Trained:
    if model == "ltv":
        return train_regressor(features, "user_id", size.boosting_rounds, size.boosting_depth, folds=size.folds)
    row_id = "session_id" if model == "conversion" else "user_id"
    keep = ["total_revenue"] if model == "churn" else None
    return train_classifier(features, row_id, size.trees, size.tree_depth, size.folds, keep=keep)


def prediction_table(model: str, scored: DataFrame) -> DataFrame:
    build = {"conversion": conversion_predictions, "churn": churn_predictions, "ltv": ltv_predictions}
    return build[model](scored)


def run_model(model: str, features: DataFrame, output: str, size: ModelSize = ModelSize()) -> Trained:
    """Store the features, train on the stored table, store predictions, metrics and model."""
    spark = features.sparkSession
    stored = spark.read.parquet(write_features(features, output, model))
    trained = train(model, stored, size)
    write_predictions(prediction_table(model, trained.scored), output, model)
    write_metrics(trained.metrics, output, model)
    save_model(trained.model, output, model)
    return trained


def run_ml_models(sessions: DataFrame, users: DataFrame, output: str, size: ModelSize = ModelSize()) -> dict[str, Trained]:
    """All three models end to end."""
    return {m: run_model(m, build_features(m, sessions, users), output, size) for m in MODELS}
