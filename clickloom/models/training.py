"""Training and evaluation of the conversion, churn and lifetime-value models."""

from __future__ import annotations

import math
import statistics
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from clickloom.models.boosting import HuberModel, boost
from clickloom.models.metrics import balanced_weights, classification_metrics, regression_metrics, roc_auc
from clickloom.operators.ordered import shuffled_rank
from clickloom.session import ROWS_PER_TASK, side_by_side, spread, stage

SEED = 42
TEST_SHARE = 0.2


@dataclass(frozen=True)
class Trained:
    """A fitted model with its outputs.

    ``scored`` holds every input row (training rows included) and ``tested`` the
    held-out ones; both are written tables. ``metrics`` and ``importance`` are small.
    """

    model: Model | HuberModel
    scored: DataFrame
    tested: DataFrame
    metrics: DataFrame
    importance: DataFrame


def feature_names(features: DataFrame, row_id: str) -> list[str]:
    return [c for c in features.columns if c not in (row_id, "label")]


def encoded(rows: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, list[str]]]:
    """Text features as sparse 0/1 vectors, one place per value; returns the values, too.

    A null is the vector of zeros. The number of values is not limited.
    """
    texts = [n for n in names if isinstance(rows.schema[n].dataType, StringType)]
    values: dict[str, list[str]] = {}
    for i, name in enumerate(texts):
        rows = rows.withColumnRenamed(name, "_text")
        known = StringIndexer(inputCol="_text", outputCol="_index", handleInvalid="keep", stringOrderType="alphabetAsc").fit(rows)
        values[name] = list(known.labels)
        # the place behind the last value stands for nulls and is dropped
        places = OneHotEncoder(inputCol="_index", outputCol=f"_vector{i}", dropLast=True).fit(known.transform(rows))
        rows = places.transform(known.transform(rows)).drop("_text", "_index").withColumnRenamed(f"_vector{i}", name)
    return rows, values


def assemble(rows: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """The kept columns and the named features as one vector column.

    Features get plain aliases first, since their names may hold dots or slashes.
    """
    plain = {name: f"_f{i}" for i, name in enumerate(names)}
    aliased = rows.select(
        *[F.col(f"`{c}`").alias(c) for c in keep], *[F.col(f"`{n}`").alias(alias) for n, alias in plain.items()]
    )
    return VectorAssembler(inputCols=list(plain.values()), outputCol="features").transform(aliased).select(
        *keep, "features"
    )


def _test_rows(test_share: float) -> Column:
    return F.col("_rank") <= F.round(F.col("_size") * test_share)


def train_test_split(
    df: DataFrame, row_id: str, label: str, test_share: float = TEST_SHARE, seed: int = SEED, stratified: bool = True
) -> DataFrame:
    """Add ``is_test``: an exact share of the ids, per class when stratified.

    All rows of an id are on one side. The draw depends on the id and the seed only,
    not on partitioning.
    """
    ranked = shuffled_rank(df, [label] if stratified else [], row_id, seed, "_rank", "_size")
    return ranked.withColumn("is_test", _test_rows(test_share)).drop("_rank", "_size")


def split_and_fold(
    df: DataFrame, row_id: str, label: str, k: int, test_share: float = TEST_SHARE, seed: int = SEED,
    stratified: bool = True,
) -> DataFrame:
    """Add ``is_test`` and ``fold`` in 0..k-1, both exact shares of the ids, from one ranking."""
    ranked = shuffled_rank(df, [label] if stratified else [], row_id, seed, "_rank", "_size")
    return ranked.withColumns(
        {"is_test": _test_rows(test_share), "fold": ((F.col("_rank") - 1) % k).cast("int")}
    ).drop("_rank", "_size")


def cross_validate(
    estimator: Estimator, evaluate: Callable[[DataFrame], float], folded: DataFrame, k: int, balanced: bool = False,
    fitted: DataFrame | None = None,
) -> tuple[float, float]:
    """Mean and standard deviation of a score over the k folds given in ``fold``.

    Each fold is scored on all its rows in ``folded``, and fitted on the rows of the
    others, those in ``fitted`` if that is given. One fit per fold, a few at a time; CrossValidator
    would fit the whole table once more. With ``balanced`` the class weights are those of the
    rows each fold is fitted on.
    """

    def score(fold: int) -> float:
        held_out = F.col("fold") == fold
        fitted_on = (folded if fitted is None else fitted).filter(~held_out)
        model = estimator.fit(with_class_weights(fitted_on, fitted_on) if balanced else fitted_on)
        return evaluate(model.transform(folded.filter(held_out)))

    scores = side_by_side(score, range(k))
    return statistics.fmean(scores), statistics.pstdev(scores)


def _auc(scored: DataFrame) -> float:
    """The exact area under the curve, as ``classification_metrics`` reports it."""
    rows = scored.select(vector_to_array("probability")[1].alias("score"), F.col("label").cast("int").alias("actual"))
    # the area reads them several times
    return roc_auc(stage(rows, "fold_scores")).first()["roc_auc"] or 0.0


def bounded(df: DataFrame, row_id: str, max_rows: int, seed: int = SEED) -> DataFrame:
    """At most about ``max_rows`` labelled rows to fit on, whole ids drawn by their hash.

    A part of the rows is written, because every fit passes over it many times.
    """
    share = min(1.0, max_rows / max(1, df.count()))
    if share == 1:
        return df
    draw = F.conv(F.substring(F.md5(F.concat_ws("-", F.col(row_id), F.lit(f"rows{seed}"))), 1, 8), 16, 10).cast("long")
    drawn = df.filter(draw < int(share * (1 << 32)))
    return stage(drawn.repartition(math.ceil(max_rows / ROWS_PER_TASK)), "labelled")


def with_class_weights(df: DataFrame, train: DataFrame) -> DataFrame:
    """Add ``weight``, balanced over the training rows. One value per class is read
    to the driver, so that fitting scans the rows without a join."""
    weights = balanced_weights(train, "label").collect()
    chain = F
    for row in weights:
        chain = chain.when(F.col("label") == row["label"], row["weight"])
    return df.withColumn("weight", chain.otherwise(1.0))


def feature_importance(model: Model | HuberModel, names: list[str], spark: SparkSession) -> DataFrame:
    """(feature, importance) rows, bounded by the number of features."""
    values = model.featureImportances.toArray().tolist() if isinstance(model, Model) else model.featureImportances.tolist()
    return spark.createDataFrame(list(zip(names, values)), "feature string, importance double")


def _extra_metrics(spark: SparkSession, **values: float) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")


def train_classifier(
    features: DataFrame, row_id: str, num_trees: int = 100, max_depth: int = 10,
    folds: int = 5, seed: int = SEED, keep: list[str] | None = None, max_rows: int | None = None,
) -> Trained:
    """Random forest with balanced class weights, fitted on all rows of the training part.

    The split rows are written once, because fitting passes over them many times. All
    rows are scored. Only a caller who gives ``max_rows`` fits on a part of the rows.
    """
    spark = features.sparkSession
    names = feature_names(features, row_id)
    size = features.count()
    features, values = encoded(features, names)
    split = split_and_fold(features, row_id, "label", folds, seed=seed)
    rows = stage(spread(assemble(split, names, [row_id, "label", "is_test", "fold", *(keep or [])]), size), "model_rows")
    forest = RandomForestClassifier(
        numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=10, seed=seed, weightCol="weight"
    )
    labelled = rows if max_rows is None else bounded(rows, row_id, max_rows)
    train = labelled.filter(~F.col("is_test"))
    model = forest.fit(with_class_weights(train, train))

    probability = vector_to_array("probability")[1]
    scores = model.transform(rows).select(
        row_id, *(keep or []), F.col("label").cast("int").alias("actual"), probability.alias("score"),
        F.when(probability >= 0.5, 1).otherwise(0).alias("predicted"), "is_test",
    )
    scored = stage(scores, "scored")
    tested = scored.filter("is_test")
    cv_mean, cv_std = cross_validate(forest, _auc, rows, folds, balanced=True, fitted=labelled)
    fit_size = labelled.filter(~F.col("is_test")).count()
    sizes = scored.agg(F.count_if("is_test").alias("test"), F.count("*").alias("n")).first()
    metrics = classification_metrics(tested).unionByName(
        _extra_metrics(
            spark, cv_roc_auc_mean=cv_mean, cv_roc_auc_std=cv_std,
            train_size=sizes["n"] - sizes["test"], test_size=sizes["test"], fit_size=fit_size,
        )
    )
    places = [p for n in names for p in ([f"{n}_{v}" for v in values[n]] if n in values else [n])]
    return Trained(model, scored, tested, metrics, feature_importance(model, places, spark))


def _r2_scores(rows: DataFrame, predictions: dict[int, str]) -> list[float]:
    """R squared of every fold's own predictions, 0 for a fold of equal labels."""
    label = F.col("label")
    chosen = F.coalesce(*[F.when(F.col("fold") == fold, F.col(name)) for fold, name in predictions.items()])
    held = rows.select("fold", label, (label - chosen).alias("error")).filter("error IS NOT NULL")
    sums = held.groupBy("fold").agg(F.sum(F.pow("error", F.lit(2))).alias("error"), (F.var_pop("label") * F.count("*")).alias("spread"))
    return [1 - r["error"] / r["spread"] if r["spread"] else 0.0 for r in sums.orderBy("fold").collect()]


def train_regressor(
    features: DataFrame, row_id: str, iterations: int = 100, max_depth: int = 5,
    learning_rate: float = 0.1, folds: int = 5, seed: int = SEED,
) -> Trained:
    """Gradient-boosted trees on Huber loss, fitted on all rows of the training part.

    The models of the folds grow beside the one of the training part, over the same rows.
    """
    spark = features.sparkSession
    names = feature_names(features, row_id)
    split = split_and_fold(features, row_id, "label", folds, seed=seed, stratified=False)
    rows = stage(spread(assemble(split, names, [row_id, "label", "is_test", "fold"]), features.count()), "model_rows")
    fitted = [~F.col("is_test"), *[F.col("fold") != fold for fold in range(folds)]]
    predicted, models = boost(rows, fitted, iterations, max_depth, learning_rate, seed)
    predicted = stage(predicted, "boosted")
    scores = predicted.select(row_id, F.col("label").alias("actual"), F.col("prediction0").alias("predicted"), "is_test")
    scored = stage(scores, "scored")
    tested = scored.filter("is_test")
    cv = _r2_scores(predicted, {fold: f"prediction{fold + 1}" for fold in range(folds)}) or [0.0]
    sizes = scored.agg(F.count_if("is_test").alias("test"), F.count("*").alias("n")).first()
    train_size = sizes["n"] - sizes["test"]
    metrics = regression_metrics(tested).unionByName(
        _extra_metrics(
            spark, cv_r2_mean=statistics.fmean(cv), cv_r2_std=statistics.pstdev(cv),
            train_size=train_size, test_size=sizes["test"], fit_size=train_size,
        )
    )
    return Trained(models[0], scored, tested, metrics, feature_importance(models[0], names, spark))
