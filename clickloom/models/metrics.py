"""Evaluation of scored tables.

Classifier tables hold ``actual`` and ``predicted`` (0/1) and, where a curve is
needed, ``score``. Regressor tables hold ``actual`` and ``predicted`` as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.exprs import ratio
from clickloom.operators.ordered import histogram, running_totals


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight per class: rows / (classes * rows of the class)."""
    whole = Window.partitionBy()  # over one row per class
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.select(
        label, ratio(F.sum("n").over(whole), F.count("*").over(whole) * F.col("n")).alias("weight")
    )


def confusion_matrix(pred: DataFrame) -> DataFrame:
    """All four cells, zeros included."""
    cells = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted")) for a in (0, 1) for p in (0, 1)]
    counts = pred.agg(
        F.array(
            *[F.count_if((F.col("actual") == a) & (F.col("predicted") == p)) for a in (0, 1) for p in (0, 1)]
        ).alias("n")
    )
    return counts.select(F.posexplode("n").alias("i", "num_rows")).select(
        F.get(F.array(*cells), F.col("i"))["actual"].alias("actual"),
        F.get(F.array(*cells), F.col("i"))["predicted"].alias("predicted"),
        "num_rows",
    )


def _prf(tp: Column, predicted: Column, actual: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1, each 0 when undefined."""
    zero = F.lit(0.0)
    return (
        F.coalesce(ratio(tp, predicted), zero),
        F.coalesce(ratio(tp, actual), zero),
        F.coalesce(ratio(tp * 2, predicted + actual), zero),
    )


def _roc_totals(pred: DataFrame) -> DataFrame:
    """Per distinct score: positives and negatives with at least that score."""
    marked = pred.select(
        F.col("score").cast("double").alias("score"),
        F.col("actual").cast("long").alias("pos"),
        (1 - F.col("actual")).cast("long").alias("neg"),
    )
    return running_totals(marked, "score", ["pos", "neg"])


def roc_curve(pred: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """Curve points (threshold, fpr, tpr), from the origin at an infinite threshold.

    Points that lie amid a straight line, that is whose own step and the next one are the
    same, are dropped unless asked for; the first and the last threshold always stay.
    """
    size = pred.agg(
        F.struct(F.sum(F.col("actual").cast("long")).alias("pos"), F.count_if(F.col("actual") == 0).alias("neg"))
    ).scalar()
    totals = _roc_totals(pred)
    if drop_intermediate:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        totals = totals.filter(first | F.col("next_pos").isNull() | turns)
    points = totals.select(
        F.col("score").alias("threshold"),
        ratio("cum_neg", size["neg"]).alias("fpr"),
        ratio("cum_pos", size["pos"]).alias("tpr"),
    )
    origin = pred.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points).select(
        "threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr")
    )


def roc_auc(pred: DataFrame) -> DataFrame:
    """One row, the exact area: pairs ranked correctly, equal scores counting half."""
    # half a win for equal scores, in whole numbers: neg * (2 * above - pos)
    won = _roc_totals(pred).agg(
        F.sum((F.col("neg") * (F.col("cum_pos") * 2 - F.col("pos"))).cast("decimal(38,0)")).alias("twice"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
    )
    return won.select(
        (ratio(F.col("twice").cast("double") / 2, F.col("pos").cast("double") * F.col("neg"))).alias("roc_auc")
    )


def classification_metrics(pred: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 and roc_auc as (metric, value) rows."""
    hit = (F.col("actual") == 1) & (F.col("predicted") == 1)
    c = pred.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("actual") == F.col("predicted")).alias("right"),
        F.count_if(hit).alias("tp"),
        F.count_if(F.col("predicted") == 1).alias("pp"),
        F.count_if(F.col("actual") == 1).alias("ap"),
    )
    precision, recall, f1 = _prf(F.col("tp"), F.col("pp"), F.col("ap"))
    basic = c.select(
        ratio("right", "n").alias("accuracy"), precision.alias("precision"),
        recall.alias("recall"), f1.alias("f1"),
    ).unpivot([], ["accuracy", "precision", "recall", "f1"], "metric", "value")
    return basic.unionByName(roc_auc(pred).select(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))).select(
        "metric", F.round("value", 9).alias("value")
    )


def classification_report(pred: DataFrame) -> DataFrame:
    """Per class and averaged: precision, recall, f1 and support, from one pass."""
    counts = pred.agg(
        *[
            F.count_if(cond).alias(f"{name}{c}")
            for c in (0, 1)
            for name, cond in (
                ("tp", (F.col("actual") == c) & (F.col("predicted") == c)),
                ("pp", F.col("predicted") == c),
                ("n", F.col("actual") == c),
            )
        ]
    )
    scores = {c: _prf(F.col(f"tp{c}"), F.col(f"pp{c}"), F.col(f"n{c}")) for c in (0, 1)}
    support = F.col("n0") + F.col("n1")

    def line(name: str, values: list[Column], rows: Column) -> Column:
        named = [F.round(v, 9).alias(k) for k, v in zip(("precision", "recall", "f1_score"), values)]
        return F.struct(F.lit(name).alias("class_name"), *named, rows.alias("support"))

    pairs = list(zip(scores[0], scores[1]))
    lines = [
        line("0", scores[0], F.col("n0")),
        line("1", scores[1], F.col("n1")),
        line("macro avg", [(a + b) / 2 for a, b in pairs], support),
        line("weighted avg", [ratio(a * F.col("n0") + b * F.col("n1"), support) for a, b in pairs], support),
    ]
    return counts.select(F.inline(F.array(*lines)))


def regression_metrics(pred: DataFrame) -> DataFrame:
    """rmse, mae, r2 and mape (percent, over non-zero actuals) as (metric, value) rows."""
    error = F.col("actual") - F.col("predicted")
    n = F.count("*")
    sums = pred.agg(
        n.alias("n"),
        F.sum(error * error).alias("sse"),
        F.sum(F.abs(error)).alias("sae"),
        (F.var_pop("actual") * n).alias("sst"),
        F.coalesce(F.avg(F.when(F.col("actual") != 0, F.abs(error / F.nullif(F.col("actual"), F.lit(0.0))))), F.lit(0.0)).alias("ape"),
    )
    return sums.select(
        F.sqrt(ratio("sse", "n")).alias("rmse"),
        ratio("sae", "n").alias("mae"),
        (1 - ratio("sse", "sst")).alias("r2"),
        (F.col("ape") * 100).alias("mape"),
    ).unpivot([], ["rmse", "mae", "r2", "mape"], "metric", "value").select(
        "metric", F.round("value", 9).alias("value")
    )


def residual_histogram(pred: DataFrame, bins: int = 30) -> DataFrame:
    residual = F.round(F.col("actual") - F.col("predicted"), 6)
    return histogram(pred.select(residual.alias("residual")), "residual", bins)
