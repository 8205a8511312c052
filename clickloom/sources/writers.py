"""Writers for Parquet tables, JSON metrics and fitted models."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession

from clickloom.models.boosting import HuberModel


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``, snappy-compressed; of a partitioned table only the
    partitions that ``df`` has rows for, so a rerun for one day leaves the other days.

    Partitioned tables are rebalanced on the partition columns: small partitions
    end up in one file, and adaptive execution splits an oversized one over
    several tasks, so one busy day does not become a single writer.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_features(df: DataFrame, base: str, model: str) -> str:
    path = f"{base}/features/{model}_features"
    write_parquet(df, path)
    return path


def write_predictions(df: DataFrame, base: str, model: str) -> str:
    path = f"{base}/predictions/{model}_predictions"
    write_parquet(df, path)
    return path


def write_metrics(df: DataFrame, base: str, model: str) -> str:
    """Metric rows as JSON lines; a handful of rows, hence one file."""
    path = f"{base}/metrics/{model}_metrics"
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def save_model(model: Model | HuberModel, base: str, name: str) -> str:
    path = f"{base}/models/{name}_model"
    if isinstance(model, HuberModel):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)
    return path
