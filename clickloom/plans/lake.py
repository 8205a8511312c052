"""The ETL and warehouse tables behind the registered queries.

Each table is computed once per Spark application, written as Parquet to the
shared folder and read back, as a scheduled ETL run would leave it. Queries then
scan only the columns they need, and a lost executor does not trigger a
recomputation of the whole chain.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.models.features import churn_features, conversion_features, ltv_features
from clickloom.models.predictions import MODELS, ModelSize, churn_predictions, conversion_predictions, ltv_predictions, run_model
from clickloom.models.training import Trained
from clickloom.operators import etl, warehouse as wh
from clickloom.plans.views import product_affinity, user_activity
from clickloom.session import shared_dir, use_utc
from clickloom.sources import scores
from clickloom.sources.clicks import click_events, product_catalog
from clickloom.sources.writers import write_parquet

# The registered queries train models of full size on all rows of the training part.
REGISTERED = ModelSize()

_lakes: dict[tuple[str, str], "Lake"] = {}
_lock = threading.RLock()


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.base = f"{shared_dir(spark)}/clickloom-{uuid.uuid4().hex}"
        self.models_dir = f"{self.base}/models"
        self._tables: dict[str, DataFrame] = {}
        self._models: dict[str, Trained] = {}

    @staticmethod
    def of(spark: SparkSession, sf_dir: str) -> "Lake":
        use_utc(spark)
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        with _lock:
            if key not in _lakes:
                _lakes[key] = Lake(spark, sf_dir)
            return _lakes[key]

    def __getitem__(self, name: str) -> DataFrame:
        with _lock:
            if name not in self._tables:
                path = f"{self.base}/{name}"
                write_parquet(_BUILDERS[name](self), path)
                self._tables[name] = self.spark.read.parquet(path)
            return self._tables[name]

    def raw(self) -> DataFrame:
        return click_events(self.spark, self.sf_dir)

    def scratch(self, name: str) -> str:
        """A fresh path below the lake for a query that writes files itself."""
        return f"{self.base}/scratch/{uuid.uuid4().hex}/{name}"

    def trained(self, model: str) -> Trained:
        """The model, trained once per lake; its outputs are below ``models_dir``."""
        with _lock:
            if model not in self._models:
                self._models[model] = run_model(model, self[f"{model}_training"], self.models_dir, REGISTERED)
            return self._models[model]

    def predictions(self, model: str) -> DataFrame:
        self.trained(model)
        return self.spark.read.parquet(f"{self.models_dir}/predictions/{model}_predictions")

    def metrics(self) -> DataFrame:
        """(model, metric, value) rows of all models."""
        for model in MODELS:
            self.trained(model)
        parts = [
            self.spark.read.schema("metric string, value double")
            .json(f"{self.models_dir}/metrics/{m}_metrics")
            .select(F.lit(m).alias("model"), "metric", "value")
            for m in MODELS
        ]
        return reduce(DataFrame.unionByName, parts)

    def importance(self) -> DataFrame:
        parts = [self.trained(m).importance.select(F.lit(m).alias("model"), "*") for m in MODELS]
        return reduce(DataFrame.unionByName, parts)

    def warehouse(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in WAREHOUSE_TABLES}


WAREHOUSE_TABLES = (
    "dim_users", "dim_products", "dim_product_metrics", "dim_date",
    "fact_events", "fact_sessions", "fact_daily_metrics",
)

_BUILDERS: dict[str, Callable[[Lake], DataFrame]] = {
    "events": lambda l: etl.clean_events(l.raw()),
    "sessions": lambda l: etl.session_metrics(l["events"]),
    "products": lambda l: etl.product_metrics(l["events"]),
    "users": lambda l: etl.user_metrics(l["events"]),
    "daily": lambda l: etl.daily_metrics(l["events"]),
    "catalog": lambda l: product_catalog(l.spark, l.sf_dir),
    "dim_users": lambda l: wh.dim_users(l["users"]),
    "dim_products": lambda l: wh.dim_products(l["catalog"]),
    "dim_product_metrics": lambda l: wh.dim_product_metrics(l["products"]),
    "dim_date": lambda l: wh.dim_date(l["daily"]),
    "fact_events": lambda l: wh.fact_events(l["events"]),
    "fact_sessions": lambda l: wh.fact_sessions(l["sessions"]),
    "fact_daily_metrics": lambda l: wh.fact_daily_metrics(l["daily"]),
    "product_affinity": lambda l: product_affinity(l["fact_events"]),
    # prediction tables on scores derived from the events
    "dim_device": lambda l: wh.dim_device(l["events"]),
    "scored_conversion": lambda l: wh.ml_conversion_table(conversion_predictions(scores.conversion_scores(l.spark, l.sf_dir))),
    "scored_churn": lambda l: wh.ml_churn_table(churn_predictions(scores.churn_scores(l.spark, l.sf_dir))),
    "scored_ltv": lambda l: wh.ml_ltv_table(ltv_predictions(scores.ltv_scores(l.spark, l.sf_dir))),
    "user_activity": lambda l: user_activity(l["fact_events"]),
    "conversion_features": lambda l: conversion_features(l["sessions"]),
    "churn_features": lambda l: churn_features(l["users"]),
    "ltv_features": lambda l: ltv_features(l["users"]),
    # for training, text columns stay text, whatever number of values they have
    "conversion_training": lambda l: conversion_features(l["sessions"], encode=False),
    "churn_training": lambda l: l["churn_features"],
    "ltv_training": lambda l: l["ltv_features"],
}
