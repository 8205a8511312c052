"""Every operator as a named query over the stored tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, DoubleType, TimestampType

from clickloom.functions import sqltext
from clickloom.models import features as feat, metrics as met, predictions as pred, training
from clickloom.models.boosting import HuberModel
from clickloom.operators import etl, warehouse as wh
from clickloom.plans import dashboards as dash, queries as q, questions as ask, views
from clickloom.plans.lake import Lake
from clickloom.schemas import EVENT_COLUMNS, WAREHOUSE
from clickloom.session import spread
from clickloom.sources import readers, scores, writers

LakeQuery = Callable[[Lake], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so results compare with engines that lack them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _events_out(df: DataFrame) -> DataFrame:
    """Event record with the timestamp as ISO text in microseconds."""
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.select(*EVENT_COLUMNS).withColumn("timestamp", iso)


# --- sources and sinks -----------------------------------------------------


def _read_events_csv(l: Lake) -> DataFrame:
    path = l.scratch("clicks.csv")
    _events_out(l["events"]).write.option("header", True).csv(path)
    return readers.read_events(l.spark, path)


def _read_events_json(l: Lake) -> DataFrame:
    path = l.scratch("clicks.jsonl")
    _events_out(l["events"]).write.json(path)
    return readers.read_events(l.spark, path)


def _read_product_catalog(l: Lake) -> DataFrame:
    path = l.scratch("product_catalog.csv")
    l["catalog"].write.option("header", True).csv(path)
    return readers.read_product_catalog(l.spark, path)


def _etl_output(l: Lake) -> str:
    base = l.scratch("processed")
    etl.run_etl(l.raw(), base)
    return base


def _text(df: DataFrame, name: str) -> Column:
    """A value as text that any engine writes alike: fractions as whole ten-thousandths, times as microseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, (DoubleType, DecimalType)):
        return F.round(F.col(name).cast("double") * 10000).cast("long").cast("string")
    if isinstance(kind, TimestampType):
        return F.unix_micros(name).cast("string")
    return F.col(name).cast("string")


def _digest(df: DataFrame, table: str) -> DataFrame:
    """Per column: rows, known values and the sum of a hash of every value, in one pass."""
    columns = [
        F.struct(
            F.lit(c).alias("column_name"), F.count("*").alias("num_rows"), F.count(c).alias("num_known"),
            F.sum(F.conv(F.substring(F.md5(_text(df, c)), 1, 7), 16, 10).cast("long")).alias("digest"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*columns).alias("c")).select(F.lit(table).alias("table_name"), F.inline("c"))


def _digests(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [_digest(df, table) for table, df in tables.items()])


def _run_etl(l: Lake) -> DataFrame:
    base = _etl_output(l)
    return _digests({n: readers.read_parquet_table(l.spark, f"{base}/{n}") for n in etl.ETL_TABLES})


def _refresh_etl(l: Lake) -> DataFrame:
    """The tables of a run over all days but the latest, then brought up to date by that day alone."""
    base, raw = l.scratch("processed"), l.raw()
    latest = l["events"].agg(F.max("event_date")).first()[0]
    is_latest = F.coalesce(F.to_date(F.col("timestamp").try_cast("timestamp")) == F.lit(latest), F.lit(False))
    etl.run_etl(raw.filter(~is_latest), base)
    paths = etl.refresh_etl(raw.filter(is_latest), base)
    return _digests({n: readers.read_parquet_table(l.spark, path) for n, path in paths.items()})


def _read_parquet_table(l: Lake) -> DataFrame:
    """Rows of the partitioned event table per partition, read back by folder."""
    path = l.scratch("fact_events")
    writers.write_parquet(l["events"], path, ["event_date"])
    return readers.read_parquet_table(l.spark, path).groupBy("event_date").agg(
        F.count("*").alias("num_rows"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at")
    )


def _write_parquet(l: Lake) -> DataFrame:
    path = l.scratch("fact_sessions")
    writers.write_parquet(l["sessions"], path, ["event_date"])
    return readers.read_parquet_table(l.spark, path).select(*l["sessions"].columns)


def _read_metric_tables(l: Lake) -> DataFrame:
    base = l.scratch("processed")
    for source, name in (("sessions", "fact_sessions"), ("users", "dim_user_metrics"), ("daily", "fact_daily_metrics")):
        writers.write_parquet(l[source], f"{base}/{name}")
    return _digests(readers.read_metric_tables(l.spark, base))


def _read_sessions_users(l: Lake) -> DataFrame:
    base = l.scratch("processed")
    for source, name in (("sessions", "fact_sessions"), ("users", "dim_user_metrics")):
        writers.write_parquet(l[source], f"{base}/{name}")
    sessions, users = readers.read_sessions_users(l.spark, base)
    return _digests({"sessions": sessions, "users": users})


def _load_warehouse_table(l: Lake) -> DataFrame:
    path = l.scratch("fact_sessions")
    writers.write_parquet(wh.load_warehouse_table(l["sessions"], WAREHOUSE["fact_sessions"]), path)
    return readers.read_parquet_table(l.spark, path)


def _write_features(l: Lake) -> DataFrame:
    return l.spark.read.parquet(writers.write_features(l["conversion_features"], l.scratch("out"), "conversion"))


def _write_predictions(l: Lake) -> DataFrame:
    scored = pred.conversion_predictions(scores.conversion_scores(l.spark, l.sf_dir))
    return l.spark.read.parquet(writers.write_predictions(scored, l.scratch("out"), "conversion"))


def _write_metrics(l: Lake) -> DataFrame:
    rows = met.regression_metrics(scores.regressor_scores(l.spark, l.sf_dir))
    path = writers.write_metrics(rows, l.scratch("out"), "ltv")
    return l.spark.read.schema("metric string, value double").json(path)


def _reloaded(l: Lake, model: str) -> DataFrame:
    """Id and score of every row, by the model as stored and loaded again."""
    path = writers.save_model(l.trained(model).model, l.scratch("out"), model)
    key = "session_id" if model == "conversion" else "user_id"
    stored = l[f"{model}_training"]
    names = training.feature_names(stored, key)
    coded, _ = training.encoded(stored, names)
    rows = spread(training.assemble(coded, names, [key]), stored.count())
    if model == "ltv":
        return HuberModel.load(l.spark, path).transform(rows).select(key, F.col("prediction").alias("score"))
    scored = RandomForestClassificationModel.load(path).transform(rows)
    return scored.select(key, "prediction", vector_to_array("probability")[1].alias("score"))


def _save_model(l: Lake) -> DataFrame:
    """Predictions of the stored and reloaded conversion model."""
    return _reloaded(l, "conversion").select("session_id", "prediction")


# --- models ----------------------------------------------------------------


def _run_ml_models(l: Lake) -> DataFrame:
    """Metrics of the three models, each stored with its features, predictions and metrics."""
    return l.metrics()


def _prediction_actuals(l: Lake) -> DataFrame:
    """Model, id and true value of every row that the trained models scored."""
    columns = {"conversion": ("session_id", "actual_converted"), "churn": ("user_id", "actual_churned"), "ltv": ("user_id", "actual_revenue")}
    rows = [
        l.predictions(model).select(F.lit(model).alias("model"), F.col(key).alias("id"), F.col(value).cast("double").alias("actual"))
        for model, (key, value) in columns.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _model_properties(l: Lake) -> DataFrame:
    """What must hold for any training: sizes of its parts, features, sum of importances, scores
    within range, the stored and reloaded model's scores and the metrics recomputed from the
    written predictions."""
    parts = []
    written = {
        "conversion": ("session_id", "conversion_probability", "actual_converted", "predicted_converted"),
        "churn": ("user_id", "churn_probability", "actual_churned", "predicted_churned"),
        "ltv": ("user_id", "predicted_ltv_90days", "actual_revenue", None),
    }
    for model, (key, score, actual, predicted) in written.items():
        stored = l.predictions(model)
        # sessions over midnight have several rows with equal ids: compare their sorted scores
        lists = lambda df, c, name: df.groupBy(key).agg(F.sort_array(F.collect_list(c)).alias(name))
        both = lists(stored, score, "old").join(lists(_reloaded(l, model), "score", "new"), key, "full")
        apart = F.zip_with("old", "new", lambda a, b: F.abs(a - b))
        worst = F.max(F.coalesce(F.array_max(apart), F.lit(1e9)))
        parts.append(both.agg(F.round(worst, 9).alias("value")).select(F.lit(model).alias("model"), F.lit("reload_difference").alias("property"), "value"))
        # the held-out rows once more, by their written predictions
        held = l.trained(model).tested.select(key).distinct().join(stored, key)
        held = held.select(F.col(actual).alias("actual"), F.col(predicted or score).alias("predicted"), F.col(score).alias("score"))
        again = met.classification_metrics(held) if predicted else met.regression_metrics(held.drop("score"))
        kept = l.metrics().filter(F.col("model") == model).select("metric", F.col("value").alias("kept"))
        apart = F.when(F.col("value").eqNullSafe(F.col("kept")), 0.0).otherwise(F.coalesce(F.abs(F.col("value") - F.col("kept")), F.lit(1e9)))
        gap = again.join(kept, "metric", "left").agg(F.round(F.max(apart), 6).alias("value"))
        parts.append(gap.select(F.lit(model).alias("model"), F.lit("metric_difference").alias("property"), "value"))
    for model, probability in (("conversion", "conversion_probability"), ("churn", "churn_probability"), ("ltv", None)):
        metrics = l.trained(model).metrics.filter(F.col("metric").isin("train_size", "test_size"))
        parts.append(metrics.select(F.lit(model).alias("model"), F.col("metric").alias("property"), "value"))
        importance = l.trained(model).importance.agg(
            F.count("*").cast("double").alias("features"), F.round(F.sum("importance"), 6).alias("importance_sum")
        )
        parts.append(importance.unpivot([], ["features", "importance_sum"], "property", "value").select(F.lit(model).alias("model"), "property", "value"))
        if probability:
            outside = l.predictions(model).filter(~F.col(probability).between(0, 1)).agg(F.count("*").cast("double").alias("value"))
            parts.append(outside.select(F.lit(model).alias("model"), F.lit("scores_out_of_range").alias("property"), "value"))
    return reduce(DataFrame.unionByName, parts)


def _cross_validate(l: Lake) -> DataFrame:
    return l.metrics().filter(F.col("metric").startswith("cv_"))


def _train_test_split(l: Lake) -> DataFrame:
    split = training.train_test_split(l["conversion_features"], "session_id", "label")
    return split.select("session_id", "label", "is_test")


def _one_hot(l: Lake) -> DataFrame:
    return feat.one_hot(l["sessions"].select("session_id", "event_date", "device"), "device", "device").drop("device")


def _balanced_weights(l: Lake) -> DataFrame:
    return met.balanced_weights(l["conversion_features"], "label")


def _untimed(df: DataFrame) -> DataFrame:
    """Without the time of the run, so that results can be compared."""
    return df.drop("prediction_timestamp")


def _score(build: Callable[[SparkSession, str], DataFrame], use: Callable[[DataFrame], DataFrame]) -> LakeQuery:
    return lambda l: use(build(l.spark, l.sf_dir))


def _scored(l: Lake, model: str) -> DataFrame:
    """Prediction table built on scores derived from the events instead of a model."""
    source = {"conversion": scores.conversion_scores, "churn": scores.churn_scores, "ltv": scores.ltv_scores}[model]
    return pred.prediction_table(model, source(l.spark, l.sf_dir))


def _sql_text(use: Callable[[DataFrame], DataFrame]) -> LakeQuery:
    return lambda l: use(scores.sql_replies(l.spark, l.sf_dir))


def _all_tables(l: Lake) -> dict[str, DataFrame]:
    """The warehouse tables, with prediction tables built on derived scores."""
    return l.warehouse() | {
        "dim_device": l["dim_device"],
        "ml_conversion_predictions": l["scored_conversion"],
        "ml_churn_predictions": l["scored_churn"],
        "ml_ltv_predictions": l["scored_ltv"],
    }


SOURCES: dict[str, LakeQuery] = {
    "read_events_csv": _read_events_csv,
    "read_events_json": _read_events_json,
    "read_product_catalog": _read_product_catalog,
    "read_parquet_table": _read_parquet_table,
    "read_metric_tables": _read_metric_tables,
    "read_sessions_users": _read_sessions_users,
    "write_parquet": _write_parquet,
    "run_etl": _run_etl,
    "refresh_etl": _refresh_etl,
    "load_warehouse_table": _load_warehouse_table,
    "write_features": _write_features,
    "write_predictions": _write_predictions,
    "write_metrics": _write_metrics,
    "save_model": _save_model,
}

ETL: dict[str, LakeQuery] = {
    "clean_events": lambda l: etl.clean_events(l.raw()),
    "event_sequence": lambda l: etl.event_sequence(l["events"]).select(
        "event_id", "session_id", "timestamp", "event_sequence", "prev_timestamp", "time_since_prev_event"
    ),
    "session_metrics": lambda l: etl.session_metrics(l["events"]),
    "product_metrics": lambda l: etl.product_metrics(l["events"]),
    "user_metrics": lambda l: etl.user_metrics(l["events"]).drop("user_segment"),
    "user_segments": lambda l: etl.user_segments(
        l["users"].select("user_id", "num_sessions", "total_purchases")
    ),
    "daily_metrics": lambda l: etl.daily_metrics(l["events"]),
    "insight_last7_days": lambda l: etl.insight_last7_days(l["daily"]),
    "insight_segment_distribution": lambda l: etl.insight_segment_distribution(l["users"]),
    "insight_top10_products": lambda l: etl.insight_top10_products(l["products"]),
    "insight_session_conversion": lambda l: etl.insight_session_conversion(l["sessions"]),
}

WAREHOUSE_QUERIES: dict[str, LakeQuery] = {
    "dim_date": lambda l: wh.dim_date(l["daily"]),
    "dim_users": lambda l: wh.dim_users(l["users"]),
    "dim_products": lambda l: wh.dim_products(l["catalog"]),
    "dim_product_metrics": lambda l: wh.dim_product_metrics(l["products"]),
    "dim_device": lambda l: wh.dim_device(l["events"]),
    "fact_events": lambda l: wh.fact_events(l["events"]),
    "fact_sessions": lambda l: wh.fact_sessions(l["sessions"]),
    "fact_daily_metrics": lambda l: wh.fact_daily_metrics(l["daily"]),
    "agg_product_daily": lambda l: wh.agg_product_daily(l["fact_events"]),
    "agg_user_weekly": lambda l: wh.agg_user_weekly(l["fact_events"]),
    "agg_category_metrics": lambda l: wh.agg_category_metrics(l["fact_events"], l["dim_products"]),
    "ml_prediction_tables_conversion": lambda l: wh.ml_conversion_table(l.predictions("conversion")),
    "ml_prediction_tables_churn": lambda l: wh.ml_churn_table(l.predictions("churn")),
    "ml_prediction_tables_ltv": lambda l: wh.ml_ltv_table(l.predictions("ltv")),
    "check_primary_keys": lambda l: wh.check_primary_keys(_all_tables(l)),
    "check_foreign_keys": lambda l: wh.check_foreign_keys(_all_tables(l)),
    "check_not_null": lambda l: wh.check_not_nulls(_all_tables(l)),
}

VIEWS: dict[str, LakeQuery] = {
    "user_purchase_history": lambda l: views.user_purchase_history(l["fact_events"], l["dim_users"], l["dim_products"]),
    "session_funnel": lambda l: views.session_funnel(l["fact_sessions"]),
    "product_affinity": lambda l: l["product_affinity"],
    "user_retention": lambda l: views.user_retention(l["dim_users"], activity=l["user_activity"]),
    "customer_journey_funnel": lambda l: views.customer_journey_funnel(l["fact_events"]),
    "session_analytics": lambda l: views.session_analytics(l["fact_sessions"], l["dim_users"], l["dim_date"]),
    "user_segment_performance": lambda l: views.user_segment_performance(l["dim_users"]),
    "cohort_retention_monthly_literal": lambda l: views.cohort_retention_monthly_literal(l["dim_users"], activity=l["user_activity"]),
    "cohort_retention_monthly": lambda l: views.cohort_retention_monthly(l["dim_users"], activity=l["user_activity"]),
    "touchpoint_performance": lambda l: views.touchpoint_performance(l["fact_events"]),
    "executive_kpis": lambda l: views.executive_kpis(l["fact_daily_metrics"], l["dim_date"]),
    "product_analytics": lambda l: views.product_analytics(l["dim_products"], l["dim_product_metrics"], l["fact_events"]),
    "cart_abandonment": lambda l: views.cart_abandonment(l["fact_sessions"], l["dim_users"]),
    "cart_abandonment_value": lambda l: views.cart_abandonment_value(l["fact_events"]),
    "ml_performance_summary": lambda l: views.ml_performance_summary(
        *[l.predictions(m) for m in pred.MODELS]
    ),
}

QUERIES: dict[str, LakeQuery] = {
    "q01_daily_revenue_trend": lambda l: q.q01_daily_revenue_trend(l["daily"]),
    "q02_segment_distribution": lambda l: q.q02_segment_distribution(l["dim_users"]),
    "q03_top20_products": lambda l: q.q03_top20_products(l["dim_product_metrics"], l["dim_products"]),
    "q04_session_funnel_rates": lambda l: q.q04_session_funnel_rates(l["fact_sessions"]),
    "q05_event_funnel": lambda l: q.q05_event_funnel(l["fact_events"]),
    "q06_hourly_traffic": lambda l: q.q06_hourly_traffic(l["fact_events"]),
    "q07_day_of_week": lambda l: q.q07_day_of_week(l["fact_events"]),
    "q08_month_over_month": lambda l: q.q08_month_over_month(l["fact_events"]),
    "q09_weekly_cohorts": lambda l: q.q09_weekly_cohorts(l["dim_users"]),
    "q10_purchase_frequency_cohorts": lambda l: q.q10_purchase_frequency_cohorts(l["dim_users"]),
    "q11_category_performance": lambda l: q.q11_category_performance(l["dim_product_metrics"]),
    "q12_product_affinity_named": lambda l: q.q12_product_affinity_named(l["product_affinity"], l["dim_products"]),
    "q13_abandoned_cart_products": lambda l: q.q13_abandoned_cart_products(l["fact_events"], l["dim_products"]),
    "q14_session_duration_buckets": lambda l: q.q14_session_duration_buckets(l["fact_sessions"]),
    "q15_device_browser": lambda l: q.q15_device_browser(l["fact_sessions"]),
    "q16_referrer": lambda l: q.q16_referrer(l["fact_sessions"]),
    "q17_top5_per_category": lambda l: q.q17_top5_per_category(l["dim_product_metrics"], l["dim_products"]),
    "q18_running_revenue": lambda l: q.q18_running_revenue(l["daily"]),
    "q19_ltv_percentiles": lambda l: q.q19_ltv_percentiles(l["dim_users"]),
    "q20_ltv_by_acquisition": lambda l: q.q20_ltv_by_acquisition(l["fact_sessions"], l["dim_users"]),
    "q21_time_to_first_purchase": lambda l: q.q21_time_to_first_purchase(l["dim_users"], l["fact_events"]),
    "q22_search_effectiveness": lambda l: q.q22_search_effectiveness(l["fact_events"]),
}

QUESTIONS: dict[str, LakeQuery] = {
    "ask_top10_products_by_revenue": lambda l: ask.ask_top10_products_by_revenue(l["fact_events"], l["dim_products"]),
    "ask_conversion_by_device": lambda l: ask.ask_conversion_by_device(l["fact_sessions"]),
    "ask_users_per_segment": lambda l: ask.ask_users_per_segment(l["dim_users"]),
    "ask_daily_revenue_trend": lambda l: ask.ask_daily_revenue_trend(l["fact_daily_metrics"]),
    "ask_daily_revenue_trend_last7": lambda l: ask.ask_daily_revenue_trend(l["fact_daily_metrics"], 7),
    "ask_highest_churn_risk": lambda l: ask.ask_highest_churn_risk(wh.ml_churn_table(l.predictions("churn")), l["dim_users"]),
    "ask_avg_duration_by_browser": lambda l: ask.ask_avg_duration_by_browser(l["fact_sessions"]),
    "ask_top5_categories_by_purchases": lambda l: ask.ask_top5_categories_by_purchases(l["fact_events"], l["dim_products"]),
    "ask_revenue_by_category": lambda l: ask.ask_revenue_by_category(l["fact_events"], l["dim_products"]),
    "ask_vip_predicted_ltv": lambda l: ask.ask_vip_predicted_ltv(l.predictions("ltv")),
    "extract_sql": _sql_text(lambda df: sqltext.extract_sql(df, "reply")),
    "validate_sql_text": _sql_text(lambda df: sqltext.validate_sql_text(df, "reply")),
    "limit_result": lambda l: ask.limit_result(l["dim_users"].orderBy("user_id")),
}

DASHBOARDS: dict[str, LakeQuery] = {
    "dash_daily_trends": lambda l: dash.dash_daily_trends(l["daily"]),
    "dash_segment_share": lambda l: dash.dash_segment_share(l["users"]),
    "dash_segment_revenue": lambda l: dash.dash_segment_revenue(l["users"]),
    "dash_duration_histogram": lambda l: dash.dash_duration_histogram(l["sessions"]),
    "dash_events_histogram": lambda l: dash.dash_events_histogram(l["sessions"]),
    "dash_sessions_by_device": lambda l: dash.dash_sessions_by_device(l["sessions"]),
    "dash_conversion_by_device": lambda l: dash.dash_conversion_by_device(l["sessions"]),
    "dash_top15_products": lambda l: dash.dash_top15_products(l["products"]),
    "dash_category_interactions": lambda l: dash.dash_category_interactions(l["products"]),
    "dash_click_to_cart_histogram": lambda l: dash.dash_click_to_cart_histogram(l["products"]),
    "dash_price_interactions_sample": lambda l: dash.dash_price_interactions_sample(l["products"]),
    "report_summary": lambda l: dash.report_summary(l["daily"], l["users"], l["sessions"], l["products"]),
    "nb_overall_metrics": lambda l: dash.nb_overall_metrics(l["daily"]),
    "nb_describe_daily": lambda l: dash.nb_describe_daily(l["daily"]),
    "nb_duration_histogram_median": lambda l: dash.nb_duration_histogram_median(l["sessions"]),
    "nb_category_performance": lambda l: dash.nb_category_performance(l["products"]),
    "nb_conversion_by_device": lambda l: dash.nb_conversion_by_device(l["sessions"]),
    "nb_key_insights": lambda l: dash.nb_key_insights(l["users"], l["sessions"], l["products"]),
    "dash_feature_importance_top10": lambda l: dash.top_features(l.importance(), 10),
    "nb_model_metrics": lambda l: dash.nb_model_metrics(l.metrics()),
}

# The data under the prediction charts: (models it reads, function).
PREDICTION_CHARTS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "dash_probability_histogram": (("conversion", "churn"), dash.dash_probability_histogram),
    "dash_risk_counts": (("conversion", "churn"), dash.dash_risk_counts),
    "dash_ltv_actual_vs_predicted": (("ltv",), dash.dash_ltv_actual_vs_predicted),
    "dash_ltv_categories": (("ltv",), dash.dash_ltv_categories),
    "nb_actual_conversion_by_risk": (("conversion",), dash.nb_actual_conversion_by_risk),
    "nb_retention_priority_histogram": (("churn",), dash.nb_retention_priority_histogram),
    "nb_avg_ltv_by_category": (("ltv",), dash.nb_avg_ltv_by_category),
    "nb_retention_targets": (("churn",), dash.nb_retention_targets),
    "nb_high_probability_sessions": (("conversion",), dash.nb_high_probability_sessions),
    "nb_vip_customers": (("ltv",), dash.nb_vip_customers),
}

MODELS: dict[str, LakeQuery] = {
    "conversion_features": lambda l: feat.conversion_features(l["sessions"]),
    "churn_features": lambda l: feat.churn_features(l["users"]),
    "ltv_features": lambda l: feat.ltv_features(l["users"]),
    "one_hot": _one_hot,
    "train_test_split": _train_test_split,
    "balanced_weights": _balanced_weights,
    "train_classifier": lambda l: l.trained("conversion").metrics,
    "train_regressor": lambda l: l.trained("ltv").metrics,
    "cross_validate": _cross_validate,
    "prediction_actuals": _prediction_actuals,
    "model_properties": _model_properties,
    "classification_metrics": _score(scores.classifier_scores, met.classification_metrics),
    "confusion_matrix": _score(scores.classifier_scores, met.confusion_matrix),
    "classification_report": _score(scores.classifier_scores, met.classification_report),
    "roc_curve": _score(scores.classifier_scores, met.roc_curve),
    "regression_metrics": _score(scores.regressor_scores, met.regression_metrics),
    "residual_histogram": _score(scores.regressor_scores, met.residual_histogram),
    "feature_importance": lambda l: l.importance(),
    "conversion_predictions": lambda l: l.predictions("conversion"),
    "churn_predictions": lambda l: l.predictions("churn"),
    "ltv_predictions": lambda l: l.predictions("ltv"),
    "risk_bands": _score(scores.classifier_scores, lambda df: pred.risk_bands(df.select("id", "score"), "score")),
    "ltv_bands": _score(scores.ltv_scores, lambda df: pred.ltv_bands(df.select("user_id", "predicted"), "predicted")),
    "run_ml_models": _run_ml_models,
    "run_ml_pipeline": _run_ml_models,
}

FROM_SCORES: dict[str, LakeQuery] = {
    "conversion_predictions_from_scores": lambda l: _scored(l, "conversion"),
    "churn_predictions_from_scores": lambda l: _scored(l, "churn"),
    "ltv_predictions_from_scores": lambda l: _scored(l, "ltv"),
    "ml_performance_summary_from_scores": lambda l: views.ml_performance_summary(*[_scored(l, m) for m in pred.MODELS]),
    "ml_prediction_tables_conversion_from_scores": lambda l: _untimed(wh.ml_conversion_table(_scored(l, "conversion"))),
    "ml_prediction_tables_churn_from_scores": lambda l: _untimed(wh.ml_churn_table(_scored(l, "churn"))),
    "ml_prediction_tables_ltv_from_scores": lambda l: _untimed(wh.ml_ltv_table(_scored(l, "ltv"))),
    "ask_highest_churn_risk_from_scores": lambda l: ask.ask_highest_churn_risk(
        wh.ml_churn_table(_scored(l, "churn")), l["dim_users"]
    ),
    "ask_vip_predicted_ltv_from_scores": lambda l: ask.ask_vip_predicted_ltv(_scored(l, "ltv")),
}


def _chart(models: tuple[str, ...], build: Callable[..., DataFrame], source: Callable[[Lake, str], DataFrame]) -> LakeQuery:
    return lambda l: build(*[source(l, m) for m in models])


def all_queries() -> dict[str, LakeQuery]:
    named: dict[str, LakeQuery] = {}
    for group in (SOURCES, ETL, WAREHOUSE_QUERIES, VIEWS, QUERIES, QUESTIONS, DASHBOARDS, MODELS, FROM_SCORES):
        named.update(group)
    for name, (models, build) in PREDICTION_CHARTS.items():
        named[name] = _chart(models, build, Lake.predictions)
        named[f"{name}_from_scores"] = _chart(models, build, _scored)
    return named


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: LakeQuery) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(build(Lake.of(spark, sf_dir)))

    return {name: bound(build) for name, build in all_queries().items()}
