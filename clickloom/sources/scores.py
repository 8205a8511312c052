"""Scored tables derived from the stored events, inputs for the evaluation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

def classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, score in 0..0.99, actual and predicted class."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    score = F.regexp_extract("props", "[0-9]+", 0).cast("int") / F.lit(100.0)
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        score.alias("score"),
        F.when(F.col("value") > 50, 1).otherwise(0).alias("actual"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"),
        "value",
    )


def regressor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, actual (with some zeros) and predicted value."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.when(k == 0, 0.0).otherwise(F.col("value")).alias("actual"),
        F.round(F.col("value") * 0.9 + k / F.lit(10.0), 4).alias("predicted"),
    )


def conversion_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier_scores(spark, sf_dir).withColumnRenamed("id", "session_id")


def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier_scores(spark, sf_dir).select(
        F.col("id").alias("user_id"), "actual", "predicted", "score",
        F.round(F.col("value") * 5, 2).alias("total_revenue"),
    )


def ltv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regressor_scores(spark, sf_dir).select(
        F.col("id").alias("user_id"), "actual", F.round(F.col("predicted") * 4 - 20, 2).alias("predicted")
    )


def sql_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id and a reply per stored conversation turn: its text, alone or around a statement."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    text = F.coalesce("text", F.lit(""))
    quoted = F.replace(text, F.lit("'"), F.lit(""))
    kind = F.pmod(F.coalesce("conv_id", F.lit(0)) + F.coalesce("turn", F.lit(0)), F.lit(6))
    reply = (
        F.when(kind == 0, F.concat(F.lit("```sql\nSELECT * FROM dim_users WHERE note = '"), quoted, F.lit("';\n```")))
        .when(kind == 1, F.concat(text, F.lit("\nSELECT device, COUNT(*)\nFROM fact_sessions GROUP BY device;")))
        .when(kind == 2, F.concat(F.lit("DROP TABLE dim_users -- "), text))
        .when(kind == 3, F.concat(F.lit("SELECT 1; SELECT '"), quoted, F.lit("'")))
        .when(kind == 4, F.concat(F.lit("WITH t AS (SELECT 1) "), text, F.lit(" delete grant")))
        .otherwise(F.concat(F.lit("Note: "), text))
    )
    return turns.select("conv_id", "turn", reply.alias("reply"))
