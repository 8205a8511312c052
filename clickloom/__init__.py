"""Clickstream analytics on Spark: ETL, star-schema warehouse, journey queries and models."""
