"""Whole results when one user, session and product hold a third of all rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import connect, differences

NAMES = [
    "clean_events", "event_sequence", "session_metrics", "product_metrics", "user_metrics", "daily_metrics",
    "product_affinity", "customer_journey_funnel", "touchpoint_performance", "q13_abandoned_cart_products",
    "q19_ltv_percentiles", "q22_search_effectiveness", "agg_product_daily", "user_retention", "roc_curve",
]


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    """The stored tables with every third event moved to one user, an hour and one product."""
    target = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        source = f"{sf_dir}/{name}"
        columns = "*"
        if name == "events.parquet":
            columns = """* REPLACE (
                CASE WHEN event_id % 3 = 0 THEN 4 ELSE user_id END AS user_id,
                CASE WHEN event_id % 3 = 0 THEN timestamp '2024-01-10 23:30:00' + to_seconds((event_id % 3600)::int) ELSE ts END AS ts,
                CASE WHEN event_id % 9 = 0 THEN '{"k": 7}' ELSE props END AS props)"""
        con.execute(f"COPY (SELECT {columns} FROM read_parquet('{source}')) TO '{target}/{name}' (FORMAT parquet)")
    return target, connect(target)


@pytest.mark.parametrize("name", NAMES)
def test_whole_result(name, spark, skewed):
    directory, duck = skewed
    assert differences(entry.queries()[name](spark, directory), duck, entry.oracle_sql()[name]) == []
