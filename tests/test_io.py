"""Readers and writers on files in a fresh folder."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from clickloom.operators import etl
from clickloom.plans.lake import Lake
from clickloom.sources import readers, writers

RECORD = {"event_id": "e1", "session_id": "s1", "user_id": "u1", "timestamp": "2024-01-01T10:00:00.250000", "event_type": "page_view"}
BUY = {**RECORD, "event_id": "e2", "event_type": "purchase", "cart_value": 12.5, "num_items": 2}


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "clicks.csv"
    path.write_text("cart_value,user_id,event_id,timestamp,session_id\n12.5,u1,e1,2024-01-01T10:00:00,s1\noops,u1,e2,bad,s1\n")
    rows = readers.read_events(spark, str(path)).orderBy("event_id").collect()
    assert (rows[0].user_id, rows[0].cart_value, rows[0].timestamp.hour, rows[0].device) == ("u1", 12.5, 10, None)
    assert (rows[1].cart_value, rows[1].timestamp) == (None, None)


@pytest.mark.parametrize("name, text", [
    ("a.jsonl", "\n".join(json.dumps(r) for r in (RECORD, BUY))),
    ("b.json", json.dumps([RECORD, BUY], indent=2)),
    ("c.json", "\n".join(json.dumps(r) for r in (RECORD, BUY))),
])
def test_json_lines_and_arrays(spark, tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    rows = readers.read_events(spark, str(path)).orderBy("event_id").collect()
    assert [(r.event_id, r.cart_value, r.num_items) for r in rows] == [("e1", None, None), ("e2", 12.5, 2)]
    assert rows[0].timestamp.microsecond == 250000


def test_other_extensions_are_refused(spark):
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_events(spark, "clicks.xml")


def test_missing_metric_tables_are_skipped(spark, tmp_path):
    writers.write_parquet(spark.range(3), str(tmp_path / "dim_user_metrics"))
    assert set(readers.read_metric_tables(spark, str(tmp_path))) == {"dim_user_metrics"}


def test_etl_round_trip(spark, sf_dir, tmp_path):
    lake = Lake.of(spark, sf_dir)
    paths = etl.run_etl(lake.raw(), str(tmp_path / "out"))
    assert set(paths) == set(etl.ETL_TABLES)
    sessions, users = readers.read_sessions_users(spark, str(tmp_path / "out"))
    assert sessions.count() == lake["sessions"].count() and users.count() == lake["users"].count()
    read = readers.read_parquet_table(spark, paths["fact_events"])
    assert dict(read.dtypes)["event_date"] == "date" and read.count() == lake["events"].count()
    # a second run replaces the days it has rows for, and tables without partitions
    day = datetime.date(2024, 1, 5)
    again = lake.raw().filter(F.to_date("timestamp") == day).orderBy("event_id").limit(5)
    other_days = lake["events"].filter(F.col("event_date") != day).count()
    etl.run_etl(again, str(tmp_path / "out"))
    written = spark.read.parquet(paths["fact_events"])
    assert written.filter(F.col("event_date") == day).count() == 5 and written.count() == other_days + 5


def test_date_filter_prunes_partitions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "fact_events")
    writers.write_parquet(Lake.of(spark, sf_dir)["events"], path, ["event_date"])
    one_day = spark.read.parquet(path).filter("event_date = date '2024-01-05'").select("session_id")
    files = one_day.inputFiles()
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert one_day.count() > 0 and files and "PartitionFilters: [isnotnull(event_date" in plan


def test_csv_files_with_other_headers_and_quotes(spark, tmp_path):
    folder = tmp_path / "clicks.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("event_id,session_id,user_id,timestamp,event_type\ne1,s1,u1,2024-01-01T10:00:00,page_view\n")
    (folder / "b c.csv").write_text('event_type,user_id,cart_value,event_id,search_query\npurchase,u2,3.5,e2,"27"" Monitor, black"\n')
    (folder / "c.csv").write_text("\n")
    rows = readers.read_events(spark, str(folder)).orderBy("event_id").collect()
    assert [(r.event_id, r.user_id, r.event_type, r.session_id) for r in rows] == [("e1", "u1", "page_view", "s1"), ("e2", "u2", "purchase", None)]
    assert rows[1].cart_value == 3.5 and rows[1].search_query == '27" Monitor, black' and rows[0].timestamp.hour == 10


def test_catalog_with_doubled_quotes(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text('product_id,product_name,category,price,stock_quantity,rating,num_reviews\n1,"27"" Monitor, black",Screens,99.5,3,4.5,7\n')
    row = readers.read_product_catalog(spark, str(path)).first()
    assert (row.product_name, row.category, row.price, row.num_reviews) == ('27" Monitor, black', "Screens", 99.5, 7)


def test_json_folder_with_lines_and_an_array(spark, tmp_path):
    folder = tmp_path / "clicks.json"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps({**RECORD, "event_id": f"a{i}"}) for i in range(3)))
    (folder / "b.json").write_text("\n " + json.dumps([RECORD, BUY], indent=2))
    rows = readers.read_events(spark, str(folder)).orderBy("event_id").collect()
    assert [r.event_id for r in rows] == ["a0", "a1", "a2", "e1", "e2"] and rows[-1].cart_value == 12.5


def test_rerun_of_one_day_leaves_the_other_days(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = lambda day, n: spark.range(n).withColumn("event_date", F.lit(day).cast("date"))
    writers.write_parquet(rows("2024-01-01", 3).union(rows("2024-01-02", 4)), path, ["event_date"])
    writers.write_parquet(rows("2024-01-02", 1), path, ["event_date"])
    found = {str(r.event_date): r["count"] for r in spark.read.parquet(path).groupBy("event_date").count().collect()}
    assert found == {"2024-01-01": 3, "2024-01-02": 1}
