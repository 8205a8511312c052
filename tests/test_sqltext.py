import pytest

from clickloom.functions.sqltext import extract_sql, validate_sql_text

ACCEPTED = [
    "SELECT * FROM dim_users",
    "select u.user_id, s.session_id from dim_users u join fact_sessions s on u.user_id = s.user_id",
    "WITH t AS (SELECT user_id FROM dim_users LIMIT 10) SELECT * FROM t",
    "SELECT * FROM (SELECT user_id FROM dim_users) AS sub",
    "SELECT * FROM dim_users WHERE user_segment = 'delete me'",
    "SELECT created_at, updated_at FROM dim_users;",
]
REJECTED = {
    "INSERT INTO dim_users VALUES (1)": "Query must start with SELECT or WITH, got: INSERT",
    "drop table dim_users": "Query must start with SELECT or WITH, got: DROP",
    "WITH x AS (DELETE FROM dim_users) SELECT 1": "Forbidden SQL keyword detected: DELETE",
    "SELECT 1; DROP TABLE dim_users": "Forbidden SQL keyword detected: DROP",
    "SELECT 1; SELECT 2": "Multiple SQL statements not allowed",
    "": "Empty SQL query",
    "  \n ": "Empty SQL query",
}
REPLIES = {
    "SELECT 1": "SELECT 1",
    "```sql\nSELECT * FROM dim_users\n```": "SELECT * FROM dim_users",
    "```\nSELECT 1;\n```": "SELECT 1",
    "SELECT 1;;": "SELECT 1",
    "Here is the query:\nSELECT *\nFROM t LIMIT 10;": "SELECT *\nFROM t LIMIT 10",
    "Sure. with x as (select 1) select * from x": "with x as (select 1) select * from x",
    "I cannot answer that": "I cannot answer that",
}


@pytest.fixture(scope="module")
def checked(spark):
    rows = [(t,) for t in [*ACCEPTED, *REJECTED, None]]
    return {r.text: r for r in validate_sql_text(spark.createDataFrame(rows, "text string"), "text").collect()}


@pytest.mark.parametrize("text", ACCEPTED)
def test_accepted(checked, text):
    assert checked[text].is_valid and checked[text].reason == ""


@pytest.mark.parametrize("text", list(REJECTED))
def test_rejected(checked, text):
    assert not checked[text].is_valid and checked[text].reason == REJECTED[text]


def test_null_is_empty(checked):
    assert checked[None].reason == "Empty SQL query"


def test_extract(spark):
    rows = extract_sql(spark.createDataFrame([(t,) for t in REPLIES], "text string"), "text").collect()
    assert {r.text: r.sql for r in rows} == REPLIES
