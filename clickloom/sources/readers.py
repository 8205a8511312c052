"""Readers for raw click files, the catalog and written Parquet tables."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.schemas import CATALOG_COLUMNS, EVENT_COLUMNS
from clickloom.sources.records import Csv, File, JsonArray, RecordFiles, first_csv_record, first_mark, list_files, read_heads

# Folder names of the tables the ETL writes.
METRIC_TABLES = ("fact_daily_metrics", "fact_sessions", "dim_user_metrics", "dim_product_metrics")


def _conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select the columns by name; unparsable text and absent columns become NULL."""
    return df.select(
        *[
            (F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name)
            for name, kind in columns.items()
        ]
    )


def _empty(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns.items()])


def _by_head(spark: SparkSession, path: str, found: Callable[[str, bool], str | None]) -> dict[str, list[File]]:
    """The files below ``path`` by what they begin with; empty ones are left out."""
    files = list_files(spark, path)
    groups: dict[str, list[File]] = {}
    for file, head in zip(files, read_heads(spark, files, found)):
        if head:
            groups.setdefault(head, []).append(file)
    return groups


def _read_csv(spark: SparkSession, path: str, columns: dict[str, str], quoted_breaks: bool = True) -> DataFrame:
    """CSV files with a header each, quotes doubled inside quotes.

    Files may differ in columns and their order: those with one header are one scan.
    Values are read as text and cast, so there is no inference pass. A first pass over
    the quotes tells which files have line breaks inside them: those are read record by
    record, in as many tasks as others. It can be left out where there are none.
    """
    parts = [_empty(spark, columns)]
    for header, files in _by_head(spark, path, first_csv_record).items():
        names = next(csv.reader(io.StringIO(header, newline="")))
        text = ", ".join("`" + name.replace("`", "``") + "` string" for name in names)
        broken: set[int] = set()
        if quoted_breaks:
            all_files = RecordFiles(spark, files, Csv())
            _, broken = all_files.splits(all_files.summaries())
        plain = [f.path for f in files if f.number not in broken]
        if plain:
            parts.append(_conform(spark.read.schema(text).option("header", True).option("escape", '"').csv(plain), columns))
        if broken:
            some = RecordFiles(spark, [f for f in files if f.number in broken], Csv())
            begins, _ = some.splits(some.summaries())
            records = some.records(begins).filter("NOT first")
            parsed = records.select(F.from_csv("record", text, {"escape": '"'}).alias("r")).select("r.*")
            parts.append(_conform(parsed, columns))
    return reduce(DataFrame.unionByName, parts)


def read_events_csv(spark: SparkSession, path: str, quoted_breaks: bool = True) -> DataFrame:
    """Event files whose headers are the keys their writer saw, in any order.

    Without ``quoted_breaks`` a line break always ends a record, and files are read once.
    """
    return _read_csv(spark, path, EVENT_COLUMNS, quoted_breaks)


def read_events_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines (.jsonl), or .json files with either lines or one array; all are read by many tasks.

    Each .json file is told apart by its first character. An array is cut wherever one
    of its objects ends; elements that are no objects are left out.
    """
    text = ", ".join(f"{name} string" for name in EVENT_COLUMNS)
    reader = spark.read.schema(text)
    if path.endswith(".jsonl"):
        return _conform(reader.json(path), EVENT_COLUMNS)
    parts = [_empty(spark, EVENT_COLUMNS)]
    groups = _by_head(spark, path, first_mark)
    lines = [f.path for mark, files in groups.items() if mark != "[" for f in files]
    if lines:
        parts.append(_conform(reader.json(lines), EVENT_COLUMNS))
    if "[" in groups:
        arrays = RecordFiles(spark, groups["["], JsonArray())
        begins, _ = arrays.splits(arrays.summaries())
        parsed = arrays.records(begins).select(F.from_json("record", text).alias("r")).select("r.*")
        parts.append(_conform(parsed, EVENT_COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Pick the reader by file extension."""
    if path.endswith(".csv"):
        return read_events_csv(spark, path)
    if path.endswith((".json", ".jsonl")):
        return read_events_json(spark, path)
    raise ValueError(f"unsupported file format: {path}")


def read_product_catalog(spark: SparkSession, path: str, quoted_breaks: bool = True) -> DataFrame:
    return _read_csv(spark, path, CATALOG_COLUMNS, quoted_breaks)


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    """A written table, including partition columns found in the folder names."""
    return spark.read.parquet(path)


def _read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_metric_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The metric tables that exist under ``base``; absent ones are left out."""
    found = {name: _read_if_present(spark, f"{base}/{name}") for name in METRIC_TABLES}
    return {name: df for name, df in found.items() if df is not None}


def read_sessions_users(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Session and user tables, the inputs of the models."""
    return spark.read.parquet(f"{base}/fact_sessions"), spark.read.parquet(f"{base}/dim_user_metrics")
