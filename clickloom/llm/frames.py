"""Column access that survives clashing names, Python tasks, and sums over a shared order."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.session import shared_dir

_shipped: set[str] = set()


def position(df: DataFrame, name: str) -> int:
    """Place of the column of that name: spelt alike, else alike but for case."""
    columns = df.columns
    if name in columns:
        return columns.index(name)
    folded = [c.lower() for c in columns]
    if name.lower() not in folded:
        raise ValueError(f"no column {name}, only {columns}")
    return folded.index(name.lower())


def numbered(df: DataFrame) -> DataFrame:
    """The same columns under the names _0, _1, ..., so that no two clash."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def take(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The named columns under new names, whatever else the table holds."""
    held = numbered(df)
    return held.select(*[F.col(f"_{position(df, old)}").alias(new) for new, old in columns.items()])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def row_key(*columns: str):
    """Two hashes that name the content of a row; equal rows share them."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in columns]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *parts).alias("b"))


def before(totals: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group that come earlier.

    For tables that hold one row per cell of a large table, never for its rows.
    """
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, F.coalesce(F.sum(value).over(window), F.lit(0).cast("long")))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python finds it."""
    from clickloom.llm.files import write

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parents[1]
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    uri = f"{shared_dir(spark)}/clickloom-files/package-{uuid.uuid4().hex}.zip"
    write(uri, raw.getvalue())
    context.addPyFile(uri)
    _shipped.add(context.applicationId)


def in_tasks(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df`` turned by a function over the Arrow batches of each partition."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
