"""Session settings shared by the entry points, the benchmark and the tests."""

from __future__ import annotations

import io
import math
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

PARALLEL_JOBS = 4  # model fits that run side by side
ROWS_PER_TASK = 10_000  # of work that costs much per row, such as scoring
MOST_TASKS = 2_000
_local_dirs: dict[str, str] = {}
_sent: set[str] = set()


def build_session(app_name: str, cpus: int | str = "*") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    parallelism = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates and hours are derived from timestamps, so every result assumes UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    # one folder per application; the setting itself cannot be changed in a running session
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="clickloom-")
    return _local_dirs[application]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    For results that a plan reads several times: they are computed once, and a
    lost executor costs no recomputation of what led to them. ``clear_stage`` removes
    them when the results that read them are written.
    """
    path = f"{shared_dir(df.sparkSession)}/clickloom-stage/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Deal the rows out to as many tasks as their number calls for; few rows stay as they are.

    Files are cut into tasks by their bytes. Rows of a few numbers take little room, so a
    million of them, each of which a hundred trees score, would be the work of one task.
    """
    tasks = min(math.ceil(rows / ROWS_PER_TASK), MOST_TASKS)
    return df.repartition(tasks) if tasks > 1 else df


def clear_stage(spark: SparkSession) -> None:
    """Remove the staged tables, lakes and files of this package from the shared folder.

    Call it when every result of the application is written: results that are not yet
    computed still read them.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "clickloom-*")) or []:
        system.delete(status.getPath(), True)


def side_by_side(work: Callable[[Any], Any], items: Iterable[Any], jobs: int = PARALLEL_JOBS) -> list[Any]:
    """``work`` of every item, in order, with at most so many running at a time.

    For driver-side steps that start Spark jobs of their own, such as the fits of several
    folds: a job that cannot fill the cluster leaves room for the next one.
    """
    with ThreadPoolExecutor(max_workers=jobs) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(work), items))


def send_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python finds it."""
    context = spark.sparkContext
    if context.applicationId in _sent or context.master.startswith("local["):
        return
    package = Path(__file__).parent
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    jvm = context._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/clickloom-package/package-{uuid.uuid4().hex}.zip")
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(raw.getvalue())
    finally:
        out.close()
    context.addPyFile(target.toString())
    _sent.add(context.applicationId)
