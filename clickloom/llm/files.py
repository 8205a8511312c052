"""Files that tasks write to and read from the shared folder.

Tasks name their files by attempt and return the names as rows. Only the rows of
successful attempts reach the list of files, so a lost executor or a second attempt
leaves at most a file that no list names.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from clickloom.session import shared_dir


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        path = uri.removeprefix("file:")
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a new folder below the folder that driver and executors share."""
    return f"{shared_dir(spark)}/clickloom-files/{name}-{uuid.uuid4().hex}"


def create(folder: str, suffix: str) -> tuple[str, pa.NativeFile]:
    """A new file of this task attempt: its name and a stream to write."""
    task = TaskContext.get()
    uri = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}{suffix}"
    system, path = _located(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    # what is written is what is stored, whatever the suffix
    return uri, system.open_output_stream(path, compression=None)


def write(uri: str, content: bytes) -> None:
    system, path = _located(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(content)


def open_random(uri: str) -> pa.NativeFile:
    system, path = _located(uri)
    return system.open_input_file(path)


def open_stream(uri: str) -> pa.NativeFile:
    system, path = _located(uri)
    return system.open_input_stream(path, compression=None)


def one_task_each(files: DataFrame) -> DataFrame:
    """The list of files dealt so that every file has a task of its own."""
    return files.repartition(max(1, files.count()))
