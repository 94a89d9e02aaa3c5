"""Files in the shared folder, written and read by tasks through pyarrow's file systems (local, HDFS, S3, ...)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def attempt_suffix() -> str:
    """Differs for each attempt of a task, so a retried or speculative task never writes into another's file."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return f"{task.partitionId():05d}-{task.taskAttemptId()}" if task else "driver-0"


@contextmanager
def writing(uri: str) -> Iterator:
    store, path = resolve(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        yield out


def reading(uri: str):
    store, path = resolve(uri)
    return store.open_input_file(path)
