"""Custom destinations as Spark formats: df.write.format(name) and writeStream.format(name).

A Sink takes rows in two steps.  Every task stages its rows where nobody reads them and returns what
the commit needs; only the attempts that Spark accepted reach the commit, on the driver.  So retried,
speculative and failed tasks leave nothing visible.
"""

from __future__ import annotations

import json
import uuid
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage


class Sink(ABC):
    """A destination.  Instances travel to the tasks, so they hold settings only."""

    @abstractmethod
    def stage(self, rows: Iterator[pa.RecordBatch]) -> Any:
        """In a task, perhaps several times for the same rows."""

    @abstractmethod
    def commit(self, staged: list[Any], batch: int | None) -> None:
        """Makes visible what the tasks staged; batch is a stream's batch number, which may come twice."""

    def abort(self, staged: list[Any], batch: int | None) -> None:  # noqa: B027
        """Takes back what the tasks staged; tasks that failed aren't in staged."""


#: From the options of the write (lower case) and whether it overwrites.
SinkMaker = Callable[[dict[str, str], bool], Sink]


@dataclass
class Staged(WriterCommitMessage):
    value: Any


def values(messages: list[WriterCommitMessage | None]) -> list[Any]:
    return [m.value for m in messages if isinstance(m, Staged)]


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, sink: Sink):
        self.sink = sink

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return Staged(self.sink.stage(iterator))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.sink.commit(values(messages), None)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.sink.abort(values(messages), None)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, sink: Sink):
        self.sink = sink

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return Staged(self.sink.stage(iterator))

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:  # noqa: N803
        self.sink.commit(values(messages), batchId)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:  # noqa: N803
        self.sink.abort(values(messages), batchId)


def register_sink(spark: SparkSession, name: str, make: SinkMaker) -> None:
    """Registers a format that writes to the sink that make gives; a later one of the same name replaces it."""

    class Registered(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def options_given(self) -> dict[str, str]:
            return {k.lower(): v for k, v in dict(self.options).items()}

        def writer(self, schema, overwrite: bool) -> BatchWriter:
            return BatchWriter(make(self.options_given(), overwrite))

        def streamWriter(self, schema, overwrite: bool) -> StreamWriter:  # noqa: N802
            return StreamWriter(make(self.options_given(), overwrite))

    spark.dataSource.register(Registered)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it: a local path, or any URI that Arrow knows."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def files_in(files: fs.FileSystem, folder: str) -> list[str]:
    """The names of the files in a folder that may be missing."""
    found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File)


class FolderSink(Sink):
    """JSON lines in a folder that all executors share, a file a task: <write or batch>-<task>.json.

    A batch that comes again replaces its files.
    """

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite, self.run = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex

    def staging(self) -> tuple[fs.FileSystem, str, str]:
        files, path = file_system(self.path)
        return files, path, f"{path}/_staged/{self.run}"

    def stage(self, rows: Iterator[pa.RecordBatch]) -> str:
        files, _, staged = self.staging()
        files.create_dir(staged, recursive=True)
        name = f"{staged}/{uuid.uuid4().hex}"
        with files.open_output_stream(name) as out:
            for batch in rows:
                for row in batch.to_pylist():
                    out.write(json.dumps(row, ensure_ascii=False, default=str).encode() + b"\n")
        return name

    def commit(self, staged: list[str], batch: int | None) -> None:
        files, path, folder = self.staging()
        label = self.run if batch is None else f"batch{batch}"
        for old in files_in(files, path):
            if old.startswith(f"{label}-") or (self.overwrite and batch is None):
                files.delete_file(f"{path}/{old}")
        for k, name in enumerate(staged):
            files.move(name, f"{path}/{label}-{k:05d}.json")
        self.forget(files, folder)

    def abort(self, staged: list[str], batch: int | None) -> None:
        files, _, folder = self.staging()
        self.forget(files, folder)

    def forget(self, files: fs.FileSystem, folder: str) -> None:
        if files.get_file_info(folder).type == fs.FileType.Directory:
            files.delete_dir(folder)
