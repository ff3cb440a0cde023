"""A bounded streaming source: rows of a table in the order of their ids, at most so many a trigger.

The driver asks the table only for the last id of the next rows; tasks read the rows themselves, by
ranges of ids.  The offset is the last id read, so a restarted query goes on from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import closing
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


@dataclass(frozen=True)
class QueueTable:
    """Where the rows are: a DB-API connection, a table, its increasing whole-number id, and a Spark schema with the id first."""

    connect: Callable[[], Any]
    table: str
    id: str
    schema: str
    mark: str = "%s"


class Range(InputPartition):
    """Ids above first up to last."""

    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class QueueReader(DataSourceStreamReader):
    def __init__(self, queue: QueueTable, columns: list[str], rows: int, tasks: int):
        self.queue, self.columns, self.rows, self.tasks = queue, columns, rows, tasks
        self.at: int | None = None

    def ask(self, statement: str, values: tuple) -> list[tuple]:
        with closing(self.queue.connect()) as connection:
            cursor = connection.cursor()
            cursor.execute(statement, values)
            return cursor.fetchall()

    def initialOffset(self) -> dict:  # noqa: N802
        return {"id": (self.ask(f"SELECT min({self.queue.id}) FROM {self.queue.table}", ())[0][0] or 1) - 1}

    def latestOffset(self) -> dict:  # noqa: N802
        """The last id of the next rows; the offset reached, if there are none."""
        if self.at is None:
            self.at = self.initialOffset()["id"]
        q = self.queue
        next_ids = f"SELECT {q.id} AS id FROM {q.table} WHERE {q.id} > {q.mark} ORDER BY {q.id} LIMIT {self.rows}"
        last = self.ask(f"SELECT max(id) FROM ({next_ids}) AS next_ids", (self.at,))[0][0]
        self.at = self.at if last is None else last
        return {"id": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Spark calls this first after a restart, with the checkpoint's offset as both."""
        self.at = max(self.at if self.at is not None else end["id"], end["id"])
        first, last = start["id"], end["id"]
        step = max(1, -(-(last - first) // self.tasks))
        return [Range(a, min(a + step, last)) for a in range(first, last, step)]

    def read(self, partition: Range) -> Iterator[tuple]:
        q = self.queue
        yield from map(tuple, self.ask(f"SELECT {', '.join(self.columns)} FROM {q.table} WHERE {q.id} > {q.mark} AND {q.id} <= {q.mark} ORDER BY {q.id}", (partition.first, partition.last)))


def read_queue(spark: SparkSession, queue: QueueTable, rows: int, tasks: int = 4) -> DataFrame:
    """The table as a stream of at most rows rows a micro-batch; ids must be given in increasing order."""
    name = f"queue_{queue.table}"
    columns = spark.createDataFrame([], queue.schema).columns

    class Registered(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return queue.schema

        def streamReader(self, schema) -> QueueReader:  # noqa: N802
            return QueueReader(queue, columns, rows, tasks)

    spark.dataSource.register(Registered)
    return spark.readStream.format(name).load()
