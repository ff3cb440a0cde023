"""Database tables through DB-API connections: rows stored once, refused rows set aside.

Rows are dealt by a hash of their content to a fixed number of parts, so a write that is repeated
under the same name has the same parts.  A part is one transaction: it notes (run, part) in a ledger
table, inserts its rows in batches, and notes the rows that the database refused.  A part that the
ledger has is skipped, so a replayed micro-batch, a retried task or a repeated write adds nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import closing
from dataclasses import dataclass, field
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from .sinks import Sink, register_sink

FORMAT = "terrabrook_table"
LEDGER_TABLES = (
    "CREATE TABLE IF NOT EXISTS stored_parts (run VARCHAR(200) NOT NULL, part INTEGER NOT NULL, PRIMARY KEY (run, part))",
    "CREATE TABLE IF NOT EXISTS refused_rows (run VARCHAR(200) NOT NULL, part INTEGER NOT NULL, content TEXT, message TEXT)",
)


def of_a_row(error: Exception) -> bool:
    """Whether the database refuses some row (and not, say, the connection), by the names that DB-API gives its errors."""
    return any(c.__name__ in ("DataError", "IntegrityError") for c in type(error).__mro__)


@dataclass(frozen=True)
class TableStore:
    """A table: connect opens a connection in a task, insert is a statement with a mark for each column."""

    connect: Callable[[], Any]
    insert: str
    columns: tuple[str, ...]
    batch: int = 50
    #: The connection's parameter mark, of the ledger's statements.
    mark: str = "%s"
    refuses: Callable[[Exception], bool] = field(default=of_a_row)

    def prepare(self) -> None:
        """Makes the ledger's tables where they are missing."""
        with closing(self.connect()) as connection:
            for statement in LEDGER_TABLES:
                connection.cursor().execute(statement)
            connection.commit()


def insert_or_split(cursor: Any, statement: str, rows: list[tuple], refuses: Callable[[Exception], bool]) -> list[tuple[tuple, str]]:
    """Inserts all rows but those that the database refuses, which it returns with the message.

    A refused batch is halved until its bad rows stand alone: some 2 log n statements a bad row.  Each
    attempt is a savepoint, so a refusal takes back nothing else.
    """
    if not rows:
        return []
    cursor.execute("SAVEPOINT attempt")
    try:
        cursor.executemany(statement, rows)
    except Exception as error:
        cursor.execute("ROLLBACK TO SAVEPOINT attempt")
        cursor.execute("RELEASE SAVEPOINT attempt")
        if not refuses(error):
            raise
        if len(rows) == 1:
            return [(rows[0], str(error))]
        half = len(rows) // 2
        return insert_or_split(cursor, statement, rows[:half], refuses) + insert_or_split(cursor, statement, rows[half:], refuses)
    cursor.execute("RELEASE SAVEPOINT attempt")
    return []


class TableSink(Sink):
    """Tasks commit their own parts; the ledger, not the write's commit, keeps them single."""

    def __init__(self, store: TableStore, run: str):
        self.store, self.run = store, run

    def stage(self, rows: Iterator[pa.RecordBatch]) -> dict[str, int]:
        """rows: part and the store's columns, sorted by part."""
        total = {"stored": 0, "refused": 0, "skipped": 0}
        given = ((r["part"], tuple(r[c] for c in self.store.columns)) for batch in rows for r in batch.to_pylist())
        with closing(self.store.connect()) as connection:
            for part, members in groupby(given, lambda x: x[0]):
                for k, n in self.one_part(connection, part, (values for _, values in members)).items():
                    total[k] += n
        return total

    def one_part(self, connection: Any, part: int, rows: Iterator[tuple]) -> dict[str, int]:
        cursor, mark = connection.cursor(), self.store.mark
        cursor.execute(f"SELECT 1 FROM stored_parts WHERE run = {mark} AND part = {mark}", (self.run, part))
        if cursor.fetchone():
            connection.rollback()
            return {"skipped": sum(1 for _ in rows)}
        stored, refused = 0, []
        try:
            cursor.execute(f"INSERT INTO stored_parts VALUES ({mark}, {mark})", (self.run, part))
            waiting: list[tuple] = []
            for values in rows:
                waiting.append(values)
                if len(waiting) == self.store.batch:
                    refused += insert_or_split(cursor, self.store.insert, waiting, self.store.refuses)
                    stored, waiting = stored + len(waiting), []
            refused += insert_or_split(cursor, self.store.insert, waiting, self.store.refuses)
            stored += len(waiting)
            for values, message in refused:
                content = json.dumps(dict(zip(self.store.columns, values, strict=True)), default=str)
                cursor.execute(f"INSERT INTO refused_rows VALUES ({mark}, {mark}, {mark}, {mark})", (self.run, part, content, message))
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        return {"stored": stored - len(refused), "refused": len(refused)}

    def commit(self, staged: list[Any], batch: int | None) -> None:
        """Parts are committed already."""


def store_rows(df: DataFrame, store: TableStore, run: str, parts: int = 64) -> None:
    """Stores the rows of df once under the name run; what the database refuses is in refused_rows.

    A write that fails leaves whole parts; to repeat it, with the same rows, run and parts, stores the rest.
    """
    store.prepare()
    chosen = df.select(*[F.col(f"`{c}`") for c in store.columns])
    content = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    dealt = chosen.withColumn("part", F.pmod(F.xxhash64(content), F.lit(parts)).cast("int"))
    register_sink(df.sparkSession, FORMAT, lambda options, overwrite: TableSink(store, run))
    dealt.repartition(parts, "part").sortWithinPartitions("part").write.format(FORMAT).mode("append").save()


def stream_to_table(stream: DataFrame, store: TableStore, checkpoint: str, name: str, every: str = "1 minute", parts: int = 64) -> StreamingQuery:
    """Stores a stream, a micro-batch each interval, each row once even if a batch is replayed.

    name tells the streams of one database apart; a stream that starts over with a new checkpoint needs a new one.
    """

    def write(rows: DataFrame, number: int) -> None:
        store_rows(rows, store, f"{name}/{number}", parts)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=every).foreachBatch(write).start()
