"""Readers of captured inputs and writers of results."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.relational import csv_rows, place_csv, quarantined
from .lead_sink import deliver_leads, read_ledger
from .parts import checked_id, delete_parts, read_parts, write_parts
from .sinks import FolderSink, Sink, register_sink
from .tables import TableStore, store_rows, stream_to_table

__all__ = [
    "FolderSink", "Sink", "TableStore", "checked_id", "delete_parts", "deliver_leads", "read_ledger", "read_parts", "read_payloads", "read_query_lines", "read_result", "register_sink",
    "register_writer", "store_rows", "stream_to_jdbc", "stream_to_table", "write_csv", "write_jdbc", "write_json", "write_parquet", "write_parts", "write_places", "write_results",
]

LOG = logging.getLogger(__name__)
WRITERS: dict[str, Callable[[DataFrame, str], None]] = {}


def read_query_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One captured document per file: path and payload."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))


def register_writer(name: str, write: Callable[[DataFrame, str], None]) -> None:
    """A custom sink under a name, used by write_results."""
    WRITERS[name] = write


def write_places(places: DataFrame, path: str) -> None:
    """The 34 columns of a CSV of places."""
    place_csv(places).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    csv_rows(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 50, **options: str) -> DataFrame:
    """Appends the rows fit to store in batches; returns those set aside, with a NUL in any string, nested or not.

    df is computed once, into the checkpoint folder, so that a source that changes meanwhile has each
    row on one side.  A failed append may leave rows, as JDBC writes have no ledger; tables.store_rows
    has one, and sets aside what the database itself refuses.
    """
    good, bad = quarantined(df.checkpoint())
    good.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch).options(**options).mode("append").save()
    return bad


def stream_to_jdbc(stream: DataFrame, url: str, table: str, checkpoint: str, every: str = "1 minute", batch: int = 50, **options: str) -> StreamingQuery:
    """Appends a stream to a table, a micro-batch each interval, in inserts of batch rows; unfit rows are logged by number.

    A replayed batch is appended again; tables.stream_to_table stores each row once.
    """

    def write(rows: DataFrame, number: int) -> None:
        unfit = write_jdbc(rows, url, table, batch, **options).count()
        if unfit:
            LOG.warning("batch %d: %d rows hold NUL characters and were left out", number, unfit)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=every).foreachBatch(write).start()


def read_result(spark: SparkSession, folder: str, job: str) -> DataFrame:
    """The stored CSV of a job, by its id; FileNotFoundError if there is none."""
    path = f"{folder}/{checked_id(job)}.csv"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        raise FileNotFoundError(f"no result of job {job}")
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)


for _name, _write in (("csv", write_csv), ("json", write_json), ("parquet", write_parquet), ("places", write_places)):
    register_writer(_name, _write)


def write_results(df: DataFrame, kind: str, path: str) -> None:
    if kind not in WRITERS:
        raise ValueError(f"no writer named {kind}")
    WRITERS[kind](df, path)
