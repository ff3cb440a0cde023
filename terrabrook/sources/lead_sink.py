"""Delivery of leads in bulks, each lead once.

Sending is a write: no reading of a frame ever sends.  Three things keep a lead from being sent
twice.  Bulks are cut from leads in the order of their keys, so a repeated task cuts the same bulks,
and each carries a key that the service can know it by.  Whatever a task sent is noted in the ledger
when the task ends, well or not, for it stays sent.  And a later delivery of the same name leaves out
what the ledger has as delivered; what failed is tried again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import leads
from .parts import Files, checked_id
from .sinks import Sink, file_system, register_sink

#: At most batch leads and the bulk's key -> messages by index, of those that failed. A repeated key must create nothing.
Create = Callable[[list[dict], str], dict[int, str]]
NOTE = pa.schema([("key", pa.string()), ("run", pa.string()), ("source_id", pa.string()), ("name", pa.string()), ("message", pa.string())])
LEDGER = "key string, run string, source_id string, name string, message string"


def bulks(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[list[dict]]:
    waiting: list[dict] = []
    for batch in rows:
        waiting += batch.to_pylist()
        while len(waiting) >= size:
            yield waiting[:size]
            waiting = waiting[size:]
    if waiting:
        yield waiting


class LeadSink(Sink):
    def __init__(self, create: Create, ledger: str, delivery: str, run: str, batch: int):
        self.create, self.ledger, self.delivery, self.run, self.batch = create, ledger, delivery, run, batch

    def stage(self, rows: Iterator[pa.RecordBatch]) -> dict[str, int]:
        notes: list[dict] = []
        try:
            for bulk in bulks(rows, self.batch):
                keys = [lead.pop("key") for lead in bulk]
                failed = self.create(bulk, hashlib.sha256("\n".join([self.delivery, *keys]).encode()).hexdigest())
                notes += [{"key": k, "run": self.run, "source_id": lead["source_id"], "name": lead["name"], "message": failed.get(i)} for i, (k, lead) in enumerate(zip(keys, bulk, strict=True))]
        finally:
            if notes:
                files, folder = file_system(self.ledger)
                files.create_dir(folder, recursive=True)
                with files.open_output_stream(f"{folder}/{uuid.uuid4().hex}.parquet") as out:
                    pq.write_table(pa.Table.from_pylist(notes, NOTE), out)
        return {"sent": len(notes), "failed": sum(n["message"] is not None for n in notes)}

    def commit(self, staged: list[Any], batch: int | None) -> None:
        """Nothing is left to do: what was sent is noted, and can't be taken back."""


def read_ledger(spark: SparkSession, ledger: str, delivery: str) -> DataFrame:
    """key, run, source_id, name, message (null: delivered) of all that was sent under the name."""
    folder = f"{ledger}/{checked_id(delivery)}"
    return spark.read.schema(LEDGER).parquet(folder) if Files(spark, folder).names(folder) else spark.createDataFrame([], LEDGER)


def deliver_leads(places: DataFrame, create: Create, ledger: str, delivery: str, batch: int = 100, tasks: int | None = None) -> DataFrame:
    """Sends the leads of places that the ledger doesn't have yet; returns this run's failures (key, source_id, name, message).

    Failed leads don't fail the others.  Equal leads are one.  A place without a title fails the run;
    bulks sent before stay sent and noted.  ledger is a folder that the driver and all executors
    share, delivery the name under which a lead goes out once (a job's id, say).  A service without
    idempotency keys gets a lead twice only if a worker dies between a bulk and its note.
    """
    spark, run = places.sparkSession, uuid.uuid4().hex
    found = leads(places)
    fields = [c for c in found.columns if c not in ("name", "error")]
    checked = found.select(F.when(F.col("error").isNull(), F.col("name")).otherwise(F.raise_error(F.col("error"))).alias("name"), *fields)
    keyed = checked.withColumn("key", F.sha2(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), 256))
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = read_ledger(spark, ledger, delivery).filter("message is null").select("key").distinct()
    new = keyed.join(known, "key", "left_anti").repartition(tasks, "key").dropDuplicates(["key"]).sortWithinPartitions("key")
    name, folder = f"leads_{run}", f"{ledger}/{delivery}"
    register_sink(spark, name, lambda options, overwrite: LeadSink(create, folder, delivery, run, batch))
    new.write.format(name).mode("append").save()
    return read_ledger(spark, ledger, delivery).filter((F.col("run") == run) & F.col("message").isNotNull()).select("key", "source_id", "name", "message")
