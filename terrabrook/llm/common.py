"""What the corpus operators share."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir.

    Where that is unset a temporary one is made on a local master (tests, one machine); on a cluster
    it is an error, since the driver's disk is not the executors'.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp("-checkpoints"))
    return context.getCheckpointDir()


#: The folders that stash() made in the open stored_for() of this thread; None outside of one.
OWNED: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("owned", default=None)


def stash(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again; readers fetch only the columns they need.

    The folder stays, for what is returned is read later, unless stored_for() is open around the call.
    """
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if (owned := OWNED.get()) is not None:
        owned.append(folder)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


@contextlib.contextmanager
def stored_for(spark: SparkSession) -> Iterator[None]:
    """For a run that writes its result inside: what stash() stored there is deleted at the end.

    Folders of other runs, before, after or in other threads, stay.
    """
    owned: list[str] = []
    token = OWNED.set(owned)
    try:
        yield
    finally:
        OWNED.reset(token)
        for folder in owned:
            delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared checkpoint folder so that lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_and_free(df: DataFrame) -> DataFrame:
    """cut, after which the shuffle files that led to df are given back.

    Spark removes them when the driver's garbage collector finds their plan unused, which on its own
    may be long after.  For plans that shuffle several times the input.
    """
    out = cut(df)
    del df
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(col, UPPER, LOWER)

