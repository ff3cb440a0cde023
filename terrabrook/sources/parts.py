"""Results of many jobs side by side: CSV parts named by job and number.

A write puts its files into a folder of its own, and then publishes, for each of its jobs, a manifest
that names the part's folder, columns, files and their sizes.  Readers read one job's manifests and
then only the files that these name: other jobs are neither listed nor read, and a write that failed
is never seen.  Writing a job's part again replaces that part alone.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import csv_rows

#: Texts come back as they were: quotes, line feeds and white space at the ends too.
CSV = {"header": True, "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def checked_id(job: str) -> str:
    """A job id that is safe in a path."""
    if not job or any(part in job for part in ("/", "\\", "..")):
        raise ValueError("invalid file name")
    return job


class Files:
    """The file system of a folder, as Spark's JVM knows it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.files = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.files.exists(self.path(path))

    def names(self, path: str) -> list[tuple[str, int]]:
        """Names and sizes of what is in a folder; nothing if it is missing."""
        return sorted((s.getPath().getName(), s.getLen()) for s in self.files.listStatus(self.path(path))) if self.exists(path) else []

    def read(self, path: str) -> str:
        with_bytes = self.files.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(with_bytes, "UTF-8")
        finally:
            with_bytes.close()

    def publish(self, path: str, text: str) -> None:
        """Writes beside the path and renames over it, so that readers see the old text or the new one."""
        beside, place = self.path(f"{path}.{uuid.uuid4().hex}"), self.path(path)
        out = self.files.create(beside, True)
        out.write(text.encode())
        out.close()
        hadoop = self.jvm.org.apache.hadoop.fs
        over = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        over[0] = hadoop.Options.Rename.OVERWRITE
        hadoop.FileContext.getFileContext(self.files.getUri(), self.files.getConf()).rename(self.files.makeQualified(beside), self.files.makeQualified(place), over)

    def delete(self, path: str) -> None:
        self.files.delete(self.path(path), True)


def manifest_folder(folder: str, job: str) -> str:
    return f"{folder}/_manifests/{checked_id(job)}"


def manifests(spark: SparkSession, folder: str, job: str) -> dict[int, dict]:
    """Part number -> its manifest."""
    files, place = Files(spark, folder), manifest_folder(folder, job)
    return {int(name.removesuffix(".json")): json.loads(files.read(f"{place}/{name}")) for name, _ in files.names(place) if name.endswith(".json")}


def write_parts(df: DataFrame, folder: str, job: str, part: int = 0) -> None:
    """Stores the rows of every job (the ids in column job) as its part of that number, in place of an earlier one.

    Ids must be safe in a path; a null or empty id fails the write before anything is published.
    Other parts and jobs stay as they are.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    rows, target = csv_rows(df), f"{folder}/data/{run}"
    named = F.when(F.col(f"`{job}`") != "", F.col(f"`{job}`")).otherwise(F.raise_error(F.lit("a row has no job id")))
    rows.withColumn(job, named).write.partitionBy(job).options(**CSV).csv(target)
    files = Files(spark, folder)
    columns = [c for c in df.columns if c != job]
    found = [(unquote(name.removeprefix(f"{job}=")), name) for name, _ in files.names(target) if name.startswith(f"{job}=")]
    for id_, _ in found:
        checked_id(id_)
    for id_, name in found:  # a step for each job of this write
        before = manifests(spark, folder, id_).get(part)
        data = [[n, size] for n, size in files.names(f"{target}/{name}") if n.endswith(".csv")]
        place = manifest_folder(folder, id_)
        files.files.mkdirs(files.path(place))
        files.publish(f"{place}/{part}.json", json.dumps({"folder": f"data/{run}/{name}", "columns": columns, "files": data}))
        if before:
            files.delete(f"{folder}/{before['folder']}")


def read_parts(spark: SparkSession, folder: str, job: str, parts: list[int] | None = None) -> DataFrame:
    """The rows of one job's parts (all, or those numbers) as text columns, with part; FileNotFoundError without any."""
    known = {n: m for n, m in manifests(spark, folder, job).items() if parts is None or n in parts}
    if not known:
        raise FileNotFoundError(f"no result of job {job}")
    out = None
    for n, m in sorted(known.items()):
        paths = [f"{folder}/{m['folder']}/{name}" for name, _ in m["files"]]
        schema = ", ".join(f"`{c}` string" for c in m["columns"])
        reader = spark.read.schema(schema).options(**CSV, multiLine=True, emptyValue="")
        rows = reader.csv(paths) if paths else spark.createDataFrame([], schema)
        rows = rows.na.fill("").withColumn("part", F.lit(n))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def delete_parts(spark: SparkSession, folder: str, job: str) -> None:
    """Removes all parts of one job."""
    files = Files(spark, folder)
    for m in manifests(spark, folder, job).values():
        files.delete(f"{folder}/{m['folder']}")
    files.delete(manifest_folder(folder, job))
