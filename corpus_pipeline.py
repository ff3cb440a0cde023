"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, decontamination, packing.

Every stage but the last takes and returns rows with the columns of documents (and any more that
the input has).  Stages are written as Parquet and read again, so each works on all that its
predecessor kept and none is computed twice.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrabrook.llm.common import cut, delete_folder, shared_folder, stored_for, table
from terrabrook.llm.decontaminate import contaminated
from terrabrook.llm.line_dedup import dedup_lines
from terrabrook.llm.packing import pack_documents
from terrabrook.llm.quality import filter_quality
from terrabrook.llm.simhash import surplus

BROADCAST_ROWS = 100_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return filter_quality(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that line dedup drops; n_chars follows the text."""
    kept = dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a struct of doc_id and the text's hash (structs of null are equal), and its name."""
    key = next(name for k in itertools.count() if (name := f"_text_{k}") not in docs.columns)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn(key, F.struct("doc_id", F.xxhash64(text).alias("t"))), key


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """docs but for the keys in gone (doc_id, t); these are broadcast up to BROADCAST_ROWS, and shuffled beyond."""
    gone = cut(gone.select(F.struct("doc_id", "t").alias(key)).distinct())
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, [key], "left_anti")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: that with the smallest doc_id, a null one counting as the largest.

    Rows that share a doc_id but not a text are documents of their own; of equal rows one stays.
    """
    marked, key = keyed(docs)
    gone, repeated = surplus(docs)
    left = without(marked, gone, key)
    return (left.dropDuplicates([key]) if repeated else left).drop(key)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found, also those without a doc_id."""
    marked, key = keyed(docs)
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "t")
    return without(marked, found, key).drop(key)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    return pack_documents(docs, with_ids=False)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Fingerprints, templates and token ids have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir.

    What a stage's operator stored is deleted once the stage has written, and a stage's rows once the
    next has; the last stage's rows stay, since the result reads them.  Other results' files stay.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        with stored_for(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            delete_folder(spark, f"{folder}/{k - 1}")
    return docs
