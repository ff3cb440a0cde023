"""Embedding whitening: Spark MLlib computeSVD on centred distributed rows.

An entry becomes x = floor(SCALE * c) + SHIFT.  With the column sums S of all n rows, n x - S is an
exact integer; divided by n it is the centred row that RowMatrix.computeSVD takes.  Its right singular
vectors are the components, its singular values s give the eigenvalues s^2 / n.  computeSVD gives
values only for the components asked for, so the total variance comes separately, from the exact
deviations of all rows.  The driver holds S, the components and their covariance: squares of the
dimension, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash, table
from .vectors import dimension, finite_rows, scaled

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Singular values under this part of the largest are rounding: no component.
LEAST = 1e-6


def column_sums(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    n, total = 0, np.zeros(size, np.int64)
    for batch in batches:
        x = scaled(batch.column(0), SCALE, size) + SHIFT
        n += len(x)
        total += x.sum(0)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(total)], ["place", "n", "total"])


def lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())


def deviations(column: pa.Array, n: int, total: np.ndarray) -> np.ndarray:
    """n x - S of a batch, exact; an error if the squares' sum could leave 64 bits."""
    x = scaled(column, SCALE, len(total)) + SHIFT
    around = total // n
    if int(np.abs(x - around).max(initial=0) + 1) ** 2 * n * n * len(total) >= 1 << 63:
        raise ValueError("deviations don't fit into 64 bits")
    return n * (x - around) - (total - n * around)


def centred(batches: Iterator[pa.RecordBatch], n: int, total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """vec_id, embedding -> vec_id, deviation, and the centred row in doubles."""
    for batch in batches:
        d = deviations(batch.column(1), n, total)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((d * d).sum(1)), lists(d / n)], ["vec_id", "deviation", "row"])


def projected(batches: Iterator[pa.RecordBatch], components: np.ndarray) -> Iterator[pa.RecordBatch]:
    """vec_id, deviation, row -> vec_id, deviation, whitened: the row on each component (a column each)."""
    for batch in batches:
        rows = batch.column(2).flatten().to_numpy().reshape(-1, len(components))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(rows @ components)], ["vec_id", "deviation", "whitened"])


def row_matrix(rows: DataFrame, column: str) -> RowMatrix:
    """A distributed matrix of an array column; the rows stay in the JVM."""
    vectors = rows.select(array_to_vector(F.col(column)).alias("v"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"))


def identity_error(rows: DataFrame, n: int, size: int) -> float:
    """The largest absolute entry of the covariance of whitened, less the identity; centred before multiplying."""
    means = rows.select(F.posexplode("whitened").alias("place", "w")).groupBy("place").agg(F.avg("w").alias("m")).collect()  # a row each component
    mean = np.zeros(size)
    for r in means:
        mean[r.place] = r.m
    less = F.array(*[F.lit(float(m)) for m in mean])
    around = rows.select(F.zip_with("whitened", less, lambda w, m: w - m).alias("row"))
    gram = row_matrix(around, "row").computeGramianMatrix().toArray()
    return float(np.abs(gram / n - np.eye(size)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, whitened (array), explained (array), identity_error of every usable row.

    Up to components entries a row, by falling eigenvalue.  Eigenvalues that are zero but for rounding
    (of repeated rows, or fewer rows than dimensions) have no component, so a lone or only equal rows
    give no result.  Rows whose vector is null, empty, or holds null or non-finite entries have none
    and count nowhere; repeated rows each count.  Vectors of different lengths are an error, and so are
    entries too large for exact 64-bit deviations.  Null ids are kept; extra columns are not read.
    """
    rows = finite_rows(embeddings.select("vec_id", "embedding"))
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    empty = f"vec_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    size = dimension(rows)
    if size:
        found = rows.select("embedding").mapInArrow(lambda b: column_sums(b, size), "place long, n long, total long").groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        n, total = found[0].n, np.array([r.total for r in sorted(found, key=lambda r: r.place)], np.int64)
        # stored: the decomposition and the projection both read the centred rows
        around = stash(rows.mapInArrow(lambda b: centred(b, n, total), f"vec_id {kind}, deviation long, row array<double>"), "centred")
        variance = float(around.agg(F.sum(F.col("deviation").cast("decimal(38,0)"))).first()[0]) / n**3
    if not size or not variance:
        return embeddings.sparkSession.createDataFrame([], empty)
    svd = row_matrix(around, "row").computeSVD(min(components, size), computeU=False, rCond=LEAST)
    eigenvalues = svd.s.toArray() ** 2 / n
    vectors = svd.V.toArray() / np.sqrt(eigenvalues)
    white = stash(around.mapInArrow(lambda b: projected(b, vectors), f"vec_id {kind}, deviation long, whitened array<double>"), "whitened")
    explained = F.array(*[F.lit(float(e)) for e in eigenvalues / variance])
    return white.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(identity_error(white, n, len(eigenvalues))).alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each vector and component."""
    white = whiten(table(spark, sf_dir, "embeddings"))
    cells = white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("place", "whitened"))
    return cells.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("place")).alias("explained"), "identity_error")
