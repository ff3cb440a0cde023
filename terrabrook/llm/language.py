"""Language ID: blended-spectrum string kernel, Nyström landmarks, one-versus-rest kernel ridge.

A text is the set of its character n-grams, n from 1 to MAX_N, over the lower-cased text, each at
one of DIM places of a presence vector (a fixed hash).  The kernel of two texts is the number of
places they share, over the root of the product of their numbers of places.  LANDMARKS texts of
each language span the Nyström space; ridge regression there gives one weight vector per language.
Whole texts are scored in batches: presence matrix x landmark matrix, then x coefficients.

Learning sees at most PER_LANGUAGE rows of each of the LANGUAGES languages with most rows, drawn by a
hash of their text, and at most ROWS in all, whatever the size of the table; all rows are scored.
Places are shared: a very long text fills a good part of DIM, and so the kernel also counts chance
meetings, the same for all languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, table

MAX_N = 4
DIM_BITS = 15
DIM = 1 << DIM_BITS
PER_LANGUAGE = 300
LANDMARKS = 32
RIDGE = 1e-2
#: Bounds of the whole sample: the languages with most rows, their rows and landmarks together.
LANGUAGES = 500
ROWS = 20_000
MARKS = 2048
BATCH = 64
BLOCK = 256
UNKNOWN = "und"
LETTER = r"\p{L}"


def places(text: str) -> np.ndarray:
    """Places of the text's n-grams, with repeats."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    found, h = [], np.zeros(len(chars), np.uint64)
    for n in range(1, MAX_N + 1):
        if len(chars) < n:
            break
        h = h[: len(chars) - n + 1] * np.uint64(0x100000001B3) + chars[n - 1 :] + np.uint64(n)
        found.append((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - DIM_BITS))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def presence(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), DIM), np.float32)
    for row, text in zip(out, texts, strict=True):
        row[places(text)] = 1
    return out


class Model:
    """languages, landmarks (packed presence vectors and their sizes) and coefficients (landmarks x languages).

    What travels to the workers is a bit for each place of each landmark, at most MARKS * DIM bits;
    workers unpack BLOCK landmarks at a time, and keep them if they are all.
    """

    def __init__(self, bits: np.ndarray, labels: list[str]):
        """bits: presence vectors, packed, one per row; labels: their languages."""
        self.languages = sorted(set(labels))
        label = np.array(labels)
        per = max(1, min(LANDMARKS, MARKS // len(self.languages)))
        marks = np.concatenate([np.flatnonzero(label == x)[:per] for x in self.languages])
        size = np.sqrt(np.maximum(np.bitwise_count(bits).sum(axis=1, dtype=np.int64), 1))
        self.bits, self.size = bits[marks], size[marks].astype(np.float32)
        kernel = np.concatenate([self.kernel(np.unpackbits(bits[i : i + BATCH], axis=1).astype(np.float32)) for i in range(0, len(bits), BATCH)])
        values, vectors = np.linalg.eigh(kernel[marks].astype(np.float64))
        good = values > 1e-6 * values[-1]
        root = vectors[:, good] / np.sqrt(values[good])
        space = np.column_stack((kernel @ root, np.ones(len(bits))))
        target = np.where(label[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        weights = np.linalg.solve(space.T @ space + RIDGE * len(bits) * np.diag([*np.ones(root.shape[1]), 0]) / len(self.languages) ** 2, space.T @ target)
        self.coefficients, self.bias = (root @ weights[:-1]).astype(np.float32), weights[-1].astype(np.float32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "unpacked"}

    def landmarks(self) -> Iterator[np.ndarray]:
        """Matrices of DIM x at most BLOCK landmarks, each over its size."""
        if "unpacked" in self.__dict__:
            yield self.unpacked
            return
        for at in range(0, len(self.bits), BLOCK):
            block = np.ascontiguousarray((np.unpackbits(self.bits[at : at + BLOCK], axis=1) / self.size[at : at + BLOCK, None]).T.astype(np.float32))
            if len(self.bits) <= BLOCK:
                self.unpacked = block
            yield block

    def kernel(self, presences: np.ndarray) -> np.ndarray:
        return np.concatenate([presences @ block for block in self.landmarks()], axis=1) / np.sqrt(np.maximum(presences.sum(axis=1), 1))[:, None]

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.kernel(presence(texts)) @ self.coefficients + self.bias


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [np.packbits(presence([t])[0].astype(bool)).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["lang", "bits"])


def learn(rows: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from rows with text and lang; None if no row has both and a letter.

    The driver gets at most per_language vectors of DIM bits for each language, ROWS in all.
    """
    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(LETTER)).select("lang", "text", F.xxhash64("text").alias("h"))
    counts = cut(usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES))
    per_language = max(1, min(per_language, ROWS // max(1, counts.count())))
    # a uniform draw of about three times the bound leaves little to rank, also for a hot language
    share = F.least(F.lit(1.0), F.lit(3.0 * per_language) / F.col("n"))
    drawn = usable.join(F.broadcast(counts), "lang").filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
    ranked = drawn.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).filter(F.col("r") <= per_language)
    found = sorted((r.lang, bytes(r.bits)) for r in ranked.select("lang", "text").mapInArrow(packed, "lang string, bits binary").collect())
    if not found:
        return None
    order = np.random.default_rng(0).permutation(len(found))
    bits = np.stack([np.frombuffer(found[i][1], np.uint8) for i in order])
    return Model(bits, [found[i][0] for i in order])


def predictor(model: Model | None):
    result = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(result)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for at in range(0, len(texts), BATCH):
                part = [x or "" for x in texts.iloc[at : at + BATCH]]
                known = [any(c.isalpha() for c in x) for x in part]
                if model is None:
                    out += [(UNKNOWN, 0.0)] * len(part)
                    continue
                s = model.scores(part)
                best = s.argmax(axis=1)
                out += [(model.languages[b], round(float(min(1.0, max(0.0, (v[b] + 1) / 2))), 4)) if k else (UNKNOWN, 0.0) for b, v, k in zip(best, s, known, strict=True)]
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return predict


def identify_languages(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score for every row of docs, learnt from training (text, lang).

    A null text, or one without a letter, is UNKNOWN with score 0, and so is every text if nothing
    could be learnt.  Equal texts get equal predictions.  Extra columns are not returned.
    """
    predict = predictor(learn(training))
    return docs.select("doc_id", predict("text").alias("p")).select("doc_id", "p.lang_pred", "p.score")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    found = identify_languages(docs, docs.filter(~held).select("text", "lang"))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
