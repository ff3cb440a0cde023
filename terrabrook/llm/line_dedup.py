"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble by position.

DataFrame functions only.  What is exploded, counted and joined by hash is a 128-bit hash and a
position per line; the texts move once, split into lines, to meet the list of positions they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, cut, stash, table

WHITE = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Returns row (struct: the input's columns), n_lines, n_dropped, kept (the text left).

    A line is dropped if its key has at least min_chars code points, at least min_docs distinct
    doc_ids hold it, and the document isn't the one with the largest doc_id among them.  A null
    text is one empty line.  A null doc_id doesn't count as a document and loses no line.  Rows
    that repeat a doc_id count once; each keeps its own result.  Extra columns only travel in row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
        F.col("doc_id").alias("d"),
        F.xxhash64(text).alias("t"),
        F.split(text, "\n").alias("lines"),
    )
    # stored once: lines are split and hashed for both the count and the drop
    exploded = stash(
        docs.filter(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("d"), F.xxhash64(text).alias("t"), F.posexplode(F.split(text, "\n")).alias("p", "line"))
        .select("d", "t", "p", line_key(F.col("line")).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("d", "t", "p", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g")),
        "lines",
    )
    # cut: the join below then has an exchange on either side, so that a hot line's rows can be split
    common = cut(
        exploded.groupBy("h", "g")
        .agg(F.count_distinct("d").alias("n"), F.max("d").alias("last"))
        .filter(F.col("n") >= min_docs)
        .select("h", "g", "last")
    )
    dropped = (
        exploded.join(common, ["h", "g"])
        .filter(F.col("d") != F.col("last"))
        .groupBy("d", "t")
        .agg(F.collect_set("p").alias("gone"))
    )
    found = base.join(dropped, ["d", "t"], "left")
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    return found.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n").alias("kept"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS p
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.doc_id, k.p, k.line, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM k LEFT JOIN c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
