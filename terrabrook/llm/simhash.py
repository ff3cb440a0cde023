"""SimHash near-dedup: meet-in-the-middle ball hashing.

Two fingerprints within RADIUS bits have a common variant within RADIUS / 2 bits of both.  Every
fingerprint emits all variants within half the radius; a shuffle on variants brings partners
together.  All that share a variant lie within the radius of each other, so linking each to the
least one of its bucket keeps connectivity in linear space, and no pair within a group is listed.
A bucket is a ball, so it never holds more fingerprints than the ball has points (2,081 for 64
bits and radius 4), whatever the number of copies.

Equal fingerprints are one node.  Before the ball, fingerprints that can have no partner leave: of
2r blocks of bits, partners within r bits agree on r blocks at least, so they share a key, a choice
of r blocks.  Among the fingerprints of one key (half of the bits) the distance is checked, so that
chance partners, whose number grows with the square of the corpus, emit no ball.  Keys of more than
CHECKED fingerprints are passed on whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table
from .components import connected_components

BITS = 64
RADIUS = 4
WORDS = 4
#: Fingerprints of a key up to which distances are checked within it.
CHECKED = 64
UPPER_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, n: int = WORDS) -> int:
    """SimHash of the text's n-word shingles, repeats included; 0 without a word."""
    words = (text or "").encode().translate(UPPER_TO_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= n:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-n])).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, (ends[n - 1 :] - 1).tolist(), strict=True)), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


@F.pandas_udf(T.LongType())
def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Fingerprints as signed longs."""
    for texts in batches:
        yield pd.Series(np.array([fingerprint(x) for x in texts], np.uint64).view(np.int64))


def ball(bits: int, radius: int) -> np.ndarray:
    """All masks of at most radius bits, as signed longs."""
    masks = [sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(bits), k)]
    return np.array(masks, np.uint64).view(np.int64)


def emit_variants(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    masks = ball(BITS, radius)
    for batch in batches:
        found = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(found), 32):
            part = found[at : at + 32]
            yield pa.RecordBatch.from_arrays([pa.array((part[:, None] ^ masks[None, :]).ravel()), pa.array(np.repeat(part, len(masks)))], ["variant", "fp"])


def link_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each variant's bucket to its least fingerprint; a partition holds whole buckets."""
    parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
    if not parts:
        return
    variant, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order = np.argsort(variant, kind="stable")
    variant, fp = variant[order], fp[order]
    same = variant[1:] == variant[:-1]
    keep = np.concatenate((same, [False])) | np.concatenate(([False], same))
    variant, fp = variant[keep], fp[keep]
    if not len(fp):
        return
    first = np.concatenate(([True], variant[1:] != variant[:-1]))
    least = np.minimum.reduceat(fp, np.flatnonzero(first))
    links = np.unique(np.stack((fp, least[np.cumsum(first) - 1])), axis=1)
    links = links[:, links[0] != links[1]]
    yield pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], ["u", "v"])


def block_masks(radius: int) -> list[int]:
    """Masks of half of 2 * radius blocks: partners within the radius agree on one of them at least."""
    n = 2 * radius
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return np.array([sum(c) for c in combinations(blocks, n - radius)], np.uint64).view(np.int64).tolist()


def near_within_keys(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """side, key, fp in order of side and key -> the fp that have one of the same key within the radius.

    All of a key with more than CHECKED fingerprints count as near.  Holds a batch and the last
    CHECKED rows of the one before.
    """
    kept = None  # side, key, fp, near of the last rows
    for batch in batches:
        side, key, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        near = np.zeros(len(fp), bool)
        if kept is not None:
            side, key, fp, near = (np.concatenate(x) for x in zip(kept, (side, key, fp, near), strict=True))
        bits = fp.view(np.uint64)
        for step in range(1, CHECKED + 1):
            same = np.flatnonzero((key[step:] == key[:-step]) & (side[step:] == side[:-step])) if len(fp) > step else np.zeros(0, np.int64)
            if not len(same):
                break
            hit = same if step == CHECKED else same[np.bitwise_count(bits[same] ^ bits[same + step]) <= radius]
            near[hit] = near[hit + step] = True
            if step == CHECKED and len(hit):  # a key of more than CHECKED: all between its first and last
                cover = np.zeros(len(fp) + 1, np.int64)
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + step, -1)
                near |= np.cumsum(cover[:-1]) > 0
        done = max(0, len(fp) - CHECKED)
        found = np.unique(fp[:done][near[:done]])
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found)], ["fp"])
        kept = side[done:], key[done:], fp[done:], near[done:]
    if kept is not None and kept[3].any():
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(kept[2][kept[3]]))], ["fp"])


def with_partners(distinct: DataFrame, radius: int) -> DataFrame:
    """The rows of distinct (fp) that have another fingerprint within the radius, and perhaps some more."""
    masks = F.array(*[F.lit(m) for m in block_masks(radius)])
    keys = distinct.select("fp", F.posexplode(F.transform(masks, lambda m: F.col("fp").bitwiseAND(m))).alias("side", "key"))
    sorted_keys = keys.repartition("side", "key").sortWithinPartitions("side", "key").select("side", "key", "fp")
    return sorted_keys.mapInArrow(lambda b: near_within_keys(b, radius), "fp long").distinct()


def simhash_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u, v: links between distinct fingerprints (column fp) that keep the components at that radius."""
    spark = distinct.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    left = cut(with_partners(distinct.repartition(width), radius))
    emitted = left.repartition(width, "fp").mapInArrow(lambda b: emit_variants(b, radius // 2), "variant long, fp long")
    buckets = max(width, left.count() * len(ball(BITS, radius // 2)) // 1_500_000 + 1)
    return emitted.repartition(buckets, "variant").mapInArrow(link_buckets, "u long, v long")


def simhash_classes(docs: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """The rows of docs (doc_id, t, fp) and the classes of their fingerprints (fp, least, component).

    t is the text's xxhash64, fp a signed long, least the smallest doc_id with the fingerprint, and
    component the least fingerprint reachable.
    """
    marked = cut(docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), fingerprints("text").alias("fp")))
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    parts = connected_components(simhash_links(distinct.select("fp"), radius))
    classes = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    # cut: joins with it then have an exchange on either side, so that a large component can be split
    return marked, cut(classes)


def simhash_components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp (signed long), component_id for every row of docs.

    Null and empty texts have fingerprint zero and link like others.  Repeated rows have equal
    fingerprints and share a component.  A null doc_id gets a component too but never names one
    unless all of its members are null.  Where a doc_id repeats with other texts, two components may
    have one name; simhash_classes tells them apart.  Extra columns are not returned.
    """
    marked, classes = simhash_classes(docs, radius)
    named = cut(classes.groupBy("component").agg(F.min("least").alias("component_id")))
    members = classes.select("fp", "component").join(named, "component").select("fp", "component_id")
    return marked.join(members, "fp").select("doc_id", "fp", "component_id")


def surplus(docs: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, bool]:
    """(doc_id, t) of the rows that leave when one row of each component stays, and whether equal rows stay.

    The row that stays has the smallest doc_id (a null one is the largest), then the smallest t.
    The flag says that some (doc_id, t) that stays occurs more than once.
    """
    marked, classes = simhash_classes(docs, radius)
    rows = marked.groupBy("fp", "doc_id", "t").count().join(classes.select("fp", "component"), "fp")
    rows = cut(rows.select("component", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t").alias("row"), "count"))
    first = cut(rows.groupBy("component").agg(F.min("row").alias("first"), F.count("*").alias("rows")))
    gone = rows.join(first.filter("rows > 1"), "component").filter("row <> first").select("row.doc_id", "row.t")
    repeated = rows.filter("count > 1").join(first, "component").filter("row = first")
    return gone, not repeated.isEmpty()


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
