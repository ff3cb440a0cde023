"""Vector code compression: product codes whose nearest entries come from vantage-point trees.

Vectors are cut into PARTS equal parts; a part's code is the index of the nearest of its position's
ENTRIES codebook entries.  Per position a vantage-point tree over the entries is searched by branch
and bound for a whole Arrow batch at once.  Distances are exact integers; only the bounds that prune
are floating, rounded so that they never exclude a nearest entry, and a branch whose bound equals the
best distance is still visited, so ties go to the lower index.

A round reads the table once; what leaves a task are sums per part, entry and place in the part, so
the codebooks (bounded by ENTRIES times the dimension) are all that the driver ever holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, stash, table
from .vectors import dimension, finite_rows, scaled

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LEAF = 8
#: Labels up to which their sums are broadcast.
BROADCAST_ROWS = 100_000
#: Integers that one step of a search holds at once.
CELLS = 1 << 20
#: Relative margin of a bound, some times the rounding of a root and a difference.
MARGIN = 2.0**-48


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(-1)


@dataclass
class Node:
    """A leaf holds entries; an inner node a vantage entry and two branches with their least and most distance from it."""

    entries: np.ndarray
    branches: tuple[tuple[Node, float, float], ...] = ()


class VantageTree:
    """Nearest entry by exact squared distance, ties to the lower index, for many points at once."""

    def __init__(self, entries: np.ndarray, leaf: int = LEAF):
        self.entries, self.leaf = entries, leaf
        self.root = self.build(np.arange(len(entries)))

    def build(self, members: np.ndarray) -> Node:
        if len(members) <= self.leaf:
            return Node(members)
        vantage, rest = members[:1], members[1:]
        distances = squared(self.entries[rest], self.entries[vantage])
        order = np.sort(distances)
        inside = distances <= order[(len(order) - 1) // 2]
        branches = []
        for chosen in (inside, ~inside):
            if chosen.any():
                least, most = (np.sqrt(float(f(distances[chosen]))) for f in (np.min, np.max))
                branches.append((self.build(rest[chosen]), least * (1 - MARGIN), most * (1 + MARGIN)))
        return Node(vantage, tuple(branches))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry."""
        found, best = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
        step = max(1, CELLS // (self.leaf * max(1, points.shape[1])))
        for at in range(0, len(points), step):
            part = slice(at, at + step)
            self.visit(self.root, points[part], np.arange(len(points[part])), found[part], best[part])
        return found, best

    def visit(self, node: Node, points: np.ndarray, rows: np.ndarray, found: np.ndarray, best: np.ndarray) -> None:
        distances = squared(points[rows][:, None, :], self.entries[node.entries][None, :, :])
        first = distances.argmin(1)
        least, index = distances[np.arange(len(rows)), first], node.entries[first]
        better = (least < best[rows]) | ((least == best[rows]) & (index < found[rows]))
        best[rows[better]], found[rows[better]] = least[better], index[better]
        if not node.branches:
            return
        away = np.sqrt(distances[:, 0].astype(np.float64))
        bounds = np.array([np.maximum(away * (1 - MARGIN) - most, low - away * (1 + MARGIN)) for _, low, most in node.branches])
        bounds *= 1 - MARGIN
        nearer = bounds.argmin(0)
        for turn in range(len(node.branches)):  # the nearer branch first, so that the other is more often left out
            for side, (branch, _, _) in enumerate(node.branches):
                reach = np.sqrt(best[rows].astype(np.float64)) * (1 + MARGIN)
                go = ((nearer == side) == (turn == 0)) & (bounds[side] <= reach)
                if go.any():
                    self.visit(branch, points, rows[go], found, best)


def assigned(x: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows by parts) and error (per row) of vectors under codebooks (parts by entries by width)."""
    parts, _, width = codebooks.shape
    codes, error = np.empty((len(x), parts), np.int64), np.zeros(len(x), np.int64)
    for p in range(parts):
        codes[:, p], distances = VantageTree(codebooks[p]).nearest(x[:, p * width : (p + 1) * width])
        error += distances
    return codes, error


def within_range(x: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
    """x, or an error if a squared distance could leave 64 bits."""
    reach = int(max(np.abs(x).max(initial=0), np.abs(codebooks).max(initial=0))) * 2
    if reach * reach * codebooks.shape[0] * codebooks.shape[2] >= 1 << 63:
        raise ValueError("entries are too large for exact 64-bit distances")
    return x


def sums(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per part, entry and place in the part: how many parts of this task were assigned, and their sum."""
    parts, entries, width = codebooks.shape
    n, total = np.zeros((parts, entries), np.int64), np.zeros(codebooks.shape, np.int64)
    for batch in batches:
        x = within_range(scaled(batch.column(0), SCALE, parts * width), codebooks)
        codes, _ = assigned(x, codebooks)
        for p in range(parts):
            n[p] += np.bincount(codes[:, p], minlength=entries)
            np.add.at(total[p], codes[:, p], x[:, p * width : (p + 1) * width])
    part, entry, place = np.nonzero(np.repeat(n[:, :, None], width, 2))
    columns = [part, entry, place, n[part, entry], total[part, entry, place]]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "n", "total"])


def first_entries(rows: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """The starting codebooks: the parts of the rows with the smallest vec_ids, equal ids by their vectors, null ids last."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    x = scaled(pa.array([r.embedding for r in first], pa.list_(pa.float64())), SCALE, parts * width)
    return np.ascontiguousarray(x.reshape(len(x), parts, width).swapaxes(0, 1))


def fit_codebooks(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """parts by entries by width: each round assigns all rows and moves entries to the floor of their parts' mean."""
    codebooks = first_entries(rows, parts, entries, width)
    for _ in range(rounds):
        moved = codebooks.copy()
        current = codebooks
        found = rows.select("embedding").mapInArrow(lambda b, c=current: sums(b, c), "part long, entry long, place long, n long, total long")
        for r in found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            moved[r.part, r.entry, r.place] = r.total // r.n
        codebooks = moved
    return codebooks


def encode(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """vec_id, label, embedding -> vec_id, label, code, error."""
    parts, _, width = codebooks.shape
    for batch in batches:
        codes, error = assigned(within_range(scaled(batch.column(2), SCALE, parts * width), codebooks), codebooks)
        code = [bytes(row).hex() for row in codes.astype(np.uint8)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])


def fingerprint(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, code, error) of the usable vectors, and the codebooks (parts by entries by width).

    entries is at most 256, as a code has two hex digits a part.  Rows whose vector is null, empty, or
    holds null or non-finite entries have no result, and without a usable row there are no codebooks.
    Vectors of different lengths, or of one that parts doesn't divide, are an error, and so are entries
    too large for exact 64-bit sums.  Repeated rows each have a result and each count.  With fewer
    usable rows than entries there are that many entries.  Null ids start no codebook while others do.
    Extra columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    rows = finite_rows(embeddings.select("vec_id", "label", "embedding"))
    size = dimension(rows)
    if size % parts:
        raise ValueError(f"{size} entries can't be cut into {parts} equal parts")
    kinds = ", ".join(f"{c} {embeddings.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    schema = f"{kinds}, code string, error long"
    if not size:
        return embeddings.sparkSession.createDataFrame([], schema), None
    codebooks = fit_codebooks(rows, size // parts, parts, entries, rounds)
    return rows.mapInArrow(lambda b: encode(b, codebooks), schema), codebooks


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = compress(table(spark, sf_dir, "embeddings"))
    coded = stash(coded, "codes")
    # cut: a join of two shuffled sides can split a hot label
    by_label = cut(coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")))
    by_label = F.broadcast(by_label) if by_label.count() <= BROADCAST_ROWS else by_label
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("l")))
    digest = F.lit(None if codebooks is None else fingerprint(codebooks)).cast("string")
    return joined.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL: every part against all entries of its codebook; a distance and an index make one number."""
    steps = [
        """kept AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cells AS (SELECT vec_id, label, (i // w)::INT AS part, (i % w)::INT AS place, floor({SCALE} * c::DOUBLE) AS x FROM (
          SELECT vec_id, label, len(embedding) // {parts} AS w, unnest(embedding) AS c, unnest(range(len(embedding))) AS i FROM kept))""",
        "vectors AS MATERIALIZED (SELECT vec_id, label, part, list(x ORDER BY place) AS v FROM cells GROUP BY ALL)",
        f"""ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries})""",
        "book0 AS MATERIALIZED (SELECT part, entry, v AS e FROM vectors JOIN ids USING (vec_id))",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (SELECT vec_id, label, part, v, min(
              (list_inner_product(v, v) - 2 * list_inner_product(v, e) + list_inner_product(e, e))::BIGINT * {entries} + entry) AS found
              FROM vectors JOIN book{k} USING (part) GROUP BY ALL)"""
        )
        if k < rounds:
            steps.append(
                f"""mean{k} AS (SELECT part, entry, list(x ORDER BY place) AS m FROM (
                  SELECT part, found % {entries} AS entry, place, floor(sum(x) / count(*)) AS x FROM (
                    SELECT part, found, unnest(v) AS x, unnest(range(len(v))) AS place FROM near{k}) GROUP BY ALL) GROUP BY ALL)"""
            )
            steps.append(f"book{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m, e) AS e FROM book{k} LEFT JOIN mean{k} USING (part, entry))")
    steps += [
        f"""coded AS (SELECT vec_id, label, string_agg(printf('%02x', found % {entries}), '' ORDER BY part) AS code, sum(found // {entries})::BIGINT AS error
          FROM near{rounds} GROUP BY ALL)""",
        "digest AS (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book" + str(rounds) + ")",
    ]
    body = ",\n".join(steps)
    return f"WITH {body}\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest"


OP11_SQL = oracle()
