"""Best-fit packing: best-fit decreasing with a segment tree over remaining capacities.

Pieces of one length are interchangeable, and so are bins with one remaining capacity.  So the
global best-fit-decreasing run needs only how many pieces there are of each length (at most
CAPACITY numbers), and answers with ranges: pieces number a to b of length l go to bins c onward,
q to a bin.  The driver holds these ranges and nothing per document; executors look their pieces
up by length and number.  The number of a piece is its number within its task plus the count of
that length in the tasks before, so no length's pieces ever meet in one place.
"""

from __future__ import annotations

import base64
import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stash, table

CAPACITY = 2048
END = 0
PIECES = "doc_id long, piece int, start long, length long, ids binary, task int, number long"


class CapacityTree:
    """Segment tree over remaining capacities: which of them have an open bin."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, remaining: int, is_open: bool) -> None:
        i = self.size + remaining
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least need with an open bin."""
        i = self.size + need
        while not self.open[i]:
            while i & 1:
                i //= 2
            if not i:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Ranges (length, first number, first bin, pieces per bin, offset in the bin), in order of number.

    Equal, piece by piece, to best-fit decreasing over all pieces: a bin that is the tightest stays
    the tightest until it can't take another piece of the length.
    """
    tree, bins, ranges, fresh = CapacityTree(capacity), defaultdict(list), [], 0

    def put(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            bins[remaining].append((first, n))
            tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        number, left = 0, counts[length]
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                n = -(-left // (capacity // length))
                put(capacity, fresh, n)
                fresh += n
                remaining = capacity
            first, n = bins[remaining].pop()
            if not bins[remaining]:
                tree.set(remaining, False)
            per = min(remaining // length, left)
            used = min(n, left // per)
            ranges.append((length, number, first, per, capacity - remaining))
            put(remaining - per * length, first, used)
            put(remaining, first + used, n - used)
            number += per * used
            left -= per * used
    return ranges


def special_tokens(tokenizer_path: str) -> dict[str, int]:
    """The special marks of a tokenizers file and their ids: the library cuts a text at them first."""
    with open(tokenizer_path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file).get("added_tokens", []) if t["special"]}


def load_encoding(ranks_path: str, special: dict[str, int]):
    """The byte-level BPE of a rank file, with special marks.

    Its ids equal those of the same vocabulary's tokenizers file (tests hold this), at several
    times the speed.
    """
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def ids_of(encoding, text: str) -> np.ndarray:
    return encoding.encode_to_numpy(text, allowed_special="all").astype("<u4")


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_pieces(batches: Iterator[pa.RecordBatch], ranks_path: str, special: dict[str, int], capacity: int) -> Iterator[pa.RecordBatch]:
    """Tokenises doc_id, text into pieces, numbered within the task by length."""
    encoding = load_encoding(ranks_path, special)
    task = TaskContext.get().partitionId()
    numbers = [0] * (capacity + 1)
    end = np.array([END], "<u4")
    names = ["doc_id", "piece", "start", "length", "ids", "task", "number"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.concatenate((ids_of(encoding, text.as_py() or ""), end))
            head = len(ids) % capacity or min(len(ids), capacity)
            bounds = [0, *range(head, len(ids) + 1, capacity)]
            for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                rows.append((doc_id, piece, a, b - a, ids[a:b].tobytes(), task, numbers[b - a]))
                numbers[b - a] += 1
                size += b - a
            if size > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def place(batches: Iterator[pa.RecordBatch], ranges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Adds sequence_id and offset to rows that end in length and the piece's number among its length.

    ranges: rows of best_fit_decreasing, sorted by (length, first number).
    """
    starts = ranges[:, 0] * (1 << 44) + ranges[:, 1]
    for batch in batches:
        *rest, number = batch.columns
        length, number = batch.column("length").to_numpy(), number.to_numpy()
        at = np.searchsorted(starts, length * (1 << 44) + number, "right") - 1
        nth = number - ranges[at, 1]
        sequence = ranges[at, 2] + nth // ranges[at, 3]
        offset = ranges[at, 4] + nth % ranges[at, 3] * length
        yield pa.RecordBatch.from_arrays([*rest, pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None, tokenizer_path: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and (with_ids) ids for all pieces.

    ids are little-endian unsigned 32-bit token ids; each document ends in id 0.  A null text is
    empty: one piece of length 1.  A document longer than the capacity is cut into pieces of the
    capacity, of which the first may be shorter.  Rows that repeat a doc_id, or have none, are
    documents of their own.  Extra columns are not returned.  ids_crc32 is taken from the stored
    ids.  tokenizer_path names the tokenizers file whose special marks become their ids, also inside
    texts; ranks_path holds the same vocabulary's ranks.
    """
    ranks_path = ranks_path or public_file("byte_bpe_50k.tiktoken")
    special = special_tokens(tokenizer_path or public_file("byte_bpe_50k.json"))
    pieces = stash(docs.select("doc_id", "text").mapInArrow(lambda b: cut_pieces(b, ranks_path, special, capacity), PIECES), "pieces")
    counts = pieces.groupBy("task", "length").agg((F.max("number") + 1).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).select("task", "length", "before")
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    ranges = np.array(sorted(best_fit_decreasing(total, capacity)), np.int64).reshape(-1, 5)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"][: int(with_ids)]]
    numbered = (
        pieces.withColumn("ids_crc32", F.crc32("ids"))
        .join(before, ["task", "length"])
        .select(*columns, (F.col("number") + F.col("before")).alias("number"))
    )
    schema = f"doc_id long, piece int, start long, length long, ids_crc32 long, {'ids binary, ' * with_ids}sequence_id long, offset long"
    return numbered.mapInArrow(lambda b: place(b, ranges), schema)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), with_ids=False)
