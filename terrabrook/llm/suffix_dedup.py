"""Suffix-array dedup with a logarithmic index family.

Removes every byte covered by a LENGTH-byte string that also starts in a document with a smaller
doc_id.  What the index holds:

* The starts of all LENGTH-byte windows of a document fall into runs: consecutive windows with one
  least hashed K-byte substring, the run's key.  Equal windows have equal keys.  A run is one suffix
  of the (sparse) array, ordered by key and the hash of the run's bytes; there are about 2 of them
  for LENGTH - K bytes.
* A batch of documents gets its array; equal runs in the batch leave it at once: all but the
  smallest document's are covered.  Arrays are dealt out by key.
* For a share of the keys, new arrays are merge-scanned against the levels of a LevelFamily, where
  again the larger document's run is covered and leaves; levels of similar size merge, so every
  entry moves a logarithmic number of times.
* Runs that share a key with another document and are not equal may still share some windows, at the
  ends of repeated passages for instance.  The bytes of such runs travel, dealt by their key, and
  their windows are settled there: sorted by hash, and compared byte by byte.
* A key with more than HOT unequal runs in one batch, or more than HOT_GROUP in a level (a passage
  that very many documents hold, each in its own context) leaves a mark in the index; the windows of
  its runs are dealt one by one, by their own hash.

So a string in a third of all documents costs an entry per batch, no key's runs gather in a task,
and a document's matches don't depend on how documents are batched.  Equal runs are told by 104 bits
of hash, the windows of hot keys by 128, all others by their bytes.  Blobs are arrays in byte planes,
compressed.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, cut_and_free, table

LENGTH = 50
K = 20
#: Entries of a batch's array, unequal runs of a key in it, and in a level, from which the key is hot.
BATCH = 300_000
HOT = 32
HOT_GROUP = 4096
#: Bytes of text of one group of documents; entries of one task's levels, and windows one task settles, on average.
GROUP_BYTES = 8 << 20
SHARE = 1_500_000
SETTLED = 1_000_000
#: Bytes of runs that are hashed, and window pairs that are compared, at once.
SLICE = 1 << 19
COMPARED = 1 << 16
FINE = 1 << 24
LEAST_SHARES = 32
#: Shares of windows for each share of keys.
WINDOW_SHARES = 4

#: t numbers the texts of one doc_id. A run with no windows is a hot key's mark.
RUN = np.dtype([("key", "<u8"), ("id", "<u8"), ("doc", "<i8"), ("t", "<u4"), ("at", "<u4"), ("n", "u1")])
PLACE = np.dtype([("doc", "<i8"), ("t", "<u4"), ("at", "<u4"), ("n", "<u4")])
#: A run whose windows are to be settled among those of the same fine share of keys.
ASK = np.dtype([("doc", "<i8"), ("t", "<u4"), ("at", "<u4"), ("n", "u1"), ("fine", "<u4")])
SPOT = np.dtype([("id", "<u8"), ("more", "<u8"), ("doc", "<i8"), ("t", "<u4"), ("at", "<u4")])
KEY_BITS, ID_BITS = 48, 56
#: What a blob holds: PLACE rows; ASK rows; those of hot keys; RUN rows; ASK rows with the runs' bytes; SPOT rows.
COVERED, ASKED, SPOTTED, ENTRY, TEXT, WINDOW = range(6)
BLOBS = "kind int, bucket int, windows long, blob binary"
BLOB_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("windows", pa.int64()), ("blob", pa.binary())])


def free_memory() -> None:
    """Gives memory that is free in this process back; Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def encode(rows: np.ndarray) -> bytes:
    """The rows' fields in byte planes, compressed; the first field as differences, doc from its least."""
    parts = [len(rows).to_bytes(8, "little"), int(rows["doc"].min()).to_bytes(8, "little", signed=True)]
    for i, name in enumerate(rows.dtype.names):
        v = rows[name].astype(np.int64).view(np.uint64)
        v = v - np.uint64(int(rows["doc"].min()) & (1 << 64) - 1) if name == "doc" else np.diff(v, prepend=np.uint64(0)) if i == 0 else v
        parts.append(v.view(np.uint8).reshape(-1, 8)[:, : rows.dtype[name].itemsize].T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def decode(blob: pa.Scalar, dtype: np.dtype) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(blob.as_buffer())
    n, least_doc, at = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little", signed=True), 16
    rows = np.empty(n, dtype)
    for i, name in enumerate(dtype.names):
        size = dtype[name].itemsize
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T
        at += n * size
        v = wide.view(np.uint64).ravel()
        if i == 0 and name != "doc":
            v = np.cumsum(v, dtype=np.uint64)
            v = v if size == 8 else v & np.uint64((1 << 8 * size) - 1)
        rows[name] = (v + np.uint64(least_doc & (1 << 64) - 1)).view(np.int64) if name == "doc" else v
    return rows


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Sums:
    """Hashes of any byte range of a text, from running sums of a polynomial modulo 2**64."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    codes: dict[int, np.ndarray] = {}

    def __init__(self, data: np.ndarray, seed: int):
        base = 0x9E3779B97F4A7C15 + 2 * seed * 0x632BE59BD9B4E019 & (1 << 64) - 1 | 1
        up, down = self.powers.get(seed, (np.ones(0, np.uint64),) * 2)
        if len(up) <= len(data):
            n = max(1 << 17, 2 * len(data))
            inverse = pow(base, -1, 1 << 64)
            up, down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b, np.uint64)))) for b in (base, inverse))
            self.powers[seed] = up, down
            self.codes[seed] = mix(np.arange(256, dtype=np.uint64) + np.uint64(1000 * seed + 1))
        self.down = down
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[seed][data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def of_length(self, n: int) -> np.ndarray:
        m = len(self.sums) - n
        return mix((self.sums[n:] - self.sums[:m]) * self.down[:m])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each width consecutive values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """key, id, first window and number of windows of the text's runs (at most 255 windows each)."""
    low = least(Sums(data, 1).of_length(k), length - k + 1)
    first = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    n = np.diff(np.append(first, len(low)))
    if n.max() > 255:
        parts = -(-n // 255)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + 255 * nth
        n = np.diff(np.append(first, len(low)))
    ids = mix(Sums(data, 2).of(first, first + n + (length - 1)) + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return low[first], ids, first, n


def document_bucket(doc: np.ndarray, t: np.ndarray, groups: int) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(np.uint64) * np.uint64(31) + t.astype(np.uint64)) % np.uint64(groups)).astype(np.int32)


def blob_batch(kind: int, buckets: np.ndarray, windows: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(data), pa.int32()), pa.array(buckets, pa.int32()), pa.array(windows, pa.int64()), pa.array(data, pa.binary())], schema=BLOB_SCHEMA)


def window_count(rows: np.ndarray) -> int:
    return int(rows["n"].sum(dtype=np.int64)) if "n" in rows.dtype.names else len(rows)


def blobs(kind: int, rows: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows in one blob per bucket; a bucket's rows keep their order."""
    if not len(rows):
        return
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(rows)]))
    for at in range(0, len(cuts) - 1, 256):
        edges = cuts[at : at + 257].tolist()
        parts = [rows[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        yield blob_batch(kind, bucket[edges[:-1]], [window_count(x) for x in parts], [encode(x) for x in parts])


def by_document(kind: int, rows: np.ndarray, dtype: np.dtype, groups: int, **more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs (hot keys' marks left out) as rows of dtype, in a blob per group of documents."""
    out = np.empty(len(rows), dtype)
    for name in dtype.names:
        out[name] = more[name] if name in more else rows[name]
    out = out[out["n"] > 0]
    yield from blobs(kind, out, document_bucket(out["doc"], out["t"], groups))


def joined(doc: np.ndarray, t: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Single windows as PLACE rows, windows in line as one."""
    order = np.lexsort((at, t, doc))
    doc, t, at = doc[order], t[order], at[order].astype(np.int64)
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (t[1:] != t[:-1]) | (at[1:] != at[:-1] + 1)
    starts = np.flatnonzero(first)
    out = np.empty(len(starts), PLACE)
    out["doc"], out["t"], out["at"], out["n"] = doc[starts], t[starts], at[starts], np.diff(np.append(starts, len(doc)))
    return out


def first_documents(rows: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """Of rows sorted by the arrays and doc: which belong to the smallest document of their group."""
    fresh = np.ones(len(rows), bool)
    if len(rows):
        fresh[1:] = np.any([x[1:] != x[:-1] for x in same], axis=0)
    return rows["doc"] == rows["doc"][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]


def sort_value(rows: np.ndarray) -> np.ndarray:
    """Orders runs by key, then by the upper bits of id."""
    return (rows["key"] << np.uint64(64 - KEY_BITS)) | (rows["id"] >> np.uint64(ID_BITS + KEY_BITS - 64))


def run_order(value: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """A stable order by sort value and the whole id; only ties of the value are sorted by id.

    The sort finds what is in order already, so that it merges two sorted arrays in one pass.
    """
    order = np.argsort(value, kind="stable")
    v = value[order]
    same = v[1:] == v[:-1]
    tied = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same))) if len(v) else order
    if len(tied):
        order[tied] = order[tied][np.lexsort((ids[order[tied]], v[tied]))]
    return order


def search_ids(ids: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each wanted id its first place in ids[low:high], which is sorted; high if all are smaller."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        right = open_.copy()
        right[open_] = ids[middle[open_]] < wanted[open_]
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)
    return low


def share_of(value: np.ndarray, shares: int) -> np.ndarray:
    """Mixed again: keys are least hashes, so most of them are small."""
    return (mix(value) % np.uint64(shares)).astype(np.int32)


def offsets(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after the other."""
    n = n.astype(np.int64)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def slices(n: np.ndarray, most: int) -> Iterator[slice]:
    """Cuts rows so that their n sum to most or little more."""
    reached = np.cumsum(n, dtype=np.int64)
    at = 0
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(reached, (reached[at - 1] if at else 0) + most)))
        yield slice(at, end)
        at = end


def hashed_windows(rows: np.ndarray, data: np.ndarray, length: int, seeds: tuple[int, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """Row number, number in the run, place in data and hashes of the windows of runs, whose bytes stand in line in data."""
    ends = np.cumsum(rows["n"].astype(np.int64) + (length - 1))
    for part in slices(rows["n"] + np.int64(length - 1), SLICE):
        base = int(ends[part.start - 1]) if part.start else 0
        n = rows["n"][part].astype(np.int64)
        nth = offsets(n)
        row = np.repeat(np.arange(part.start, part.start + len(n), dtype=np.int32), n)
        at = np.repeat(ends[part] - n - (length - 1), n) + nth
        piece = data[base : int(ends[part.start + len(n) - 1])]
        yield (row, nth.astype(np.uint8), at, *[Sums(piece, s).of_length(length)[at - base] for s in seeds])


def spots_of(rows: np.ndarray, data: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """The single windows of runs, SLICE bytes at a time."""
    for row, nth, _, one, two in hashed_windows(rows, data, length, (2, 1)):
        spots = np.empty(len(row), SPOT)
        spots["id"], spots["more"], spots["doc"], spots["t"], spots["at"] = one, two, rows["doc"][row], rows["t"][row], rows["at"][row] + nth
        yield spots


def bytes_of(data: np.ndarray, at: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """The bytes of a text's runs in line."""
    size = n.astype(np.int64) + (length - 1)
    return data[np.repeat(at.astype(np.int64), size) + offsets(size)]


def settle_spots(rows: np.ndarray, groups: int) -> tuple[np.ndarray, list[pa.RecordBatch]]:
    """The smallest document's windows, and the others as covered."""
    rows = rows[np.lexsort((rows["doc"], rows["more"], rows["id"]))]
    stays = first_documents(rows, rows["id"], rows["more"])
    gone = rows[~stays]
    return rows[stays], list(by_document(COVERED, joined(gone["doc"], gone["t"], gone["at"]), PLACE, groups))


def emit_spots(found: list[np.ndarray], shares: int, groups: int) -> Iterator[pa.RecordBatch]:
    if found:
        stays, covered = settle_spots(np.concatenate(found), groups)
        yield from covered
        yield from blobs(WINDOW, stays, share_of(stays["id"], shares))


def equal_runs_leave(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of runs by sort value, id and doc, and which of them stay: those of the smallest document."""
    value = sort_value(rows)
    order = np.lexsort((rows["doc"], rows["id"], value))
    ordered = rows[order]
    return order, first_documents(ordered, value[order], ordered["id"])


def index_batches(batches: Iterator[pa.RecordBatch], length: int, k: int, shares: int, groups: int) -> Iterator[pa.RecordBatch]:
    """doc_id, t, text -> each batch's array by share of the keys, and what is covered within it."""

    def flush(texts: list[np.ndarray], found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        source = np.repeat(np.arange(len(found)), list(map(len, found)))
        rows = np.concatenate(found)
        order, stays = equal_runs_leave(rows)
        rows, source = rows[order], source[order]
        yield from by_document(COVERED, rows[~stays], PLACE, groups)
        rows, source = rows[stays], source[stays]
        fresh = np.concatenate(([True], rows["key"][1:] != rows["key"][:-1]))
        group = np.cumsum(fresh) - 1
        hot = np.bincount(group)[group] > HOT
        if hot.any():
            hot_rows, hot_source = rows[hot], source[hot]
            for part in slices(hot_rows["n"] + np.int64(length - 1), 4 * SLICE):
                mine, by = hot_rows[part], hot_source[part]
                data = np.concatenate([texts[s][a : a + n + length - 1] for s, a, n in zip(by.tolist(), mine["at"].tolist(), mine["n"].tolist(), strict=True)])
                yield from emit_spots(list(spots_of(mine, data, length)), WINDOW_SHARES * shares, groups)
            marks = rows[hot & fresh]
            marks["n"] = marks["id"] = 0
            rows = np.concatenate((rows[~hot], marks))
            rows = rows[run_order(sort_value(rows), rows["id"])]
        yield from blobs(ENTRY, rows, share_of(rows["key"], shares))

    texts, found, size = [], [], 0
    for batch in batches:
        for doc, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            if doc is None or len(data) < length:
                continue
            key, ids, at, n = runs(data, length, k)
            rows = np.empty(len(ids), RUN)
            rows["key"], rows["id"], rows["doc"], rows["t"], rows["at"], rows["n"] = key >> np.uint64(64 - KEY_BITS), ids >> np.uint64(64 - ID_BITS), doc, t, at, n
            texts.append(data)
            found.append(rows)
            size += len(rows)
            if size > BATCH:
                yield from flush(texts, found)
                texts, found, size = [], [], 0
    if found:
        yield from flush(texts, found)
    free_memory()


class LevelFamily:
    """Arrays of runs, sorted by key and whole id. Equal runs in all levels are those of one document."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # sort values, rows
        self.covered: list[np.ndarray] = []
        self.spotted: list[np.ndarray] = []

    def push(self, batch: np.ndarray) -> None:
        """Merge-scans a sorted array against all levels, adds what is left, and merges alike sizes."""
        value = sort_value(batch)
        for i, (theirs, level) in enumerate(self.levels):
            if not len(batch) or not len(level):
                continue
            at = np.searchsorted(theirs, value)
            hit = np.flatnonzero(at < len(theirs))
            hit = hit[theirs[at[hit]] == value[hit]]
            ends = np.searchsorted(theirs, value[hit], "right")
            at[hit] = search_ids(level["id"], at[hit], ends, batch["id"][hit])
            hit = hit[at[hit] < ends]
            hit = hit[(theirs[at[hit]] == value[hit]) & (level["id"][at[hit]] == batch["id"][hit])]
            if not len(hit):
                continue
            before = level["doc"][at[hit]]
            won = hit[batch["doc"][hit] < before]
            if len(won):
                ends = np.searchsorted(theirs, value[won], "right")
                n = ends - at[won]
                there = np.repeat(at[won], n) + offsets(n)
                larger = level["doc"][there] > np.repeat(batch["doc"][won], n)
                there = np.unique(there[larger & (level["id"][there] == np.repeat(batch["id"][won], n))])
                self.covered.append(level[there])
                self.levels[i] = np.delete(theirs, there), np.delete(level, there)
            lost = hit[batch["doc"][hit] > before]
            if len(lost):
                self.covered.append(batch[lost])
                batch, value = np.delete(batch, lost), np.delete(value, lost)
        self.levels.append((value, batch))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            value, rows = (np.concatenate(x) for x in zip(self.levels.pop(), self.levels.pop(), strict=True))
            order = run_order(value, rows["id"])
            self.levels.append(self.without_hot(value[order], rows[order]))

    def without_hot(self, value: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A level in which keys of more than HOT_GROUP runs are marks; their runs are spotted."""
        fresh = np.concatenate(([True], rows["key"][1:] != rows["key"][:-1]))
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(rows)))
        if sizes.max(initial=0) <= HOT_GROUP:
            return value, rows
        hot = np.repeat(sizes > HOT_GROUP, sizes)
        marks = rows[hot & fresh]
        self.spotted.append(rows[hot])
        marks["n"] = marks["id"] = 0
        rows = np.concatenate((rows[~hot], marks))
        value = sort_value(rows)
        order = run_order(value, rows["id"])
        return value[order], rows[order]

    def shared_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs whose key is in runs of several documents, and those whose key is hot somewhere."""
        rows = np.concatenate([level for _, level in self.levels])
        rows = rows[np.argsort(rows["key"], kind="stable")]
        if not len(rows):
            return rows, rows
        starts = np.flatnonzero(np.concatenate(([True], rows["key"][1:] != rows["key"][:-1])))
        n = np.diff(np.append(starts, len(rows)))
        hot = np.minimum.reduceat(rows["n"], starts) == 0
        several = np.minimum.reduceat(rows["doc"], starts) != np.maximum.reduceat(rows["doc"], starts)
        return rows[np.repeat(several & ~hot, n)], rows[np.repeat(hot, n)]


def others(batch: pa.RecordBatch, *kinds: int) -> Iterator[pa.RecordBatch]:
    """The batch without blobs of some kinds, if there are any."""
    rest = ~np.isin(batch.column(0).to_numpy(), kinds)
    if rest.any():
        yield batch.filter(pa.array(rest))


def blobs_of(batch: pa.RecordBatch, kind: int) -> Iterator[pa.Scalar]:
    return (blob for k, blob in zip(batch.column(0).to_pylist(), batch.column(3), strict=True) if k == kind)


def scan_shares(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Arrays of whole shares -> covered and asked runs by document; passes other kinds on.

    The small arrays of a share are gathered to BATCH entries before they meet the levels.
    """
    family, waiting, size = LevelFamily(), [], 0

    def push() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(waiting)
        order, stays = equal_runs_leave(rows)
        family.covered.append(rows[order[~stays]])
        family.push(rows[order[stays]])
        yield from by_document(COVERED, np.concatenate(family.covered), PLACE, groups)
        family.covered = []
        yield from asked(SPOTTED, family.spotted)
        family.spotted = []

    def asked(kind: int, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if found:
            rows = np.concatenate(found)
            yield from by_document(kind, rows, ASK, groups, fine=share_of(rows["key"], FINE))

    for batch in batches:
        yield from others(batch, ENTRY)
        for blob in blobs_of(batch, ENTRY):
            waiting.append(decode(blob, RUN))
            size += len(waiting[-1])
            if size > BATCH:
                yield from push()
                waiting, size = [], 0
    if waiting:
        yield from push()
    if family.levels:
        several, hot = family.shared_keys()
        family.levels = []
        yield from asked(ASKED, [several])
        yield from asked(SPOTTED, [hot])
    free_memory()


def per_document(parts: list[np.ndarray]) -> dict[tuple[int, int], np.ndarray]:
    """(doc_id, t) -> its rows."""
    if not parts:
        return {}
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows["t"], rows["doc"]))]
    cuts = np.concatenate(([0], np.flatnonzero((rows["doc"][1:] != rows["doc"][:-1]) | (rows["t"][1:] != rows["t"][:-1])) + 1, [len(rows)])).tolist()
    return {(int(rows["doc"][a]), int(rows["t"][a])): rows[a:b] for a, b in zip(cuts, cuts[1:], strict=False)}


def documents_of(group: pa.Table, wanted: dict | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """The texts of a group: all rows, or only the first of each (doc_id, t) still in wanted."""
    unpack = zstandard.ZstdDecompressor()
    for doc, t, packed in zip(group.column("doc_id").to_pylist(), group.column("t").to_pylist(), group.column("packed"), strict=True):
        if wanted is None or (doc, t) in wanted:
            yield doc, t, np.frombuffer(unpack.decompress(packed.as_buffer()), np.uint8)


def encode_text(rows: np.ndarray, data: np.ndarray) -> bytes:
    head = encode(rows)
    return len(head).to_bytes(8, "little") + head + zstandard.ZstdCompressor(level=1).compress(data.tobytes())


def decode_text(blob: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    view = memoryview(blob.as_buffer())
    n = int.from_bytes(view[:8], "little")
    rows = decode(pa.scalar(bytes(view[8 : 8 + n]), pa.binary()), ASK)
    return rows, np.frombuffer(zstandard.ZstdDecompressor().decompress(view[8 + n :]), np.uint8)


def run_texts(length: int, groups: int):
    """(documents, asked runs) of a group -> the runs with their bytes; hot keys' windows one by one."""

    def attach(documents: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        for kind in (ASKED, SPOTTED):
            wanted = per_document([decode(b, ASK) for k, b in zip(asked.column("kind").to_pylist(), asked.column("blob"), strict=True) if k == kind])
            found = []
            for doc, t, data in documents_of(documents, wanted) if wanted else ():
                rows = wanted.pop((doc, t))
                found.append((rows, bytes_of(data, rows["at"], rows["n"], length)))
            if found and kind == ASKED:
                rows, data = (np.concatenate(x) for x in zip(*found, strict=True))
                out.append(blob_batch(TEXT, np.zeros(1, np.int32), [window_count(rows)], [encode_text(rows, data)]))
            elif found:
                rows, data = (np.concatenate(x) for x in zip(*found, strict=True))
                for spots in spots_of(rows, data, length):
                    out += emit_spots([spots], 1, groups)
        return pa.Table.from_batches(out, schema=BLOB_SCHEMA)

    return attach


def deal(batches: Iterator[pa.RecordBatch], length: int, text_shares: int, window_shares: int, groups: int) -> Iterator[pa.RecordBatch]:
    """The runs and windows of a task's groups, about BATCH at a time, by share; passes other kinds on."""
    found: list[np.ndarray] = []
    texts: list[tuple[np.ndarray, np.ndarray]] = []

    def by_share() -> Iterator[pa.RecordBatch]:
        rows, data = (np.concatenate(x) for x in zip(*texts, strict=True))
        size = rows["n"].astype(np.int64) + (length - 1)
        starts = np.cumsum(size) - size
        bucket = rows["fine"] % text_shares
        order = np.lexsort((rows["fine"], bucket))  # runs of one key together: their bytes compress well
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(rows)])).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            mine = order[a:b]
            chosen = rows[mine]
            chosen["fine"] = 0
            yield blob_batch(TEXT, bucket[mine[:1]].astype(np.int32), [window_count(chosen)], [encode_text(chosen, data[np.repeat(starts[mine], size[mine]) + offsets(size[mine])])])

    for batch in batches:
        yield from others(batch, TEXT, WINDOW)
        for blob in blobs_of(batch, WINDOW):
            found.append(decode(blob, SPOT))
            if sum(map(len, found)) > BATCH:
                yield from emit_spots(found, window_shares, groups)
                found = []
        for blob in blobs_of(batch, TEXT):
            texts.append(decode_text(blob))
            if sum(len(rows) for rows, _ in texts) > BATCH // 4:
                yield from by_share()
                texts = []
    yield from emit_spots(found, window_shares, groups)
    if texts:
        yield from by_share()
    free_memory()


def settle_texts(rows: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """Of runs with their bytes: the windows that a smaller document has too, as PLACE rows."""
    row, nth, at, h = (np.concatenate(x) for x in zip(*hashed_windows(rows, data, length, (2,)), strict=True))
    doc = rows["doc"][row]
    order = np.lexsort((doc, h))
    ordered = h[order]
    fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    first = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]  # of each in order: its group's smallest document
    same = order != first
    one, two = order[same], first[same]
    strings = np.lib.stride_tricks.sliding_window_view(data, length)
    unlike = np.concatenate([np.flatnonzero((strings[at[one[i : i + COMPARED]]] != strings[at[two[i : i + COMPARED]]]).any(axis=1)) + i for i in range(0, len(one), COMPARED)] or [np.zeros(0, np.int64)])
    gone = one[doc[one] != doc[two]]
    if len(unlike):  # one hash for different bytes: such groups are settled by the bytes
        mixed = np.isin(ordered, h[one[unlike]])
        least: dict[bytes, int] = {}
        members = order[mixed]
        for i in members.tolist():
            least.setdefault(data[at[i] : at[i] + length].tobytes(), int(doc[i]))
        lost = [i for i in members.tolist() if least[data[at[i] : at[i] + length].tobytes()] < doc[i]]
        gone = np.concatenate((gone[~np.isin(gone, members)], np.array(lost, np.int64)))
    return joined(doc[gone], rows["t"][row[gone]], rows["at"][row[gone]] + nth[gone])


def settle(batches: Iterator[pa.RecordBatch], length: int, groups: int) -> Iterator[pa.RecordBatch]:
    """Runs with their bytes, and windows, in order of share -> covered places; passes other kinds on."""
    share, found, texts = None, [], []

    def settled() -> Iterator[pa.RecordBatch]:
        if found:
            yield from settle_spots(np.concatenate(found), groups)[1]
        if texts:
            rows, data = (np.concatenate(x) for x in zip(*texts, strict=True))
            yield from by_document(COVERED, settle_texts(rows, data, length), PLACE, groups)

    for batch in batches:
        yield from others(batch, TEXT, WINDOW)
        for kind, bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True):
            if bucket != share:
                yield from settled()
                share, found, texts = bucket, [], []
            if kind == WINDOW:
                found.append(decode(blob, SPOT))
            elif kind == TEXT:
                texts.append(decode_text(blob))
    yield from settled()
    free_memory()


def removed(length: int):
    """(documents, covered runs) of a group -> doc_id, t, n_bytes, starts and ends of removed bytes, kept."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def emit(documents: pa.Table, covered: pa.Table) -> pa.Table:
        found, rows = per_document([decode(b, PLACE) for b in covered.column("blob")]), []
        for doc, t, data in documents_of(documents):
            gone = found.get((doc, t))
            if gone is None:
                rows.append((doc, len(data), [], data.tobytes()))
                continue
            depth = np.zeros(len(data) + 1, np.int64)
            at = gone["at"].astype(np.int64)
            np.add.at(depth, at, 1)
            np.add.at(depth, at + gone["n"] + (length - 1), -1)
            inside = np.concatenate(([False], np.cumsum(depth[:-1]) > 0, [False]))
            edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
            rows.append((doc, len(data), [{"start": a, "end": b} for a, b in edges.tolist()], data[~inside[1:-1]].tobytes()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else schema.empty_table()

    return emit


def pack(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """doc_id, t, text -> its group, doc_id, t and the compressed bytes."""
    compress = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        t = batch.column(1).to_numpy()
        doc = batch.column(0)
        bucket = document_bucket(doc.fill_null(-1).to_numpy(zero_copy_only=False), t, groups)
        packed = [compress.compress(x.as_buffer() if x.is_valid else b"") for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket), doc, batch.column(1), pa.array(packed, pa.binary())], ["bucket", "doc_id", "t", "packed"])


def numbered_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, t, text (binary); t tells the different texts of one doc_id apart, and is 0 for most."""
    plain = docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
    several = ids.groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b and doc_id is not null").select("doc_id")
    repeated = cut(ids.join(several, "doc_id").select("doc_id", "h").distinct())
    if repeated.isEmpty():
        return plain.select("doc_id", F.lit(0).cast("long").alias("t"), "text")
    t = repeated.select("doc_id", "h", F.row_number().over(Window.partitionBy("doc_id").orderBy("h")).cast("long").alias("n"))
    return plain.join(t, ["doc_id", "h"], "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("t"), "text")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """doc_id, n_bytes, spans (array of removed byte ranges: start, end), kept (binary) for every row.

    A null text is empty; a text under length bytes has no string to remove.  Rows that repeat a
    doc_id don't remove each other's bytes.  A row with a null doc_id keeps all bytes and removes
    none elsewhere.  kept may end inside a character.  Extra columns are not returned.
    """
    spark = docs.sparkSession
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = cut(docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")))
    total = ids.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    texts = numbered_texts(docs, ids)
    # a task makes a blob per group and per share, so both follow the bytes and not the number of tasks
    groups = max(LEAST_SHARES, total // GROUP_BYTES + 1)
    needed = total // 10 // SHARE + 1
    tasks, shares = max(parallel, needed), max(LEAST_SHARES, 4 * needed)

    def with_documents(function, schema: str, found: DataFrame) -> DataFrame:
        left = texts.mapInArrow(lambda b: pack(b, groups), "bucket int, doc_id long, t long, packed binary")
        return left.groupBy("bucket").cogroup(found.select("kind", "bucket", "blob").groupBy("bucket")).applyInArrow(function, schema)

    scanned = cut_and_free(
        texts.mapInArrow(lambda b: index_batches(b, length, k, shares, groups), BLOBS).repartition(tasks, "bucket").mapInArrow(lambda b: scan_shares(b, groups), BLOBS)
    )
    open_windows = scanned.filter(F.col("kind").isin(ASKED, SPOTTED, WINDOW)).agg(F.coalesce(F.sum("windows"), F.lit(0)).alias("n")).first().n
    needed = open_windows // SETTLED + 1
    settlers, text_shares = max(parallel, needed), max(LEAST_SHARES, 4 * needed)
    settled = cut_and_free(
        with_documents(run_texts(length, groups), BLOBS, scanned.filter(F.col("kind").isin(ASKED, SPOTTED)))
        .mapInArrow(lambda b: deal(b, length, text_shares, WINDOW_SHARES * shares, groups), BLOBS)
        .unionByName(scanned.filter(F.col("kind") == WINDOW))
        .repartition(settlers, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(lambda b: settle(b, length, groups), BLOBS)
    )
    covered = scanned.unionByName(settled).filter(F.col("kind") == COVERED)
    return with_documents(removed(length), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary", covered)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)
), c AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM w) WHERE first < doc_id
), g AS (
  SELECT DISTINCT doc_id, i + k AS b FROM c, unnest(range(50)) AS o(k)
), r AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before < b - 1) AS n_spans
  FROM (SELECT doc_id, b, lag(b) OVER (PARTITION BY doc_id ORDER BY b) AS before FROM g) GROUP BY doc_id
), k AS (
  SELECT e.doc_id, string_agg(substr(x, 2 * e.b + 1, 2), '' ORDER BY e.b) AS kept
  FROM (SELECT doc_id, x, unnest(range(n)) AS b FROM d SEMI JOIN r USING (doc_id)) e ANTI JOIN g ON e.doc_id = g.doc_id AND e.b = g.b GROUP BY e.doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_removed IS NULL THEN x ELSE coalesce(kept, '') END)) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""
