"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; windows of the resulting templates are
hash-joined between documents and benchmark items, and the values in the slots must map
consistently from the item to the document.  So a question is found again when its numbers or
names were exchanged, and not when only the scaffold agrees.

Every window has three templates: one in which a capitalised word inside a sentence is a <name>, one
that lower-cases all words, so that text whose case or punctuation was lost still matches, and one in
which a capitalised word that opens a sentence is a <name> too.  A run of names is one slot, so that
"Mary Ann" may stand for "Alice"; windows count such places, and each template's hits are judged by
themselves, as their places differ.  Templates with more slots than literals match ordinary text;
windows that are mostly numbers, which have no other template, match by their exact words and count
with the lower-cased ones.

Documents are prefiltered by a bit set of fixed size (2**BLOOM_BITS) made from the benchmark's
window hashes; what passes is joined as rows, whatever the size of the benchmark.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

WINDOW = 8
#: Items under this many words are not searched for: they would match ordinary text.
MIN_WORDS = 4
#: Windows of an item that must be found in line: 6 windows of 8 words are a passage of 13 words.
MIN_HITS = 6
BLOOM_BITS = 22
VOCABULARY = 500_000
#: Characters of texts that are taken together.
GROUP = 300_000
UNITS = {
    "mass": "mg g kg gram grams kilogram kilograms ton tons tonne tonnes lb lbs pound pounds oz ounce ounces",
    "length": "mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet yard yards mile miles",
    "time": "ms s sec second seconds min minute minutes h hour hours day days week weeks month months year years",
    "volume": "ml cl l liter liters litre litres gallon gallons pint pints cup cups",
    "money": "dollar dollars euro euros cent cents usd eur gbp",
    "rate": "percent kmh mph rpm hz khz mhz ghz",
}
DIMENSION = {u: d for d, us in UNITS.items() for u in us.split()}
TOKEN = re.compile(r"[.!?:\n]|\d+(?:[.,]\d+)*|[^\W\d_]+")
NUMBER, NAME = "<num>", "<name>"
INSIDE, LOWERED, OPENING, EXACT = 0, 1, 2, 3
WINDOWS = "id long, t long, channel int, size int, h long, at int, template string, slots array<string>, windows int"


def code(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode(), 42)


NAME_CODE, NUMBER_CODE = np.uint64(code(NAME)), code(NUMBER)
UNIT_CODE = {u: code(f"<{d}>") for u, d in DIMENSION.items()}


class Vocabulary(dict):
    """Token -> row of plain (its code), exact (for a number, the code of its digits), kind (0 mark, 1 number, 2 capitalised, 3 other) and unit.

    table() makes the rows of new tokens known; forget() empties all.
    """

    def __init__(self):
        super().__init__()
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh: list[tuple[int, int, int, int]] = []
        self.columns = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.uint64))

    def __missing__(self, token: str) -> int:
        row = self[token] = len(self)
        lower = token.lower()
        exact = code(lower)
        first = token[0]
        if first.isdigit():
            self.fresh.append((NUMBER_CODE, exact, 1, 0))
        else:
            self.fresh.append((exact, exact, 0 if token in ".!?:\n" else 2 if first.isupper() else 3, UNIT_CODE.get(lower, 0)))
        return row

    def table(self) -> tuple[np.ndarray, ...]:
        if self.fresh:
            self.columns = tuple(np.concatenate((c, np.array(x, c.dtype))) for c, x in zip(self.columns, zip(*self.fresh, strict=True), strict=True))
            self.fresh = []
        return self.columns


class Channel(NamedTuple):
    """Places of some texts in one kind of template: the number of each place's first word (and of words, at the
    end), its code, whether it is a slot or a unit, and its text's number."""

    first: np.ndarray
    codes: np.ndarray
    slots: np.ndarray
    units: np.ndarray
    text: np.ndarray


def canonical(texts: list[str], vocabulary: Vocabulary) -> tuple[list[str], np.ndarray, list[Channel]]:
    """The texts' tokens in line, which of them are words, and the channels."""
    found = [TOKEN.findall(t) for t in texts]
    tokens = list(itertools.chain.from_iterable(found))
    if len(vocabulary) > VOCABULARY:
        vocabulary.forget()
    rows = np.fromiter(map(vocabulary.__getitem__, tokens), np.int64, len(tokens))
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    text = np.repeat(np.arange(len(found)), sizes)
    plain, exact, kind, unit = vocabulary.table()
    kinds = kind[rows]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = text[1:] != text[:-1]
    starts = fresh.copy()
    starts[1:] |= kinds[:-1] == 0
    word = kinds > 0
    rows, kinds, starts, text = rows[word], kinds[word], starts[word], text[word]
    number = kinds == 1
    after = np.zeros_like(number)
    after[1:] = number[:-1] & (text[1:] == text[:-1])
    units = unit[rows]
    is_unit = after & (units != 0)
    lowered = np.where(is_unit, units, plain[rows])
    capital = (kinds == 2) & ~is_unit

    def with_names(name: np.ndarray) -> Channel:
        place = ~name | starts
        place[:1] = True
        place[1:] |= ~name[:-1] | (text[1:] != text[:-1])
        first = np.flatnonzero(place)
        return Channel(np.append(first, len(name)), np.where(name, NAME_CODE, lowered)[first], (number | name)[first], is_unit[first], text[first])

    every = np.arange(len(rows) + 1)
    none = np.zeros_like(number)
    channels = [with_names(capital & ~starts), Channel(every, lowered, number, is_unit, text), with_names(capital), Channel(every, exact[rows], none, none, text)]
    return tokens, np.flatnonzero(word), channels


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows along the last axis."""
    n = max(0, codes.shape[-1] - size + 1)
    out = np.zeros((*codes.shape[:-1], n), np.uint64)
    for j in range(size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[..., j : j + n]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


class Words:
    """Single words of canonical()'s tokens."""

    def __init__(self, tokens: list[str], place: np.ndarray):
        self.tokens, self.place = tokens, place

    def __getitem__(self, i: int) -> str:
        return self.tokens[self.place[i]]


def template(words: Words, channel: Channel, a: int, b: int) -> str:
    """The template of the places a to b; a number in no slot stands for itself."""
    out = []
    for i in range(a, b):
        w = words[channel.first[i]]
        out.append((NUMBER if w[0].isdigit() else NAME) if channel.slots[i] else f"<{DIMENSION[w.lower()]}>" if channel.units[i] else w.lower())
    return " ".join(out)


def slot_values(words: Words, channel: Channel, a: int, b: int) -> list[str]:
    return [" ".join(words[j] for j in range(channel.first[i], channel.first[i + 1])) for i in range(a, b) if channel.slots[i]]


ROW = pa.schema([("id", pa.int64()), ("t", pa.int64()), ("channel", pa.int32()), ("size", pa.int32()), ("h", pa.int64()), ("at", pa.int32()), ("template", pa.string()), ("slots", pa.list_(pa.string())), ("windows", pa.int32())])


def text_windows(ids: list, ts: list, texts: list[str], sizes: list[int] | None, bloom: np.ndarray | None, vocabulary: Vocabulary) -> list[tuple]:
    """The windows of some texts, all at once. sizes None: one text, an item, with its own size for each channel."""
    tokens, place, channels = canonical(texts, vocabulary)
    words, rows = Words(tokens, place), []
    for size in sizes or sorted({min(WINDOW, len(c.codes)) for c in channels}):
        if size < MIN_WORDS:
            continue
        literal = None
        for kind, channel in enumerate(channels):
            n = len(channel.codes)
            if size > n or (sizes is None and size != min(WINDOW, n)):
                continue
            hashes = window_hashes(channel.codes, size)
            whole = channel.text[size - 1 :] == channel.text[: n - size + 1]
            if kind == EXACT:
                usable, total = whole & ~literal, len(hashes)
            else:
                filled = np.concatenate(([0], np.cumsum(channel.slots)))
                mostly = (size - (filled[size:] - filled[:-size])) * 2 >= size
                literal = mostly if kind == LOWERED else literal
                usable = whole & mostly
                total = int(usable.sum())
            if bloom is not None:
                bit = (hashes >> np.uint64(64 - BLOOM_BITS)).astype(np.int64)
                usable = usable & (bloom[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
            found = np.flatnonzero(usable)
            begins = np.searchsorted(channel.text, channel.text[found])
            signed = hashes.view(np.int64)
            rows.extend(
                (ids[channel.text[a]], ts[channel.text[a]], kind, size, int(signed[a]), a - b, template(words, channel, a, a + size), slot_values(words, channel, a, a + size), total)
                for a, b in zip(found.tolist(), begins.tolist(), strict=True)
            )
    return rows


def windows(batches: Iterator[pa.RecordBatch], sizes: list[int] | None, bloom: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Windows of (id, text, t) rows. sizes None: benchmark items' own (WINDOW places, or all of a shorter one).

    Texts are taken together up to GROUP characters.
    """
    vocabulary = Vocabulary()

    def emitted(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows = text_windows(*map(list, zip(*group, strict=True)), sizes, bloom, vocabulary)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ROW, strict=True)], schema=ROW)

    for batch in batches:
        group, size = [], 0
        for id_, text, t in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            text = text.as_py()
            if not text:
                continue
            group.append((id_, t, text))
            size += len(text)
            if size > GROUP or sizes is None:
                yield from emitted(group)
                group, size = [], 0
        if group:
            yield from emitted(group)


def bit_set(found: DataFrame) -> np.ndarray:
    """The bit set of the windows' hashes; at most 2**BLOOM_BITS / 64 rows come to the driver."""
    bit = F.shiftrightunsigned("h", 64 - BLOOM_BITS)
    words = found.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BLOOM_BITS}) & 63 as int))")).alias("bits"))
    out = np.zeros(1 << (BLOOM_BITS - 6), np.int64)
    for r in words.collect():
        out[r.word] = r.bits
    return out.view(np.uint8)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, t (xxhash64 of the text), item_id, hits, windows, changed: one row per document and item found.

    An item is found if at least MIN_HITS of its windows (all, if it has fewer) occur in line in
    the document, as templates of one kind, and their slots are consistent: equal values of the item
    stand against equal values of the document.  Fewer than MIN_HITS exact windows count only if they
    are all of an item's windows.  changed: some value differs, so the question was re-parameterised.
    A null doc_id is searched like any other; its texts are told apart by t.  Null item ids and null
    or empty texts find nothing, and so do items under MIN_WORDS words.  Repeated rows give one
    result.  Extra columns are not read.
    """
    named = benchmark.filter(F.col("item_id").isNotNull())
    items = cut(named.select(F.col("item_id").alias("id"), "text", F.lit(0).cast("long").alias("t")).mapInArrow(lambda b: windows(b, None, None), WINDOWS))
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most WINDOW values
    bloom = bit_set(items)
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("t")).mapInArrow(lambda b: windows(b, sizes, bloom), WINDOWS)
    pairs = rows.alias("d").join(items.alias("i"), ["size", "channel", "h", "template"]).select(
        F.col("d.id").alias("doc_id"), F.col("d.t").alias("t"), F.col("i.id").alias("item_id"), F.col("channel"), F.col("i.windows").alias("windows"),
        F.when(F.col("channel") == EXACT, LOWERED).otherwise(F.col("channel")).alias("family"),
        F.col("i.at").alias("at"), (F.col("d.at") - F.col("i.at")).alias("line"), F.arrays_zip(F.col("i.slots").alias("was"), F.col("d.slots").alias("now")).alias("slots"),
    )
    templated, exact = F.col("channel") != EXACT, F.col("channel") == EXACT
    lines = pairs.groupBy("doc_id", "t", "item_id", "family", "line").agg(
        F.size(F.collect_set(F.when(templated, F.col("at")))).alias("templated"), F.size(F.collect_set("at")).alias("hits"), F.max("windows").alias("windows"),
        F.max(F.when(templated, F.col("windows"))).alias("usable"), F.max(F.when(exact, F.col("windows"))).alias("every"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    consistent = F.size(F.array_distinct(F.col("slots.was"))) == F.size("slots")
    enough = (F.col("templated") >= F.least(F.lit(MIN_HITS), "usable")) | (F.col("hits") >= F.least(F.lit(MIN_HITS), "every"))
    return (
        lines.filter(consistent & enough)
        .groupBy("doc_id", "t", "item_id")
        .agg(F.max("hits").cast("long").alias("hits"), F.max("windows").cast("long").alias("windows"), F.max(F.exists("slots", lambda s: s["was"] != s["now"])).alias("changed"))
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("t")
