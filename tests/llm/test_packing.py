import functools
import random
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terrabrook.llm import packing as P


def brute_best_fit(counts, capacity):
    """Pieces one by one: (length, number) -> (bin, offset), the tightest bin first."""
    rest, placed = [], {}
    for length in sorted(counts, reverse=True):
        for number in range(counts[length]):
            fits = [(r, i) for i, r in enumerate(rest) if r >= length]
            if fits:
                i = min(fits)[1]
            else:
                rest.append(capacity)
                i = len(rest) - 1
            placed[length, number] = i, capacity - rest[i]
            rest[i] -= length
    return len(rest), placed


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 25), max_size=12))
def test_ranges_equal_best_fit_decreasing(counts):
    ranges = P.best_fit_decreasing(counts, 30)
    bins = defaultdict(list)
    done = defaultdict(int)
    for k, (length, number, first, per, offset) in enumerate(ranges):
        later = [r[1] for r in ranges[k + 1 :] if r[0] == length]
        n = (later[0] if later else counts[length]) - number
        assert number == done[length]
        done[length] += n
        for i in range(n):
            bins[first + i // per].append((offset + i % per * length, length))
    assert dict(done) == counts
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 30
    assert sorted(bins) == list(range(len(bins)))
    want, _ = brute_best_fit(counts, 30)
    assert len(bins) == want


def test_ids_equal_the_tokenizers_library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    e = encoding()
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>x", "<|endoftext", "", " ", "Hello  world\n\n x", "éèß ñ 漢字 \U0001f600", "a" * 3000, "1234 5678's it'll <|endoftext|>", "\x00\x01 tab\t\ttab", "don't  DON'T"]
    texts += [x or "" for x in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()]
    assert [P.ids_of(e, x).tolist() for x in texts] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert P.ids_of(e, texts[0]).tolist() == [64, 220, 50256, 275]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n'|<>endoftx")), max_size=40), st.booleans())
def test_ids_equal_the_tokenizers_library_on_any_text(text, marked):
    text = text.replace("|", "<|endoftext|>") if marked else text
    assert P.ids_of(encoding(), text).tolist() == library().encode(text, add_special_tokens=False).ids


@functools.cache
def encoding():
    return P.load_encoding(P.public_file("byte_bpe_50k.tiktoken"), P.special_tokens(P.public_file("byte_bpe_50k.json")))


@functools.cache
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_pieces_and_places(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "x1", "Zürich"]) for _ in range(rng.choice([1, 5, 40, 90, 500, 2100])))) for i in range(80)]
    rows += [(100, None), (101, ""), (7, rows[7][1]), (None, "no id")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, length string").repartition(5)
    got = P.pack_documents(df, capacity=256).collect()
    e = encoding()
    whole = defaultdict(list)
    for i, text in rows:
        whole[i].append(P.ids_of(e, text or "").tolist() + [0])
    parts = defaultdict(list)
    bins = defaultdict(list)
    for r in got:
        ids = [int.from_bytes(r.ids[a : a + 4], "little") for a in range(0, len(r.ids), 4)]
        assert len(ids) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        assert any(x[r.start : r.start + r.length] == ids for x in whole[r.doc_id])
        parts[r.doc_id].append((r.piece, r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
        assert r.length == 256 or r.piece == 0
    for i, found in parts.items():
        want = []
        for ids in whole[i]:
            head = len(ids) % 256 or min(256, len(ids))
            starts = [0, *range(head, len(ids), 256)]
            want += [(k, s, (head if k == 0 else 256)) for k, s in enumerate(starts)]
        assert sorted(found) == sorted(want)
    counts = defaultdict(int)
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
            counts[length] += 1
        assert at <= 256
    assert len(bins) == brute_best_fit(counts, 256)[0]


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
