import random

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import zstandard
from pyspark.sql import functions as F

from terrabrook.llm import suffix_dedup as S


def brute(rows, length):
    """doc_id -> removed byte flags, by a set of all strings of smaller documents."""
    data = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(data):
        for a in range(len(data[i]) - length + 1):
            first.setdefault(data[i][a : a + length], i)
    out = {}
    for i, d in data.items():
        gone = [False] * len(d)
        for a in range(len(d) - length + 1):
            if first[d[a : a + length]] < i:
                gone[a : a + length] = [True] * length
        out[i] = gone
    return data, out


def check(spark, rows, length=50, k=20, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    data, want = brute(rows, length)
    for r in S.suffix_dedup(df, length, k).collect():
        gone = [False] * len(data[r.doc_id])
        for s in r.spans:
            gone[s.start : s.end] = [True] * (s.end - s.start)
        assert gone == want[r.doc_id], r.doc_id
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        assert bytes(r.kept) == bytes(b for b, g in zip(data[r.doc_id], gone) if not g)
        assert r.n_bytes == len(data[r.doc_id])


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(rng.choice([9, 12, 40]))) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 2)
            parts += [s[a : a + rng.randint(20, 400)], " ".join(word() for _ in range(rng.randint(0, 8)))]
        texts.append(" ".join(parts))
    texts += texts[:4] + ["", None, "short", "ab" * 200, "ab" * 170, "x" + "ab" * 90, "-" * 600, "=" * 49, "-" * 50] + ["z" * 700 + shared[0]]
    ids = rng.sample(range(-50, 500), len(texts))
    return list(zip(ids, texts))


def test_windows_of_one_hash_are_told_by_their_bytes(monkeypatch):
    of_length = S.Sums.of_length
    monkeypatch.setattr(S.Sums, "of_length", lambda self, n: of_length(self, n) % np.uint64(7))
    rng = random.Random(9)
    shared = [bytes(rng.choice(b"abcd") for _ in range(70)) for _ in range(4)]
    rows, data, want = np.zeros(40, S.ASK), [], set()
    first: dict = {}
    for i in range(40):
        text = rng.choice(shared)[rng.randrange(10) :][: rng.randint(50, 60)]
        rows[i]["doc"], rows[i]["at"], rows[i]["n"] = i // 2, 1000 * i, len(text) - 49
        data.append(text)
        for a in range(len(text) - 49):
            if first.setdefault(text[a : a + 50], i // 2) < i // 2:
                want.add((i // 2, 1000 * i + a))
    found = S.settle_texts(rows, np.frombuffer(b"".join(data), np.uint8), 50)
    assert {(int(r["doc"]), int(r["at"]) + k) for r in found for k in range(int(r["n"]))} == want


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_short_strings_collide_often(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 120)))) for i in range(60)]
    check(spark, rows, length=12, k=6)


def test_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 2)
    monkeypatch.setattr(S, "BATCH", 300)
    rng = random.Random(8)
    data, _ = brute(corpus(8, 40), 50)
    shares, groups = 7, 5
    rows = corpus(8, 80)
    table = pa.table({"doc": [i for i, _ in rows], "t": [0] * len(rows), "text": [(t or "").encode() for _, t in rows]}, schema=pa.schema([("doc", pa.int64()), ("t", pa.int64()), ("text", pa.binary())]))
    batches = list(S.index_batches(iter(table.to_batches(max_chunksize=7)), 50, 20, shares, groups))
    kinds = [k for b in batches for k in b.column(0).to_pylist()]
    assert kinds.count(S.WINDOW) > 0
    rng.shuffle(batches)
    scanned = []
    for share in range(shares):
        mine = [b.filter(pa.compute.equal(b.column(1), share)) for b in batches]
        scanned += list(S.scan_shares(iter([b.filter(pa.compute.equal(b.column(0), S.ENTRY)) for b in mine]), groups))
    whole = pa.Table.from_batches(batches + scanned, schema=S.BLOB_SCHEMA)
    pick = lambda t, *kinds: t.filter(pa.compute.is_in(t.column("kind"), pa.array(kinds, pa.int32())))
    assert len(pick(whole, S.SPOTTED)) > 0 and len(pick(whole, S.ASKED)) > 0
    pack = zstandard.ZstdCompressor()
    documents = pa.table({"doc_id": table["doc"], "t": table["t"], "packed": [pack.compress(x) for x in table["text"].to_pylist()]})
    attached = S.run_texts(50, groups)(documents, pick(whole, S.ASKED, S.SPOTTED))
    dealt = pa.Table.from_batches(list(S.deal(iter(attached.to_batches()), 50, 11, S.WINDOW_SHARES * shares, groups)), schema=S.BLOB_SCHEMA)
    dealt = pa.concat_tables([pick(whole, S.WINDOW), dealt])
    settled = []
    for share in range(max(11, S.WINDOW_SHARES * shares)):
        settled += list(S.settle(iter(dealt.filter(pa.compute.equal(dealt.column("bucket"), share)).to_batches(max_chunksize=3)), 50, groups))
    covered = pick(pa.concat_tables([whole, pa.Table.from_batches(settled, schema=S.BLOB_SCHEMA)]), S.COVERED)
    got = S.removed(50)(documents, covered).to_pylist()
    _, want = brute(rows, 50)
    for r in got:
        gone = [False] * r["n_bytes"]
        for s in r["spans"]:
            gone[s["start"] : s["end"]] = [True] * (s["end"] - s["start"])
        assert gone == want[r["doc_id"]], r["doc_id"]


def test_levels_grow_geometrically():
    family = S.LevelFamily()
    rng = np.random.default_rng(1)
    best = {}
    for i in rng.permutation(40):
        rows = np.zeros(50, S.RUN)
        rows["key"], rows["doc"], rows["n"] = rng.integers(0, 300, 50), i, 1
        rows["id"] = rows["key"] << 20
        rows = rows[np.argsort(S.sort_value(rows), kind="stable")]
        family.push(rows)
        for key in rows["key"].tolist():
            best[key] = min(best.get(key, 99), int(i))
        sizes = [len(v) for v, _ in family.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))
    left = np.concatenate([r for _, r in family.levels])
    assert {(int(r["key"]), int(r["doc"])) for r in left} == set(best.items())
    assert len(left) + sum(map(len, family.covered)) == 2000


def run_rows(*found):
    """Runs of one key whose ids share the bits in the sort value: (id, doc), in the order of the array."""
    rows = np.zeros(len(found), S.RUN)
    rows["key"], rows["n"] = 7, 1
    rows["id"], rows["doc"] = [i for i, _ in found], [d for _, d in found]
    return rows[np.lexsort((rows["id"], S.sort_value(rows)))]


def test_keys_of_very_many_runs_become_marks(monkeypatch):
    monkeypatch.setattr(S, "HOT_GROUP", 3)
    family = S.LevelFamily()
    for doc in range(6):
        family.push(run_rows((10 + doc, doc)))
    spotted = {int(r["doc"]) for rows in family.spotted for r in rows if r["n"]}
    several, hot = family.shared_keys()
    assert len(several) == 0 and len(spotted) > 3
    assert spotted | {int(r["doc"]) for r in hot if r["n"]} == set(range(6))


def test_unequal_runs_of_one_sort_value():
    y, x = 1, 2
    family = S.LevelFamily()
    for batch in ([(y, 2), (x, 3)], [(x, 10)], [(x, 5)], [(y, 1), (x, 3)]):
        rows = run_rows(*batch)
        assert len(np.unique(S.sort_value(rows))) == 1
        family.push(rows)
    covered = np.concatenate(family.covered)
    assert sorted(zip(covered["id"].tolist(), covered["doc"].tolist())) == [(y, 2), (x, 5), (x, 10)]
    left = np.concatenate([r for _, r in family.levels])
    assert sorted(zip(left["id"].tolist(), left["doc"].tolist())) == [(y, 1), (x, 3), (x, 3)]


def test_levels_equal_brute_force_on_sort_value_ties():
    rng = np.random.default_rng(4)
    family, best, total = S.LevelFamily(), {}, 0
    for doc in rng.permutation(60).tolist():
        rows = run_rows(*[(int(i), doc) for i in np.unique(rng.integers(0, 40, 20))])
        family.push(rows)
        total += len(rows)
        for i in rows["id"].tolist():
            best[i] = min(best.get(i, 99), doc)
    left = np.concatenate([r for _, r in family.levels])
    assert sorted(zip(left["id"].tolist(), left["doc"].tolist())) == sorted(best.items())
    assert len(left) + sum(map(len, family.covered)) == total


def test_equal_runs_leave_a_batch_on_sort_value_ties(monkeypatch):
    monkeypatch.setattr(S, "sort_value", lambda rows: rows["key"] << np.uint64(16))  # all runs of a key tie
    rows = corpus(5, 80)
    columns = [pa.array([i for i, _ in rows], pa.int64()), pa.array([0] * len(rows), pa.int64()), pa.array([t.encode() if t is not None else None for _, t in rows], pa.binary())]
    found = list(S.index_batches(iter([pa.RecordBatch.from_arrays(columns, ["doc", "t", "text"])]), 50, 20, 1, 1))
    entries = np.concatenate([S.decode(blob, S.RUN) for b in found for kind, blob in zip(b.column(0).to_pylist(), b.column(3)) if kind == S.ENTRY])
    documents = {}
    for r in entries[entries["n"] > 0]:
        documents.setdefault((int(r["key"]), int(r["id"])), set()).add(int(r["doc"]))
    assert all(len(d) == 1 for d in documents.values())


def test_blobs_round_trip():
    rng = np.random.default_rng(2)
    for dtype in (S.RUN, S.PLACE, S.ASK, S.SPOT):
        rows = np.zeros(500, dtype)
        for name in dtype.names:
            info = np.iinfo(dtype[name])
            rows[name] = rng.integers(info.min, info.max, 500, dtype=dtype[name], endpoint=True)
        blob = pa.scalar(S.encode(rows), pa.binary())
        assert (S.decode(blob, dtype) == rows).all()


def test_repeated_null_and_empty(spark):
    a = "the same long passage of text that is well over fifty bytes long, and more"
    rows = [(5, a), (5, a), (5, a + " other"), (9, a), (None, a), (None, None), (7, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, [tuple(s) for s in r.spans]) for r in S.suffix_dedup(df).collect())
    n = len(a)
    assert got == [((False, 5), n, []), ((False, 5), n, []), ((False, 5), n + 6, []), ((False, 7), 0, []), ((False, 9), n, [(0, n)]), ((True, 0), 0, []), ((True, 0), n, [])]
    assert S.suffix_dedup(df.filter(F.lit(False))).collect() == []
