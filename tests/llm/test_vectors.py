import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrabrook.llm import vector_codes as C
from terrabrook.llm import whitening as W

DATA = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def sample(n=300, size=32, seed=5):
    rng = random.Random(seed)
    rows = [(i * 7 % 997, [rng.gauss(0, 0.2) for _ in range(size)], rng.choice([None, 1, 2]), "x") for i in range(n)]
    rows += [(rows[4][0], rows[4][1], 2, "x"), (5000, rows[4][1], None, "x"), (None, rows[9][1], 1, "x")]
    bad = [(0, None, 1, "x"), (1, [], 1, "x"), (2, [0.1] * (size - 1) + [None], 2, "x"), (3, [math.nan] + [0.2] * (size - 1), 2, "x"), (4, [math.inf] + [0.2] * (size - 1), 2, "x")]
    return rows, bad


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """Every part against every entry in plain integers."""
    rows = [(i, [math.floor(256 * float(np.float32(c))) for c in v], label) for i, v, label, _ in rows]
    w = len(rows[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    first = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in rows:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, labels = [], {}
    for i, v, label in rows:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        labels[label] = labels.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((-1 if i is None else i, code, error, labels[label], digest) for i, code, error, label in out))


def test_codes_equal_brute_force(spark, tmp_path):
    rows, bad = sample()
    spark.createDataFrame(rows + bad, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = C.op11_vector_codes(spark, str(tmp_path))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in found.collect()) == brute_codes(rows)


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_the_nearest_with_ties(seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-6, 6, (64, 1 + seed)) * (1 if seed % 2 else 10**6)
    entries[10:20] = entries[3]
    points = np.concatenate((rng.integers(-9, 9, (500, 1 + seed)) * (1 if seed % 2 else 10**6), entries))
    index, distance = C.VantageTree(entries).nearest(points)
    every = ((points[:, None] - entries) ** 2).sum(-1)
    assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_tree_leaves_branches_out():
    rng = np.random.default_rng(1)
    entries = rng.integers(-1000, 1000, (64, 2))
    seen = []

    class Counted(C.VantageTree):
        def visit(self, node, points, rows, found, best):
            seen.append(len(rows) * len(node.entries))
            super().visit(node, points, rows, found, best)

    Counted(entries).nearest(rng.integers(-1000, 1000, (1000, 2)))
    assert sum(seen) < 0.5 * 1000 * 64


def test_codes_of_empty_tables_and_errors(spark, tmp_path):
    _, bad = sample()
    for k, rows in enumerate(([], bad)):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{k}/embeddings.parquet")
        assert C.op11_vector_codes(spark, f"{tmp_path}/{k}").collect() == []
        assert W.op13_whitening(spark, f"{tmp_path}/{k}").collect() == []
    for rows in ([(1, [0.5] * 16, 1, "")], [(1, [0.5] * 32, 1, ""), (2, [0.5] * 32, 1, "")]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert {r.code for r in C.compress(df)[0].collect()} == {"00" * 16}
    for rows in ([(1, [0.5] * 17, 1, "")], [(1, [0.5] * 16, 1, ""), (2, [0.5] * 32, 1, "")]):
        with pytest.raises(ValueError, match="entries"):
            C.compress(spark.createDataFrame(rows, SCHEMA))


def test_codes_equal_sql(spark):
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    want = db.execute(C.OP11_SQL).fetchall()
    assert sorted(map(tuple, C.op11_vector_codes(spark, DATA).collect())) == sorted(want)


def check_whitening(rows, found, components=32):
    """rows: id, entries. Each row's whitened vector and all one-valued columns against numpy on the exact integers."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows])
    n, total = len(x), x.sum(0)
    centred = (n * x - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, x.shape[1])
    white = centred @ vectors[:, :k] / np.sqrt(values[:k])
    want = sorted((i, int((d * d).sum())) for (i, _), d in zip(rows, n * x - total, strict=True))
    assert len(found) == n * k and {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, k + 1))
    assert sorted((r.vec_id, r.deviation) for r in found if r.component == 1) == want
    by_id = {i: w for (i, _), w in zip(rows, white, strict=True)}
    signs = {}
    for r in found:
        other = by_id[r.vec_id][r.component - 1]
        if abs(other) > 0.1:
            signs.setdefault(r.component, set()).add(math.copysign(1, r.whitened * other))
        assert abs(abs(r.whitened) - abs(other)) < 1e-6
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
    assert all(len(s) == 1 for s in signs.values())
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_whitening_equals_numpy(spark, tmp_path):
    rows, bad = sample(size=8)
    rows = [r for r in rows if r[0] is not None and r[0] != rows[4][0] or r is rows[4]]
    spark.createDataFrame(rows + bad, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = W.op13_whitening(spark, str(tmp_path))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening([r[:2] for r in rows], found.collect())


def test_whitening_of_the_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    check_whitening(rows, W.op13_whitening(spark, DATA).collect())


def test_whitening_without_full_rank(spark, tmp_path):
    rng = random.Random(2)
    thin = [(i, [a, -a, 0.5, b, a + b], 1, "") for i in range(40) for a, b in [(rng.randint(-20, 20) / 64, rng.randint(-20, 20) / 64)]]
    for k, (rows, components) in enumerate(((thin, 2), ([(1, [0.5, 0.1], 1, "")] * 3, 0), (thin[:2], 1))):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{k}/embeddings.parquet")
        found = W.op13_whitening(spark, f"{tmp_path}/{k}").collect()
        assert len(found) == components * len(rows) and all(r.identity_error < 1e-4 and abs(r.whitened) < 10 for r in found)
        assert not found or abs(sum({r.component: r.explained for r in found}.values()) - 1) < 1e-6
    empty = W.whiten(spark.createDataFrame([(1, [0.5, 0.1], 1, "")], SCHEMA))
    assert empty.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"] and empty.filter(F.lit(True)).collect() == []
    with pytest.raises(ValueError, match="entries"):
        W.whiten(spark.createDataFrame([(1, [0.5], 1, ""), (1, [0.5, 0.5], 1, "")], SCHEMA))
