import random

import xxhash

from terrabrook.llm import simhash


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints):
    left, found = dict(prints), {}
    for start in sorted(left):
        if start in found:
            continue
        todo = [start]
        found[start] = start
        while todo:
            a = todo.pop()
            for b in left:
                if b not in found and (left[a] ^ left[b]).bit_count() <= 4:
                    found[b] = start
                    todo.append(b)
    return found


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_is_spark_xxhash64(spark):
    texts = ["one two Three four", "ÄB c d e f g", "", None, "a\x0bb\tc\n d", "x " * 9000]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    assert spark.sql("select xxhash64('one two three four') h").first().h == signed(xxhash.xxh64_intdigest(b"one two three four", 42))


def test_links_match_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    prints, x = {}, 0
    for family in range(12):
        x = rng.getrandbits(64)
        for _ in range(15):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 5, 6])))
            prints[len(prints)] = x
    prints |= {1000 + i: rng.getrandbits(64) for i in range(60)}
    df = spark.createDataFrame([(signed(v),) for v in prints.values()], "fp long").distinct()
    links = simhash.simhash_links(df)
    from terrabrook.llm.components import connected_components

    got = {r.node: r.component for r in connected_components(links).collect()}
    want = brute_components(prints)
    for a in prints:
        for b in prints:
            ca, cb = got.get(signed(prints[a]), signed(prints[a])), got.get(signed(prints[b]), signed(prints[b]))
            assert (ca == cb) == (want[a] == want[b])


def test_near_within_keys(monkeypatch):
    """Batches of any cut: exactly those with a near one of their key, and all of a key of more than CHECKED."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(simhash, "CHECKED", 5)
    rng = random.Random(7)
    rows = []
    for side in range(3):
        for key in range(40):
            base = rng.getrandbits(63)
            rows += [(side, key, base ^ sum(1 << b for b in rng.sample(range(63), rng.choice([0, 2, 9, 20])))) for _ in range(rng.choice([1, 1, 2, 3, 5, 6, 9]))]
    rows = sorted(set(rows))
    want = set()
    for side, key in {r[:2] for r in rows}:
        fps = [r[2] for r in rows if r[:2] == (side, key)]
        want |= set(fps) if len(fps) > 5 else {a for a in fps if any(a != b and (a ^ b).bit_count() <= 4 for b in fps)}
    for size in (1, 3, 7, 1000):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*p)], ["side", "key", "fp"]) for p in parts]
        assert {x for b in simhash.near_within_keys(iter(batches), 4) for x in b.column(0).to_pylist()} == want


def test_components_of_texts(spark):
    rng = random.Random(1)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(50)) for _ in range(400)) for _ in range(4)]
    texts = base + [b + " more" for b in base] + [base[0]] * 3 + ["", None, "one two"] + [base[1].replace("alpha1", "beta1")]
    rows = [(i * 3 % 17 + 100 * (i > 16), t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.simhash_components(df).collect()}
    prints = {i: brute_fingerprint(t) for i, t, _ in rows}
    want = brute_components(prints)
    assert got == {i: (prints[i], want[i]) for i in prints}


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).collect() == []
    df = spark.createDataFrame([(None, "a b"), (4, "a b"), (4, "a b")], "doc_id long, text string")
    assert sorted(r.component_id for r in simhash.simhash_components(df).collect()) == [4, 4, 4]
