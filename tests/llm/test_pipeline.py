import os
import random
from collections import defaultdict

import corpus_pipeline as P
from terrabrook.llm import common
from terrabrook.llm.line_dedup import op5_line_dedup
from terrabrook.llm.packing import op3_best_fit_packing

from .test_decontaminate import brute as brute_found
from .test_line_dedup import brute as brute_lines
from .test_packing import encoding
from .test_quality import brute_verdicts
from .test_simhash import brute_components, brute_fingerprint


def corpus():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    items = [(i, line(30)) for i in range(4)]
    shared = "a line that many of the documents share"
    docs = []
    for i in range(60):
        parts = [line(40) for _ in range(3)]
        if i % 4 == 0:
            parts.insert(1, shared)
        if i % 15 == 3:
            parts.append(rng.choice(items)[1])
        docs.append("\n".join(parts))
    docs += [docs[1], docs[2] + " tail", "too short", docs[5].replace(" ", "*** "), None, "word " * 80]
    return [(i * 7 % 97, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(docs)], items


def brute(rows, items):
    verdict = brute_verdicts([r[:4] for r in rows])
    left = {i: t for i, t, *_ in rows if verdict[i][1]}
    left = {i: t for _, i, _, _, t in brute_lines(list(left.items()))}
    group = brute_components({i: brute_fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if group[i] == i}
    found = {d for d, _ in brute_found(list(left.items()), items)}
    return {i: t for i, t in left.items() if i not in found}


def test_stages_and_run(spark, tmp_path):
    rows, items = corpus()
    folder = str(tmp_path)
    spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    want = brute(rows, items)
    assert 0 < len(want) < len(rows) - 8
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
        docs.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {i: (t, len(t)) for i, t in want.items()}
    e = encoding()
    tokens = defaultdict(int)
    for r in P.run(spark, folder).collect():
        tokens[r.doc_id] += r.length
    assert dict(tokens) == {i: len(e.encode_ordinary(t)) + 1 for i, t in want.items()}


def test_empty_input(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_null_ids_and_clashing_names(spark, tmp_path):
    rng = random.Random(3)
    item = " ".join("".join(rng.choice("aeiours") for _ in range(5)) for _ in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, item, "x"), (None, "clean words", "y"), (4, f"so {item}", "z"), (5, "clean words", "w")], "doc_id long, text string, _t string")
    found = P.decontamination_stage(spark, docs, str(tmp_path))
    assert found.columns == docs.columns and sorted(r["_t"] for r in found.collect()) == ["w", "y"]


def test_nothing_is_left_behind(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    shared = common.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    P.run(spark, str(tmp_path)).count()
    new = [x for x in set(os.listdir(shared)) - before if not x.startswith("rdd-")]
    assert len(new) == 1 and os.listdir(f"{shared}/{new[0]}") == [str(len(P.STAGES) - 1)]


def test_one_row_of_repeated_doc_ids_stays(spark):
    rows = [(5, "one two three four five six"), (5, "one two three four five six"), (9, "other words stand here alone now"), (None, "x y z u v w")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id or 0) for r in P.near_duplicate_stage(spark, docs, "").collect()) == [0, 5, 9]


TEXTS = {
    "a": "alpha beta gamma delta epsilon zeta", "b": "one two three four five six seven", "c": "red orange yellow green blue indigo violet",
    "d": "mercury venus earth mars jupiter saturn", "e": "do re mi fa sol la ti do",
}


def test_distinct_texts_of_one_doc_id_stay(spark):
    rows = [(5, "a"), (5, "b"), (6, "c"), (7, "c"), (7, "d"), (None, "c"), (None, "e"), (None, "e"), (8, "d")]
    docs = spark.createDataFrame([(i, TEXTS[k], k) for i, k in rows], "doc_id long, text string, t string")
    left = P.near_duplicate_stage(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.t) for r in left.collect()) == [(0, "e"), (5, "a"), (5, "b"), (6, "c"), (7, "d")]


def test_other_results_stay_readable(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    packed, lines = op3_best_fit_packing(spark, str(tmp_path)), op5_line_dedup(spark, str(tmp_path))
    first = P.run(spark, str(tmp_path))
    n = P.run(spark, str(tmp_path)).count()
    assert first.count() == n and lines.count() == len(rows) and packed.select("doc_id").distinct().count() == len(rows)
