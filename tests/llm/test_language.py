import numpy as np
from pyspark.sql import functions as F

from terrabrook.llm import language as L

DATA = "/root/testdata/sf0.01"


def brute_kernel(a, b):
    pa, pb = set(L.places(a).tolist()), set(L.places(b).tolist())
    return len(pa & pb) / (len(pa) * len(pb)) ** 0.5


def test_scores_are_kernel_regression():
    texts = ["der hund und die katze", "the dog and the cat", "ein haus", "a house of the man", "die maus", "that mouse"]
    langs = ["de", "en"] * 3
    m = L.Model(np.packbits(L.presence(texts).astype(bool), axis=1), langs)
    kernel = np.array([[brute_kernel(a, b) for b in texts] for a in texts])
    order = [0, 2, 4, 1, 3, 5]
    got = m.kernel(L.presence(texts))
    assert np.allclose(got, kernel[:, order], atol=1e-5)
    assert [m.languages[i] for i in m.scores(texts).argmax(axis=1)] == langs


def test_coefficients_solve_the_ridge_problem(monkeypatch):
    """Against a minimiser found by another way: gradient steps on the squared error plus the kernel norm of the
    landmarks' expansion, with kernels from sets of places."""
    monkeypatch.setattr(L, "LANDMARKS", 3)
    rng = np.random.default_rng(2)
    words = {"aa": ["der", "und", "haus", "maus", "ein"], "bb": ["the", "and", "house", "mouse", "one"], "cc": ["el", "y", "casa", "raton", "uno"]}
    rows = [(" ".join(rng.choice(words[lang], 5)), lang) for lang in list(words) * 6]
    texts, langs = map(list, zip(*rows))
    m = L.Model(np.packbits(L.presence(texts).astype(bool), axis=1), langs)
    marks = [i for lang in words for i in [j for j, x in enumerate(langs) if x == lang][:3]]
    k_nm = np.array([[brute_kernel(a, texts[i]) for i in marks] for a in texts])
    k_mm = k_nm[marks]
    y = np.array([[1.0 if x == lang else -1.0 for lang in words] for x in langs])
    ridge = L.RIDGE * len(texts) / len(words) ** 2
    alpha, bias = np.zeros((len(marks), 3)), np.zeros(3)
    hessian = np.block([[k_nm.T @ k_nm + ridge * k_mm, k_nm.sum(axis=0)[:, None]], [k_nm.sum(axis=0)[None, :], np.array([[len(texts)]])]])
    step = 1 / np.linalg.eigvalsh(hessian)[-1]
    for _ in range(300_000):
        error = k_nm @ alpha + bias - y
        alpha -= step * (k_nm.T @ error + ridge * k_mm @ alpha)
        bias -= step * error.sum(axis=0)
    new = ["der maus und", "the mouse", "casa y el", "haus house", *texts]
    want = np.array([[brute_kernel(a, texts[i]) for i in marks] for a in new]) @ alpha + bias
    assert np.abs(m.scores(new) - want).max() < 0.02


def test_models_of_many_languages_stay_small(monkeypatch):
    """Blocks give what one matrix gives; landmarks are bounded in all, and travel as bits."""
    import pickle

    rng = np.random.default_rng(3)
    alphabet = list("abcdefghijklmnopqrstuvwxyz")
    langs = [f"l{i:02}" for i in range(40) for _ in range(4)]
    texts = ["".join(rng.choice(alphabet[i % 20 : i % 20 + 6], 40)) + lang for i, lang in enumerate(langs)]
    bits = np.packbits(L.presence(texts).astype(bool), axis=1)
    whole = L.Model(bits, langs).scores(texts[:9])
    monkeypatch.setattr(L, "BLOCK", 7)
    parts = L.Model(bits, langs)
    assert np.allclose(parts.scores(texts[:9]), whole, atol=1e-4)
    monkeypatch.setattr(L, "MARKS", 80)
    small = L.Model(bits, langs)
    assert len(small.bits) == 80
    small.scores(texts[:1])
    assert len(pickle.dumps(small)) < 80 * L.DIM // 8 + 50_000


def test_very_long_text(spark):
    train = spark.createDataFrame([("der hund und die katze im haus " * 3, "de"), ("the dog and the cat in the house " * 3, "en")], "text string, lang string")
    docs = spark.createDataFrame([(1, "the cat and the dog in " * 60_000), (2, "die katze und der hund " * 60_000)], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in L.identify_languages(docs, train).collect()} == {1: "en", 2: "de"}


def test_held_out_accuracy(spark):
    found = L.op1_language_id(spark, DATA)
    rows = found.join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if r.held_out and any(c.isalpha() for c in r.text)]
    assert 0.2 * len(rows) < len(held) < 0.5 * len(rows)
    assert sum(r.lang_pred == r.lang for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    train = spark.createDataFrame([("der und die", "de"), ("the and of", "en"), (None, "de"), ("x", None), ("123", "en")], "text string, lang string")
    docs = spark.createDataFrame([(1, "the cat of", "q"), (2, None, None), (3, "", ""), (4, "12 34!", "de"), (None, "und der", "de"), (1, "the cat of", "q")], "doc_id long, text string, lang_pred string")
    got = sorted((r.doc_id or 0, r.lang_pred, r.score) for r in L.identify_languages(docs, train).collect())
    assert [g[:2] for g in got] == [(0, "de"), (1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und")]
    assert got[1] == got[2] and got[3][2] == 0.0
    none = L.identify_languages(docs, train.filter(F.lit(False))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert L.identify_languages(docs.filter(F.lit(False)), train).collect() == []
