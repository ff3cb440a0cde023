import random
import re

from pyspark.sql import functions as F

from terrabrook.llm import decontaminate as D


def words(rng, n):
    return " ".join("".join(rng.choice("aeioulnrstm") for _ in range(rng.randint(2, 7))) for _ in range(n))


def ids(found):
    return {(r.doc_id, r.item_id): r.changed for r in found.collect()}


def test_finds_copies_and_variants(spark):
    rng = random.Random(4)
    item = "Alice bought 12 apples for 3 dollars each and later Bob sold 12 of them to Alice at a market near the old town for 5 dollars"
    other = words(rng, 40)
    benchmark = spark.createDataFrame([(1, item), (2, other), (3, "one two three four five"), (4, "a b"), (5, None), (None, other)], "item_id long, text string")
    same = item.replace("Alice", "Maria").replace("Bob", "Ivan").replace("12", "30").replace(" 3 ", " 4 ").replace(" 5 ", " 9 ")
    mixed = item.replace("sold 12", "sold 30")
    docs = [
        (10, f"{words(rng, 30)}. {item} {words(rng, 9)}"), (11, f"{words(rng, 30)} {same}"), (12, f"{words(rng, 30)} {mixed}"), (13, words(rng, 200)), (14, item.upper().replace(",", "")), (15, other.replace(" ", "\n\n")),
        (16, " ".join(other.split()[5:19])), (17, " ".join(other.split()[5:16])), (18, "x one Two three: four five y"), (19, "one two three four six"), (20, None), (21, ""), (None, item), (22, "a b a b"), (10, words(rng, 30)),
    ]
    df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, h string").repartition(3)
    # capital letters say nothing in 14, whose words and numbers are the item's
    assert ids(D.contaminated(df, benchmark)) == {(10, 1): False, (11, 1): True, (14, 1): False, (15, 2): False, (16, 2): False, (18, 3): False, (None, 1): False}
    assert D.contaminated(df.filter(F.lit(False)), benchmark).collect() == []
    assert D.contaminated(df, benchmark.filter(F.lit(False))).collect() == []


def test_names_that_open_a_sentence(spark):
    item = "Tom has 3 apples. Sue gives Tom 4 more. How many apples does Tom have now?"
    short = "Mary sold seven red hats before noon. Who paid?"
    benchmark = spark.createDataFrame([(1, item), (2, short)], "item_id long, text string")
    renamed = item.replace("Tom", "Max").replace("Sue", "Ann")
    docs = [
        (10, renamed), (11, f"as he said, {renamed}"), (12, short.replace("Mary", "Olga")), (13, item), (14, renamed.replace("does Max", "does Ann")),
        (15, item.replace("Tom has", "There has")), (16, "Max ate 3 pears. Ann gives Max 4 more. How many does Max want now?"), (17, item.upper()),
    ]
    got = ids(D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark))
    assert {k for k in got if k[0] != 15} == {(10, 1), (11, 1), (12, 2), (13, 1), (17, 1)}
    assert got[10, 1] and got[12, 2] and not got[13, 1]
    assert (15, 1) in got  # its windows after the first word are a passage of the item


def test_items_that_are_mostly_numbers(spark):
    item = "2 4 8 16 32 and 64 128 256 512 1024 then 2048 4096 8192"
    docs = [(1, f"words before {item} and after"), (2, "2 4 8 16 32 and 64 128 256 512 1025 then 2048 4096 8192"), (3, "3 5 9 17 33 and 65 129 257 513 1025 then 2049 4097 8193")]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert ids(got) == {(1, 7): False}


def test_name_runs_are_one_slot(spark):
    item = "Late in town Alice sold seven red hats to Bob before Alice went home with nine coins in her bag"
    other = item.replace("Alice", "Mary Ann Smith").replace("Bob", "Old Tom")
    mixed = item.replace("Alice", "Mary Ann Smith", 1)
    docs = [(1, other), (2, f"some words and {other}"), (3, mixed)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item), (2, other + " and more")], "item_id long, text string")
    got = ids(D.contaminated(df, benchmark.filter("item_id = 1")))
    assert got == {(1, 1): True, (2, 1): True, (3, 1): False}  # in 3 the end stands word by word
    back = ids(D.contaminated(spark.createDataFrame([(5, item)], "doc_id long, text string"), benchmark.filter("item_id = 2")))
    assert back == {(5, 2): True}


def test_very_long_text(spark):
    rng = random.Random(5)
    item = words(rng, 30)
    text = f"{words(rng, 150_000)} {item} {words(rng, 50_000)}"
    df = spark.createDataFrame([(1, text), (1, text), (2, text[: len(text) // 2])], "doc_id long, text string")
    assert ids(D.contaminated(df, spark.createDataFrame([(3, item)], "item_id long, text string"))) == {(1, 3): False}


def reparameterised(rng, item):
    """The item with its numbers and names consistently exchanged."""
    names = ["Olga", "Ivan", "Mary Ann", "Priya", "Chen Wei", "Lucas"]
    new = {}

    def swap(m):
        w = m[0]
        if w not in new:
            new[w] = str(rng.randint(2, 99)) if w[0].isdigit() else names[len(new) % len(names)]
        return new[w]

    return re.sub(r"\d+|\b(?:Anna|Ben|Carl)\b", swap, item)


def test_recall_of_reparameterised_questions(spark):
    """Questions with names and numbers in a sentence of every other length, among other words; all are found, no stranger is."""
    rng = random.Random(11)
    items = []
    for i in range(120):
        part = lambda: words(rng, rng.randint(4, 9))
        who = rng.sample(["Anna", "Ben", "Carl"], 2)
        items.append((i, f"{who[0]} {part()} {rng.randint(2, 99)} {part()} {who[1]} {part()}. {who[1]} {part()} {rng.randint(2, 99)} {rng.choice(['kg', 'miles', 'hours'])} {part()}?"))
    docs = [(i, f"{words(rng, 40)}. {reparameterised(rng, t)} {words(rng, 20)}") for i, t in items] + [(1000 + i, words(rng, 80)) for i in range(100)]
    got = ids(D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == {(i, i): True for i, _ in items}


def templates(text):
    """Lists of (literal or None, value) of a text: names inside sentences, no names, names anywhere; sentences from their marks."""
    out = {"inside": [], "lowered": [], "opening": []}
    start, number = True, False
    for w in re.findall(r"[.!?:\n]|\d+(?:[.,]\d+)*|[^\W\d_]+", text or ""):
        if w in ".!?:\n":
            start = True
            continue
        unit = D.DIMENSION.get(w.lower()) if number else None
        for channel, places in out.items():
            if w[0].isdigit():
                places.append((None, w))
            elif unit:
                places.append((f"<{unit}>", ""))
            elif w[0].isupper() and (channel == "opening" or (channel == "inside" and not start)):
                if places and places[-1][0] == "name" and not start:
                    places[-1] = ("name", places[-1][1] + " " + w)
                else:
                    places.append(("name", w))
            else:
                places.append((w.lower(), ""))
        start, number = False, w[0].isdigit()
    return out


def brute_with_slots(docs, items):
    """Found pairs by comparing every window of every channel, place by place."""
    slot = lambda p: p[0] in (None, "name")
    found = set()
    for d, text in docs:
        a = templates(text)
        for i, item in items:
            b = templates(item)
            for channel in a:
                x, y = a[channel], b[channel]
                n = min(8, len(y))
                if n < 4:
                    continue
                usable = [j for j in range(len(y) - n + 1) if 2 * sum(map(slot, y[j : j + n])) <= n]
                lines = {}
                for k in range(len(x) - n + 1):
                    for j in usable:
                        if [p[0] if not slot(p) else p[0] or "num" for p in x[k : k + n]] == [p[0] if not slot(p) else p[0] or "num" for p in y[j : j + n]]:
                            lines.setdefault(k - j, {})[j] = [(q[1], p[1]) for p, q in zip(x[k : k + n], y[j : j + n]) if slot(p)]
                for hits in lines.values():
                    pairs = {z for v in hits.values() for z in v}
                    if len(hits) >= min(6, len(usable)) and len({w for w, _ in pairs}) == len(pairs):
                        found.add((d, i))
    return found


def test_brute_force_with_slots(spark):
    rng = random.Random(21)
    names = ["Anna", "Ben", "Carl", "Dora"]

    def sentence(n):
        return " ".join(rng.choice([rng.choice("aeiou") + rng.choice("bcdf"), rng.choice("aeiou") + rng.choice("bcdf"), rng.choice(names), "Ann Lee", str(rng.randint(1, 9)), f"{rng.randint(1, 9)} km"]) for _ in range(n)) + rng.choice([".", "?", ""])

    items = [(i, " ".join(sentence(rng.choice([3, 6, 9])) for _ in range(2))) for i in range(25)]
    docs = []
    for d in range(120):
        i, item = rng.choice(items)
        if rng.random() < 0.7:
            swap = dict(zip(names, rng.sample([*names, "Eva", "Finn", "Max Moritz"], 4)))
            item = re.sub("|".join(names), lambda m, swap=swap: swap[m[0]], item)
        if rng.random() < 0.5:
            add = rng.randint(1, 3)
            item = re.sub(r"\d", lambda m, add=add: str(int(m[0]) + add), item)
        docs.append((d, " ".join([sentence(5), item if rng.random() < 0.8 else item.lower(), sentence(4)])))
    got = ids(D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    want = brute_with_slots(docs, items)
    assert 30 < len(want) and want <= set(got)
    # the rest are windows of numbers, which match by their words
    texts = dict(docs)
    for d, i in set(got) - want:
        assert any(sum(map(str.isdigit, w)) >= 4 for w in ([x[0] for x in re.findall(r"\w+", dict(items)[i])][k : k + 8] for k in range(40))), (texts[d], dict(items)[i])


def brute(docs, items):
    """Pairs with MIN_HITS windows in line, by comparing all templates; texts without slots."""
    found = set()
    split = lambda t: [w.lower() for w in D.TOKEN.findall(t or "") if w not in ".!?:\n"]
    for d, text in docs:
        a = split(text)
        for i, item in items:
            b = split(item)
            n = min(D.WINDOW, len(b))
            need = min(D.MIN_HITS, len(b) - n + 1)
            lines = {}
            for x in range(len(a) - n + 1):
                for y in range(len(b) - n + 1):
                    if a[x : x + n] == b[y : y + n]:
                        lines.setdefault(x - y, set()).add(y)
            if n >= D.MIN_WORDS and any(len(v) >= need for v in lines.values()):
                found.add((d, i))
    return found


def test_brute_force(spark):
    rng = random.Random(9)
    items = [(i, words(rng, rng.choice([5, 10, 14, 30]))) for i in range(12)]
    docs = []
    for d in range(60):
        parts = [words(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(items)[1].split()
            a = rng.randrange(len(w))
            parts += [" ".join(w[a : a + rng.choice([4, 8, 12, 13, 14, 40])]), words(rng, 5)]
        docs.append((d, " ".join(parts)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = ids(D.contaminated(df, spark.createDataFrame(items, "item_id long, text string")))
    assert set(got) == brute(docs, items)
    assert not any(got.values())
