import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrabrook.operators import places as PL
from terrabrook.operators.relational import csv_rows, leads, place_csv, strip_nul

from .payloads import PLACE, place, put


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(1, json.dumps(place())), (2, "not json"), (3, "[1,2]"), (4, json.dumps([None] * 6 + [[]])), (5, None), (6, json.dumps(put(place(), (6, 4), "wrong"))), (7, json.dumps(put(put(place(), (6, 84, 0), [[1, 5]]), (6, 9, 2), "3")))]
    return {r.id: r for r in PL.parse_places(spark.createDataFrame(rows, "id int, payload string")).collect()}


def test_golden_place(parsed):
    p = parsed[1]
    assert (p.title, p.category, p.categories, p.address) == ("Blue Heron", "Restaurant", ["Restaurant", "Bar", ""], "7 Quay Lane, Aldmere 5120")
    assert (p.cid, p.web_site, p.phone, p.plus_code) == ("70211", "http://heron.example/a b", "44 203117", "Q7HW+3V Aldmere")
    assert (p.review_count, p.review_rating, p.reviews_per_rating) == (118, 3.7, {1: 8, 2: 5, 3: 11, 4: 40, 5: 54})
    assert p.open_hours == {"Monday": ["3–4 pm"], "Tuesday": ["9–5"]}
    assert p.popular_times == {"Monday": {18: 64, 19: 71}, "Sunday": {9: 5}, "": {1: 2}}
    assert [(i.title, i.image) for i in p.images] == [("All", "https://img")] and [tuple(x) for x in p.reservations] == [("https://book", "book.example")]
    assert [tuple(x) for x in p.order_online] == [("https://order", "order.example")] and tuple(p.menu) == ("https://menu", "menu.example")
    assert p.owner.link.endswith("/8841") and p.complete_address.city == "Aldmere" and p.complete_address.country == "QX"
    assert [(a.id, [(o.name, o.enabled) for o in a.options]) for a in p.about] == [("svc", [("Delivery", True), ("Dine-in", False)]), ("empty", [])]
    assert p.error is None


def test_malformed_payloads_give_zero_values(parsed):
    for i in (2, 3, 5):
        assert parsed[i].error == "invalid json" and parsed[i].title == "" and parsed[i].review_count == 0
    assert parsed[4].error is None and parsed[4].categories == [] and parsed[4].reviews_per_rating == {k: 0 for k in range(1, 6)}
    assert parsed[6].review_rating == 0.0 and parsed[6].title == "Blue Heron"
    assert parsed[7].popular_times == {"Monday": {}} and parsed[7].latitude == 0.0


def test_short_pairs_and_clashing_names(spark):
    rows = [(1, json.dumps(put(place(), (6, 84, 0), [[1, [[5]]]]))), (2, json.dumps(put(place(), (6, 84, 0), [[1, [["x", 5]]]])))]
    got = {r.id: r for r in PL.parse_places(spark.createDataFrame(rows, "id int, payload string")).collect()}
    assert got[1].error == "short popular times" and got[2].error is None and got[2].popular_times is None
    with pytest.raises(ValueError, match="title"):
        PL.parse_places(spark.createDataFrame([("a", "b")], "title string, payload string"))


def test_search_errors(spark):
    bodies = {"g\nnope": "invalid json", "g\n[]": "empty data", "g\n[5]": "invalid business list", "g\n[[1,[2]]]": "empty business list", "g\n[[1,[2,[3]]]]": None}
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    assert [r.e for r in df.select(PL.search_errors(F.col("b")).alias("e")).collect()] == list(bodies.values())


def test_a_lead_needs_a_title(spark):
    df = PL.parse_places(spark.createDataFrame([(json.dumps(put(place(), (6, 11), "")),)], "payload string")).withColumn("emails", F.array().cast("array<string>"))
    assert leads(df).first().error == "title is empty"


def review(author="Ann", text="good", rating=5, image="//img.example/x", when=(2024, 3, 7), nested=True):
    r = []
    for path, value in {(1, 4, 5, 0): author, (1, 4, 5, 1): "https://pic", (2, 0, 0): rating, (2, 15, 0, 0): text}.items():
        put(r, path, value)
    put(r, (2, 2, 0, 1, 21, 6, 8), list(when))
    put(r, (2, 2, 0, 1, 21, 7), [image])
    return [r] if nested else r


def test_review_pages(spark):
    pages = [(1, ")]}'\n" + json.dumps([None, "next", [review(), review("", "x"), review("Bob", "bad", 1, "ab", (2024, 1))]])), (2, json.dumps([[review("Cy")], None, None])), (3, "[1]")]
    got = {r.id: r for r in PL.parse_review_pages(spark.createDataFrame(pages, "id int, payload string")).collect()}
    assert [(r.Name, r.Rating, r.Description, r.Images, r.When) for r in got[1].reviews] == [("Ann", 5, "good", ["img.example/x"], "2024-3-7"), ("Bob", 1, "bad", [], "")]
    assert got[1].next_token == "next" and [r.Name for r in got[2].reviews] == ["Cy"] and got[3].reviews == []


def test_search_pages(spark):
    b = []
    for path in [(11,), (13,), (7, 0), (4, 7), (4, 8), (9, 2), (9, 3), (178, 0, 0), (34, 4, 4), (30,), (10,), (203, 0)]:
        put(b, path, PLACE[path])
    put(b, (0,), "id1")
    put(b, (2,), ["7 Quay Lane", "Aldmere"])
    item = put([], (14,), b)
    body = json.dumps([[None, [["header"], item, item]]])
    got = PL.parse_search(spark.createDataFrame([(1, body), (2, ")]}'\n" + body), (3, ")]}'\n[[null,[1]]]"), (4, "[]\n" + body), (5, None)], "q int, payload string")).collect()
    assert sorted((r.q, r.position) for r in got) == [(2, 1), (2, 2), (4, 1), (4, 2)]
    r = got[0]
    assert (r.id, r.address, r.phone, r.web_site) == ("id1", "7 Quay Lane, Aldmere", "44203117", PLACE[7, 0]) and len(r.plus_code) == 11


json_values = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.text(max_size=3), lambda x: st.lists(x, max_size=4), max_leaves=12)


@settings(max_examples=3, deadline=None)
@given(st.lists(json_values, min_size=30, max_size=60))
def test_parsing_is_total(spark, trees):
    rows = [(i, json.dumps([0] * 6 + [t])) for i, t in enumerate(trees)]
    assert len(PL.parse_places(spark.createDataFrame(rows, "id int, payload string")).collect()) == len(rows)


def test_leads_csv_and_nul(spark):
    df = PL.parse_places(spark.createDataFrame([(json.dumps(place()),)], "payload string")).withColumn("emails", F.array(F.lit("a@x.example"), F.lit("b@x.example")))
    lead = leads(df).first()
    assert lead.source == "google_maps" and lead.description == "nice" and lead.error is None and lead.source_id == "0x2f:0xa1" and lead.email == "a@x.example" and lead.tags == ["Restaurant", "Bar", ""]
    assert "full_address" not in {a.name for a in lead.attributes} and {a.name: a.value for a in lead.attributes}["additional_emails"] == "b@x.example"
    row = csv_rows(df.select("title", "latitude", "open_hours", "review_count", "popular_times"), {"latitude": "lat"}).first()
    assert row.lat == "-12.250000" and row.review_count == "118" and json.loads(row.open_hours)["Tuesday"] == ["9–5"]
    table = place_csv(df)
    assert len(table.columns) == 34 and table.columns[7] == "website" and table.first().emails == "a@x.example, b@x.example" and table.first().descriptions == "nice"
    dirty = spark.createDataFrame([("a\0b", ["x\0"], {"k\0": "v\0"}, (1, "\0"))], "s string, a array<string>, m map<string,string>, t struct<n:int,s:string>")
    assert strip_nul(dirty).first().asDict(True) == {"s": "ab", "a": ["x"], "m": {"k": "v"}, "t": {"n": 1, "s": ""}}
    literal = spark.createDataFrame([("\\u0000",)], "s string")
    assert strip_nul(literal).first().s == "\\u0000"
