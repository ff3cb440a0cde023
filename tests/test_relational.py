import math
import random

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from terrabrook import catalogue, sources, sql
from terrabrook.functions import email, geo, url
from terrabrook.operators import relational as R
from terrabrook.plans import seeds

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 5) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_oracle(spark, con, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    want = con.sql(f"select {', '.join(columns)} from ({catalogue.ORACLES[name]})").fetchall()
    key = lambda r: tuple((x is None, str(plain(x))) for x in r)
    assert sorted(map(key, df.select(*columns).collect())) == sorted(map(key, want))


def beyond_the_shift(spark, folder, name, table, key, keys):
    """The query and its SQL over the table's first rows under the given keys."""
    con = duckdb.connect()
    rows = f"select * replace (k as {key}) from (select *, row_number() over (order by {key}) as i from '{DATA}/{table}.parquet') r join (select unnest({keys}) as k, generate_subscripts({keys}, 1) as i) using (i)"
    con.sql(f"copy (select * exclude (k, i) from ({rows})) to '{folder}/{table}.parquet' (format parquet)")
    con.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    df = catalogue.QUERIES[name](spark, str(folder))
    return sorted(map(tuple, df.collect())), sorted(con.sql(f"select {', '.join(df.columns)} from ({catalogue.ORACLES[name]})").fetchall())


def test_upsert_of_keys_beyond_the_shift(spark, tmp_path):
    """An order whose key is another's shifted one is no new job."""
    got, want = beyond_the_shift(spark, tmp_path, "upsert_last_wins", "orders", "o_orderkey", [5, 15, 1_000_005, 1_000_015, 2_000_015, 7])
    assert got == want and len(got) == 11


def test_insert_of_keys_beyond_the_shift(spark, tmp_path):
    """A customer whose key is another's shifted one doesn't stop that row, nor is it stopped."""
    got, want = beyond_the_shift(spark, tmp_path, "insert_ignore", "customer", "c_custkey", [4, 8, 100_004, 100_008, 200_004, 7])
    assert got == want and len(got) == 11


def test_entry(spark):
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize("text,error", [("47.10,8.40,47.30,8.62", None), ("-90.5,3,10,12", "minLat"), ("12,4,22,200", "maxLon"), ("inf,4,10,12", "finite"), ("6,0,2,9", "minLat must be less"), ("6,9,7,9", "minLon must be less"), ("1,2,3", "four")])
def test_bounding_boxes(text, error):
    if error is None:
        assert seeds.bounding_box(text) == (47.10, 8.40, 47.30, 8.62)
    else:
        with pytest.raises(ValueError, match=error):
            seeds.bounding_box(text)


def counted_cells(box, km):
    """Cells by walking the axes: centres below the far edge, and the spans rounded up."""
    south, west, north, east = box
    a, b = km / 111.32, km / (111.32 * max(math.cos(math.radians((south + north) / 2)), 1e-6))
    walk = lambda low, high, step: sum(1 for i in range(100_000) if low + step * (i + 0.5) < high)
    return walk(south, north, a) * walk(west, east, b), math.ceil((north - south) / a) * math.ceil((east - west) / b)


@pytest.mark.parametrize("box,km", [((12.5010, 45.2500, 12.5320, 45.2810), 0.25), ((88.70, 5.0, 88.75, 31.0), 1), ((47.10, 8.40, 47.30, 8.62), 1), ((-33.95, 151.10, -33.60, 151.40), 2)])
def test_grid_sizes(spark, box, km):
    generated, estimate = counted_cells(box, km)
    assert math.prod(seeds.axis_counts(box, km)) == generated and math.prod(seeds.axis_counts(box, km, True)) == estimate
    cells = seeds.grid_cells(spark, box, km).collect()
    assert len(cells) == generated and all(box[0] < c.lat < box[2] and box[1] < c.lon < box[3] for c in cells)


def test_seed_errors(spark):
    q = spark.createDataFrame([("1", "cafe")], "id string, text string")
    with pytest.raises(ValueError, match="zoom"):
        seeds.grid_seed_jobs(q, seeds.grid_cells(spark, catalogue.BOX, 1.0), 22)
    with pytest.raises(ValueError, match="coordinates"):
        seeds.seed_jobs(q, fast=True)
    assert seeds.seed_jobs(q, geo="1, 2").first().url.endswith("/search/cafe/@1,2,15z?hl=en")
    assert seeds.seed_jobs(q, geo="1, 2", fast=True, radius=5.0).first().parameters["q"] == "cafe"


def on_a_sphere(lat1, lon1, lat2, lon2):
    """Distance from the angle between two unit vectors."""
    v = [(math.cos(math.radians(a)) * math.cos(math.radians(b)), math.cos(math.radians(a)) * math.sin(math.radians(b)), math.sin(math.radians(a))) for a, b in ((lat1, lon1), (lat2, lon2))]
    return 6_371_000 * math.acos(sum(x * y for x, y in zip(*v)))


def code_of(lat, lon):
    """A plus code of ten digits, two by two from the largest cells."""
    out, cell, x, y = "", 20.0, lat + 90, lon + 180
    for _ in range(5):
        out += geo.CODE_ALPHABET[int(x // cell)] + geo.CODE_ALPHABET[int(y // cell)]
        x, y, cell = x % cell, y % cell, cell / 20
    return out[:8] + "+" + out[8:]


def test_distance_and_code(spark):
    d = spark.range(1).select(geo.haversine_m(*[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)]).alias("a"), geo.haversine_m(*[F.lit(x) for x in (12.5, 45.25, -33.9, 151.2)]).alias("b"), geo.plus_code(F.lit(12.50006), F.lit(45.25006)).alias("c")).first()
    assert abs(d.a - 111194.92664455874) < 1e-6 and abs(d.b - on_a_sphere(12.5, 45.25, -33.9, 151.2)) < 1e-3 and d.c == code_of(12.50006, 45.25006)


def test_mail_and_urls(spark):
    df = spark.createDataFrame([('<a href="mailto: a@x.example ">m</a> b@x.example',), ("b@x.example c@x.example b@x.example",), ("none",)], "h string")
    assert [r.e for r in df.select(email.page_emails(F.col("h")).alias("e")).collect()] == [["a@x.example"], ["b@x.example", "c@x.example"], []]
    u = spark.createDataFrame([("https://x.example/%zz",), (None,), ("/url?q=%2Fp",), ("/q",)], "u string").select(url.unwrap(F.col("u")).alias("a"), url.eligible_for_email(F.col("u")).alias("b"), url.normalized(F.col("u")).alias("c")).collect()
    assert [(r.a, r.b, r.c) for r in u] == [("https://x.example/%zz", True, "https://x.example/%zz"), (None, False, None), ("/p", True, "/p"), ("/q", True, "https://www.google.com/q")]


def test_sinks_and_sql(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 1.5)], "id int, t string, x double")
    for kind in ("csv", "json", "parquet"):
        sources.write_results(df, kind, str(tmp_path / kind))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().x == "1.500000"
    with pytest.raises(ValueError):
        sources.write_results(df, "nope", "x")
    good, bad = R.quarantined(spark.createDataFrame([("a\0",), ("b",), (None,)], "t string"), ["t"])
    assert good.count() == 2 and bad.count() == 1


def test_sql_functions_are_the_column_functions(spark):
    sql.register(spark)
    assert spark.sql("select haversine_m(0, 0, 0, 1) d").first().d == spark.range(1).select(geo.haversine_m(*[F.lit(float(x)) for x in (0, 0, 0, 1)]).alias("d")).first().d
    assert spark.sql("select count(*) n from grid_cells('47.10,8.40,47.30,8.62', 1.0D)").first().n == counted_cells((47.10, 8.40, 47.30, 8.62), 1)[0]
    given = ["/url?q=a%20b", "https://g.example/url?q=a%20b", None, "/x?place_id=7", "https://x.example/data=!1sab%21c!8m2"]
    rows = spark.createDataFrame([(u,) for u in given], "u string")
    got = rows.selectExpr("unwrap_url(u) a", "place_id(u) b", "site_eligible(u) c").collect()
    assert got == rows.select(url.unwrap(F.col("u")).alias("a"), url.place_id(F.col("u")).alias("b"), url.eligible_for_email(F.col("u")).alias("c")).collect()
    assert got[0].a == "a b" and got[1].a == given[1] and got[4].b == "ab!c"
    assert spark.sql("select extract_emails('a@x.example b') e, rating_histogram(array(1, 5, 5)) h, strip_nul(concat('a', char(0))) s, olc_encode(12.50006D, 45.25006D) o").first() == (["a@x.example"], {1: 1, 2: 0, 3: 0, 4: 0, 5: 2}, "a", code_of(12.50006, 45.25006))


def test_nested_nul_is_set_aside(spark):
    rows = [(["x"], {"k": "v"}, ("s",)), (["x\0"], {}, ("s",)), ([], {"k\0": "v"}, ("s",)), (None, {"k": "\0"}, None), (None, None, ("\0",)), (None, None, None)]
    good, bad = R.quarantined(spark.createDataFrame(rows, "a array<string>, m map<string,string>, t struct<s:string>"))
    assert (good.count(), bad.count()) == (2, 4)


def test_collector_runs(spark):
    events = [(1, "register"), (2, "add"), (3, "flush"), (4, "add"), (5, "register"), (6, "add"), (7, "add"), (8, "flush"), (9, "flush")]
    rows = [("a", *e) for e in events] + [("b", 1, "flush"), ("b", 2, "add"), ("b", 3, "register"), ("b", 4, "add"), ("c", 1, "register"), ("c", 2, "add"), ("c", 3, "register"), ("c", 4, "discard"), ("d", 1, "register"), ("d", 2, "flush"), ("e", 5, "flush")]
    got = sorted(map(tuple, R.collected(spark.createDataFrame(rows, "job_id string, seq long, op string")).collect()))
    assert got == [
        ("a", 1, 1, 1, "completed"), ("a", 2, 2, 0, "completed"), ("b", 0, 0, 1, "unregistered"), ("b", 1, 1, 0, "running"), ("c", 1, 1, 0, "replaced"), ("c", 2, 0, 0, "discarded"), ("d", 1, 0, 0, "failed"),
    ]


def test_touches_follow_the_last_touch(spark):
    hits = [("k", i, 40 * i) for i in range(9)] + [("l", 1, 0), ("l", 2, 60), ("l", 3, 61), (None, 1, 5)]
    df = spark.createDataFrame(hits, "k string, o long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted((r.k or "", r.o) for r in R.touches(df, "k", "ts", "o").collect())
    assert got == [("", 1), ("k", 0), ("k", 2), ("k", 4), ("k", 6), ("k", 8), ("l", 1), ("l", 3)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), max_size=60), st.integers(1, 9), st.integers(1, 12), st.sampled_from(["left", "right"]))
def test_replay_over_batches_of_any_cut(hits, size, width, side):
    rows = sorted((k, t, i) for i, (k, t) in enumerate(hits))
    want, state = [], {}
    for k, t, _ in rows:
        start, n = state.get(k, (None, 0))
        over = start is None or (t >= start + width if side == "left" else t > start + width)
        state[k] = (t, 1) if over else (start, n + 1)
        want.append((k, state[k][1], state[k][0]))
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64())], ["key", "o", "t"]) for part in (rows[i : i + size] for i in range(0, len(rows), size))]
    got = [(r["key"], r["n"], r["start"]) for b in R.replay_windows(iter(batches), width, side) for r in b.to_pylist()]
    assert got == want


def test_nearest_over_the_edges_of_the_map(spark):
    """Cells find what comparing every pair finds: over the antimeridian, at the poles, with small and huge radii."""
    rng = random.Random(5)
    spots = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(250)] + [(1000 + i, lat, lon) for i, (lat, lon) in enumerate([(90.0, 0.0), (-90.0, 10.0), (89.9, 179.9), (89.9, -0.1), (0.0, 180.0), (0.0, -180.0), (0.1, 179.95), (-89.5, -170.0), (10.0, 190.0)])]
    centres = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(25)] + [(100 + i, *c) for i, c in enumerate([(90.0, 50.0), (-90.0, 0.0), (0.0, -179.99), (0.0, 180.0), (89.95, 90.0), (60.0, -180.0)])]
    places = spark.createDataFrame([*spots, (5000, None, 1.0)], "place_id long, lat double, lon double")
    queries = spark.createDataFrame([*centres, (5001, 1.0, None)], "query_id long, q_lat double, q_lon double")
    distance = lambda a, b: 2 * 6_371_000 * math.asin(min(1.0, math.sqrt(math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2)))
    for radius in (30_000.0, 900_000.0, 6_000_000.0, 19_000_000.0, 30_000_000.0):
        want = {(q[0], p[0]) for q in centres for p in spots if distance(q, p) <= radius}
        assert {(r.query_id, r.place_id) for r in R.nearest_per_query(places, queries, radius, 10_000).collect()} == want
    got = R.nearest_per_query(places, queries, 6_000_000.0, 3).groupBy("query_id").count().collect()
    assert max(r["count"] for r in got) == 3


def test_json_text(spark):
    from terrabrook.functions.text import json_text

    df = spark.createDataFrame([({"10": {"b": 1, "a": 2}, "9": {}},), (None,)], "m map<string,map<string,int>>")
    kind = df.schema["m"].dataType
    assert [r.t for r in df.select(json_text(F.col("m"), kind).alias("t")).collect()] == ['{"10":{"a":2,"b":1},"9":{}}', "null"]
    assert spark.range(1).select(json_text(F.array(F.lit("<a> & b"))).alias("t")).first().t == '["\\u003ca\\u003e \\u0026 b"]'


def test_box_columns(spark):
    boxes = ["47.10,8.40,47.30,8.62", "-90.5,3,10,12", "12,4,22,200", "Infinity,4,10,12", "6,0,2,9", "6,9,7,9", "1,2,3", "a,1,2,3", None]
    for r in spark.createDataFrame([(b,) for b in boxes], "b string").select("b", seeds.box_columns(F.col("b")).alias("x")).collect():
        if r.b in (None, "a,1,2,3"):
            assert r.x.error
            continue
        try:
            assert (r.x.south, r.x.west, r.x.north, r.x.east) == seeds.bounding_box(r.b) and r.x.error is None
        except ValueError as error:
            assert r.x.error == str(error)


def test_blank_ids_and_empty_inputs(spark):
    q = spark.createDataFrame([("", "cafe"), (None, "bar"), ("7", "inn")], "id string, text string")
    ids = [r.id for r in seeds.seed_jobs(q).collect()]
    assert ids[2] == "7" and len(set(ids)) == 3 and all(ids)
    cells = seeds.grid_cells(spark, catalogue.BOX, 5.0)
    with pytest.raises(ValueError, match="queries"):
        seeds.grid_seed_jobs(q.filter("text = 'x'"), cells, 15)
    with pytest.raises(ValueError, match="cells"):
        seeds.grid_seed_jobs(q, cells.filter("lat > 90"), 15)
    with pytest.raises(ValueError, match="keywords"):
        seeds.keyword_chunks(q.filter("text = 'x'"), "text", "id")


def test_first_wins_can_be_off(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert R.first_wins(df, ["k"], ["v"]).count() == 1 and R.first_wins(df, ["k"], ["v"], enabled=False).count() == 2


def test_numbering_over_partitions(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k")).repartition(7)
    assert sorted((r.k, r.number) for r in seeds.numbered(df, ["k"]).collect()) == [(i, i) for i in range(1000)]
