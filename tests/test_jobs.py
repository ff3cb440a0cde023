import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from terrabrook import sources
from terrabrook.functions.html import feed_links_of
from terrabrook.operators import jobs, records


def test_feed_links():
    assert feed_links_of(None) == [] and feed_links_of("<a href='x'>") == []
    assert feed_links_of('<div role="feed"><div><div jsaction><a href="a"></a><a></a><a href="">e</a></div></div></div><div jsaction><a href="no"></a></div>') == ["a"]
    assert feed_links_of('<div role="feed" jsaction><a href="own"></a></div>') == []


def test_defaults_and_status(spark):
    df = spark.createDataFrame([("", 0, None), ("de", 5, 60)], "lang string, depth int, timeout int")
    assert [tuple(r) for r in jobs.with_defaults(df).collect()] == [("en", 1, 300), ("de", 5, 60)]
    counts = spark.createDataFrame([(0,), (3,)], "n int").select(jobs.timed_out_status(F.col("n")).alias("s"))
    assert [r.s for r in counts.collect()] == ["failed", "completed"]


def test_rendered_reviews_and_counts(spark):
    shown = "array<struct<author:string,picture:string,rating:double,text:string,images:array<string>,when:string>>"
    df = spark.createDataFrame([([("Ann", "p", 4.0, "t", ["i"], "w"), ("", "p", 1.0, "t", ["i"], "w")],), ([],)], f"rows {shown}")
    got = [r.r for r in df.select(jobs.rendered_reviews(F.col("rows")).alias("r")).collect()]
    assert [tuple(x) for x in got[0]] == [("Ann", "p", 4, "t", ["i"], "w")] and got[1] == []
    df, seen = jobs.counted(spark.range(5), "rows")
    df.collect()
    assert seen.get["rows"] == 5


def test_active(spark):
    df = spark.createDataFrame([("active", "1.1.1.1", None), ("failed", "1.1.1.1", None), ("active", "", None), ("active", "2.2.2.2", "x")], "status string, ip string, deleted_at string")
    assert [r.ip for r in jobs.active(df).collect()] == ["1.1.1.1"]


def test_lookups_with_clashing_names(spark):
    requests = spark.createDataFrame([(1, "good"), (2, "old"), (3, "none"), (4, None)], "id int, name string")
    keys = spark.createDataFrame([(7, "k7", "good", None), (8, "k8", "old", "2024-01-01")], "id int, name string, secret string, revoked_at string").withColumn("key_hash", F.sha2("secret", 256)).drop("secret")
    got = records.checked_keys(requests, F.col("name"), keys).collect()
    assert sorted(map(tuple, got)) == [(1, "good", 7, "k7", "ok"), (2, "old", None, None, "revoked"), (3, "none", None, None, "not found"), (4, None, None, None, "not found")]


def test_settings(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "key string")
    config = spark.createDataFrame([("a", "plain", False), ("b", "shown", True), ("d", "broken", True)], "key string, value string, encrypted boolean")
    config = config.withColumn("value", F.when(F.col("key") == "b", F.base64(F.aes_encrypt("value", F.lit("0123456789abcdef")))).otherwise(F.col("value")))
    found = records.settings(names, "key", config, lambda v: records.aes_decrypted(v, F.lit("0123456789abcdef")))
    assert sorted(map(tuple, found.collect())) == [("a", "plain"), ("b", "shown"), ("c", None), ("d", None)]
    assert {r.key: r.setting for r in records.settings(names, "key", config).collect()}["b"] is None


def test_expiry(spark):
    now = F.lit(datetime(2025, 1, 31))
    sessions = spark.createDataFrame([(1, datetime(2025, 1, 31)), (2, datetime(2025, 1, 30)), (3, None)], "id int, expires_at timestamp")
    assert [r.id for r in records.open_sessions(sessions, now).collect()] == [1, 3]
    asked = spark.createDataFrame([(1,), (2,), (9,), (None,)], "s int")
    assert {r.s: r.session_state for r in records.checked_sessions(asked, "s", sessions, now).collect()} == {1: "ok", 2: "expired", 9: "absent", None: "absent"}
    limits = spark.createDataFrame([(1, datetime(2025, 1, 30, 23)), (2, datetime(2025, 1, 30, 22, 59))], "id int, reset_at timestamp")
    assert [r.id for r in records.recent_limits(limits, now).collect()] == [1]
    rows = spark.createDataFrame([(1, "completed", datetime(2024, 12, 31)), (2, "completed", datetime(2025, 1, 2)), (3, "running", None), (4, "failed", datetime(2020, 1, 1))], "id int, state string, finalized_at timestamp")
    assert [r.id for r in records.unfinished_or_recent(rows, now).collect()] == [2, 3, 4]


def test_json_set(spark):
    docs = spark.createDataFrame([('{"a":{"b":[1]},"error":1}', 'say "no"'), (None, "x"), ("[1]", "y"), ("bad", None)], "d string, v string")
    got = [json.loads(r.o) for r in docs.select(records.json_set(F.col("d"), "error", F.col("v")).alias("o")).collect()]
    assert got == [{"a": {"b": [1]}, "error": 'say "no"'}, {"error": "x"}, {"error": "y"}, {"error": None}]


def test_pages_of_jobs(spark):
    rows = spark.createDataFrame([(i, ["available", "completed", "cancelled"][i % 3], datetime(2024, 1, 1 + i // 10)) for i in range(45)], "id long, state string, created_at timestamp")
    seen, cursor = [], None
    while True:
        page = records.job_page(rows, "completed", 6, cursor)
        seen += [r.id for r in page.rows]
        if not page.has_more:
            break
        cursor = page.next_cursor
    want = [r.id for r in records.all_jobs(rows, "completed").collect()]
    assert seen == want and len(want) == 15
    assert len(records.job_page(rows).rows) == 20 and records.job_page(rows.filter("id < 0")) == ([], None, False)
    with pytest.raises(ValueError, match="cursor"):
        records.job_page(rows, cursor="nonsense")
    with pytest.raises(ValueError, match="state"):
        records.job_page(rows, "done")


def test_rates_and_limits(spark):
    df = spark.createDataFrame([(10, 0.9), (10, 30.5), (0, 60.0)], "n int, up double")
    assert [r.r for r in df.select(records.average_rate(F.col("n"), F.col("up")).alias("r")).collect()] == [0.0, 20.0, 0.0]
    rows = spark.createDataFrame([(i, i) for i in range(5)], "k int, t int")
    assert [r.k for r in jobs.newest(rows, "t", "k", limit=2).collect()] == [4, 3] and jobs.newest(rows, "t", "k", limit=0).count() == 5


def test_results_by_job(spark, tmp_path):
    df = spark.createDataFrame([("j1", 'say "a, b"\nnext', 1.5), ("j2", "z", 2.0)], "job string, t string, x double")
    sources.write_csv(df.filter("job = 'j1'").drop("job"), f"{tmp_path}/j1.csv")
    assert sources.read_result(spark, str(tmp_path), "j1").first() == ('say "a, b"\nnext', "1.500000")
    with pytest.raises(FileNotFoundError):
        sources.read_result(spark, str(tmp_path), "j9")
    for bad in ("../j1", "a/b", "a\\b", ""):
        with pytest.raises(ValueError):
            sources.read_result(spark, str(tmp_path), bad)


def test_custom_writer_and_json(spark, tmp_path):
    seen = []
    sources.register_writer("mine", lambda df, path: seen.append((df.count(), path)))
    df = spark.createDataFrame([(1, None)], "a int, b string")
    sources.write_results(df, "mine", "here")
    assert seen == [(1, "here")]
    sources.write_results(df, "json", str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first().value == '{"a":1,"b":null}'


def test_boxes_of_a_column(spark):
    """Column form of counts and cells against the driver's, on the boxes of the contract, at a pole and without a cell."""
    from terrabrook.plans import seeds

    boxes = [("38.0077,23.6719,38.0257,23.6947", 0.5), ("89.90,0,89.95,20", 1.0), ("40.30,-3.80,40.50,-3.60", 1.0), ("52.34,13.09,52.68,13.76", 1.0), ("89.9,0,90,1", 5.0), ("0,0,0.001,0.001", 9.0), ("1,1,2,2", 0.0), ("5,5,4,6", 1.0)]
    df = spark.createDataFrame(boxes, "text string, km double").withColumn("box", seeds.box_columns(F.col("text")))
    good = df.filter("box.error is null")
    counts = {r.text: tuple(r[1:]) for r in good.select("text", *seeds.box_counts(F.col("box"), F.col("km")), *seeds.box_counts(F.col("box"), F.col("km"), True)).collect()}
    assert counts == {t: (*seeds.axis_counts(seeds.bounding_box(t), km), *seeds.axis_counts(seeds.bounding_box(t), km, True)) for t, km in boxes[:-1]}
    cells = seeds.cells_of_boxes(good.filter("km = 0.5"), "box", "km")
    near = lambda rows: sorted((r.lat_index, r.lon_index, round(r.lat, 9), round(r.lon, 9)) for r in rows)
    assert near(cells.collect()) == near(seeds.grid_cells(spark, seeds.bounding_box(boxes[0][0]), 0.5).collect()) and cells.count() == 16
    assert seeds.cells_of_boxes(good.filter("km = 9"), "box", "km").collect() == []


def test_place_ids_of_empty_marks(spark):
    from terrabrook.functions.url import place_id

    urls = {"x!1s!1sabc": "abc", "y!1s": "", "z?place_id=&place_id=q%20r&b": "q r", "m!1s!2d?place_id=k": "k", "0xaF:0x1": "0xaF:0x1", "n!1sa%2Fb!2": "a/b"}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.p for r in df.select("u", place_id(F.col("u")).alias("p")).collect()} == urls
