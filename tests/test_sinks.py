import glob
import json
import os
import sqlite3
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from terrabrook import sources
from terrabrook.operators.places import parse_places
from terrabrook.sources import tables

from .payloads import place, put

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ODD = ['say "a, b"\nnext', "", " spaced ", "back\\slash", "a\r\nb", "tab\t,;'", 'quote"', "\n", "é ü", '\\"']


def test_parts_of_other_jobs_stay(spark, tmp_path):
    folder = f"{tmp_path}/parts"
    a = spark.createDataFrame([("a", t, float(i)) for i, t in enumerate(ODD)], "job string, t string, x double")
    sources.write_parts(a.repartition(3), folder, "job")
    sources.write_parts(spark.createDataFrame([("b b%:", "one", 1.0), ("c", "two", 2.0)], "job string, t string, x double"), folder, "job")
    sources.write_parts(a.filter("x = 0").withColumn("t", F.lit("second part")), folder, "job", 1)
    got = [(r.part, r.t, r.x) for r in sources.read_parts(spark, folder, "a").collect()]
    assert sorted(got) == sorted([(0, t, f"{i}.000000") for i, t in enumerate(ODD)] + [(1, "second part", "0.000000")])
    assert [r.t for r in sources.read_parts(spark, folder, "a", [1]).collect()] == ["second part"]
    assert [tuple(r) for r in sources.read_parts(spark, folder, "b b%:").collect()] == [("one", "1.000000", 0)]


def test_a_part_written_again_replaces_that_part(spark, tmp_path):
    folder = f"{tmp_path}/parts"
    frame = lambda *rows: spark.createDataFrame(rows, "job string, t string")
    sources.write_parts(frame(("a", "old"), ("b", "b")), folder, "job")
    sources.write_parts(frame(("a", "new")), folder, "job")
    read = lambda job: [r.t for r in sources.read_parts(spark, folder, job).collect()]
    assert (read("a"), read("b")) == (["new"], ["b"])
    assert len(glob.glob(f"{folder}/data/*/job=a/*.csv")) == 1
    failing = frame(("a", "x"), ("b", "y")).withColumn("t", F.when(F.col("job") == "b", F.raise_error(F.lit("broken"))).otherwise(F.col("t")))
    with pytest.raises(Exception, match="broken"):
        sources.write_parts(failing, folder, "job")
    for bad in ("", None, "../x"):
        with pytest.raises(Exception, match="job id|invalid file name"):
            sources.write_parts(frame(("a", "x"), (bad, "y")), folder, "job")
    assert (read("a"), read("b")) == (["new"], ["b"])
    sources.delete_parts(spark, folder, "a")
    with pytest.raises(FileNotFoundError):
        sources.read_parts(spark, folder, "a")
    assert read("b") == ["b"]


def places_with(spark, titles):
    rows = [(json.dumps(put(place(), (6, 11), t)),) for t in titles]
    return parse_places(spark.createDataFrame(rows, "payload string")).withColumn("emails", F.array().cast("array<string>"))


def service(folder, bad=()):
    """A service that creates the leads of a key once, and refuses names in bad; its log has a line for each call."""

    def create(rows, key):
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/calls", "a") as calls:
            calls.write(f"{len(rows)}\n")
        failed = {i: f"no {r['name']}" for i, r in enumerate(rows) if r["name"] in bad}
        path = f"{folder}/{key}.json"
        if not os.path.exists(path):
            with open(path, "w") as out:
                json.dump([r["name"] for i, r in enumerate(rows) if i not in failed], out)
        return failed

    return create


def created(folder):
    return sorted(n for f in glob.glob(f"{folder}/*.json") for n in json.load(open(f)))


def test_leads_are_sent_once(spark, tmp_path):
    names = [f"t{i}" for i in range(17)]
    box, ledger = f"{tmp_path}/box", f"{tmp_path}/ledger"
    places = places_with(spark, names)
    failed = sources.deliver_leads(places, service(box, {"t3", "t5"}), ledger, "job-1", batch=3, tasks=2)
    assert sorted((r.name, r.message) for r in failed.collect()) == [("t3", "no t3"), ("t5", "no t5")]
    failed.count(), failed.collect()  # reading the failures sends nothing
    calls = len(open(f"{box}/calls").readlines())
    assert calls <= 7 and created(box) == sorted(set(names) - {"t3", "t5"})
    again = sources.deliver_leads(places.unionByName(places_with(spark, ["new"])), service(box, {"t5"}), ledger, "job-1", batch=3, tasks=2)
    assert [r.name for r in again.collect()] == ["t5"]
    assert created(box) == sorted(set(names) - {"t5"} | {"new"})
    assert sources.deliver_leads(places, service(f"{tmp_path}/other"), ledger, "job-2", tasks=1).collect() == [] and len(created(f"{tmp_path}/other")) == 17
    with pytest.raises(Exception, match="title is empty"):
        sources.deliver_leads(places_with(spark, ["a", ""]), service(box), ledger, "job-3")
    with pytest.raises(ValueError):
        sources.deliver_leads(places, service(box), ledger, "../x")


def test_a_retried_task_sends_nothing_twice(tmp_path):
    """A task dies after its second bulk and runs again: a session of its own, since local[n] retries nothing."""
    script = f"""
        import os, sys
        sys.path.insert(0, {HOME!r})
        os.environ["PYTHONPATH"] = {HOME!r}
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        from terrabrook import sources
        from tests.test_sinks import created, places_with, service
        inner, flag = service("{tmp_path}/box"), "{tmp_path}/died"
        def create(rows, key):
            done = inner(rows, key)
            if len(open("{tmp_path}/box/calls").readlines()) == 2 and not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("the worker dies")
            return done
        names = [f"t{{i}}" for i in range(12)]
        failed = sources.deliver_leads(places_with(spark, names), create, "{tmp_path}/ledger", "j", batch=3, tasks=1).collect()
        assert os.path.exists(flag) and failed == [], failed
        assert created("{tmp_path}/box") == sorted(names), created("{tmp_path}/box")
        keys = [r.key for r in sources.read_ledger(spark, "{tmp_path}/ledger", "j").collect()]
        assert len(set(keys)) == 12
        print("ALL RIGHT")
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=240, cwd=HOME)
    assert "ALL RIGHT" in out.stdout, out.stderr[-2000:]


def forget_last_batch(state):
    """As if the driver had died after a batch was written and before it was noted."""
    last = max(int(os.path.basename(f)) for f in glob.glob(f"{state}/commits/[0-9]*"))
    os.remove(f"{state}/commits/{last}")
    os.remove(f"{state}/commits/.{last}.crc")


def lines(folder):
    return sorted(json.loads(x)["id"] for f in glob.glob(f"{folder}/*.json") for x in open(f))


def test_registered_format_commits_and_aborts(spark, tmp_path):
    sources.register_sink(spark, "lines", sources.FolderSink)
    folder = f"{tmp_path}/out"
    spark.range(10).repartition(3).write.format("lines").mode("append").option("path", folder).save()
    assert lines(folder) == list(range(10)) and os.listdir(f"{folder}/_staged") == []
    bad = spark.range(10, 20).repartition(3).withColumn("id", F.when(F.col("id") == 15, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        bad.write.format("lines").mode("append").option("path", folder).save()
    assert lines(folder) == list(range(10)) and os.listdir(f"{folder}/_staged") == []
    spark.range(3).write.format("lines").mode("append").option("path", folder).save()
    assert lines(folder) == sorted([*range(10), *range(3)])
    spark.range(2).write.format("lines").mode("overwrite").option("path", folder).save()
    assert lines(folder) == [0, 1]


def test_registered_format_of_a_stream(spark, tmp_path):
    sources.register_sink(spark, "lines", sources.FolderSink)
    for k in range(3):
        spark.range(k * 10, k * 10 + 5).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    start = lambda: stream.writeStream.format("lines").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    start().awaitTermination()
    want = [k * 10 + i for k in range(3) for i in range(5)]
    assert lines(f"{tmp_path}/out") == want
    forget_last_batch(f"{tmp_path}/state")
    start().awaitTermination()
    assert lines(f"{tmp_path}/out") == want


def store(path, batch=50, statement="INSERT INTO results (id, data) VALUES (?, ?)"):
    return tables.TableStore(lambda: sqlite3.connect(path, timeout=60), statement, ("id", "data"), batch, "?")


def prepared(path):
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE results (id INTEGER, data TEXT CHECK (data NOT LIKE '%poison%'))")
    return path


def rows_of(path, table="results", columns="id"):
    return sorted(r[0] if columns == "id" else r for r in sqlite3.connect(path).execute(f"SELECT {columns} FROM {table}"))


def test_refused_rows_stand_alone(tmp_path):
    """A batch of 50 with three bad rows stores 47, in a number of statements that follows the logarithm."""
    path = prepared(f"{tmp_path}/db")
    rows = [(i, "poison" if i in (3, 4, 40) else f"d{i}") for i in range(50)]
    tried = []

    class Cursor(sqlite3.Cursor):
        def executemany(self, statement, given):
            tried.append(len(given))
            return super().executemany(statement, given)

    db = sqlite3.connect(path)
    refused = tables.insert_or_split(db.cursor(Cursor), "INSERT INTO results VALUES (?, ?)", rows, tables.of_a_row)
    db.commit()
    assert [r for (r, _), _ in refused] == [3, 4, 40] and "CHECK" in refused[0][1]
    assert rows_of(path) == [i for i in range(50) if i not in (3, 4, 40)] and len(tried) < 30
    with pytest.raises(sqlite3.OperationalError):
        tables.insert_or_split(db.cursor(), "INSERT INTO nowhere VALUES (?, ?)", rows, tables.of_a_row)


def test_rows_are_stored_once(spark, tmp_path):
    path = prepared(f"{tmp_path}/db")
    df = spark.createDataFrame([(i, "poison" if i % 50 == 7 else f"d{i}") for i in range(200)], "id int, data string")
    for _ in range(2):
        tables.store_rows(df.repartition(3), store(path, 10), "run-1", parts=5)
    assert rows_of(path) == [i for i in range(200) if i % 50 != 7]
    assert sorted(json.loads(c)["id"] for c, in rows_of(path, "refused_rows", "content")) == [7, 57, 107, 157]
    tables.store_rows(df.limit(1), store(path), "run-2", parts=5)
    assert len(rows_of(path)) == 197


def test_a_failed_write_is_completed(spark, tmp_path):
    path, flag = prepared(f"{tmp_path}/db"), f"{tmp_path}/flag"

    class Dying(tables.TableStore):
        """Refuses to go on at one row until the flag is there."""

    def refuses(error):
        if os.path.exists(flag):
            return tables.of_a_row(error)
        raise RuntimeError("the connection is gone")

    df = spark.createDataFrame([(i, "poison" if i == 60 else f"d{i}") for i in range(100)], "id int, data string")
    one = Dying(lambda: sqlite3.connect(path, timeout=60), "INSERT INTO results (id, data) VALUES (?, ?)", ("id", "data"), 10, "?", refuses)
    with pytest.raises(Exception, match="connection is gone"):
        tables.store_rows(df, one, "run", parts=6)
    assert len(rows_of(path)) < 99
    open(flag, "w").close()
    tables.store_rows(df, one, "run", parts=6)
    assert rows_of(path) == [i for i in range(100) if i != 60]


def test_a_replayed_micro_batch_is_skipped(spark, tmp_path):
    path = prepared(f"{tmp_path}/db")
    for k in range(3):
        spark.createDataFrame([(k * 10 + i, f"d{i}") for i in range(5)], "id int, data string").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema("id int, data string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")

    def run():
        query = tables.stream_to_table(stream, store(path), f"{tmp_path}/state", "places", "0 seconds", parts=2)
        query.processAllAvailable()
        query.stop()

    run()
    want = [k * 10 + i for k in range(3) for i in range(5)]
    assert rows_of(path) == want
    forget_last_batch(f"{tmp_path}/state")
    run()
    assert rows_of(path) == want


def test_jdbc_append_sets_nul_rows_aside(spark, tmp_path):
    """An embedded Derby database, in the JVM."""
    url = f"jdbc:derby:{tmp_path}/derby;create=true"
    df = spark.createDataFrame([(1, "a"), (2, "b\x00"), (3, None)], "id int, data string")
    bad = sources.write_jdbc(df, url, "results", driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert [r.id for r in bad.collect()] == [2]
    stored = spark.read.format("jdbc").option("url", url).option("dbtable", "results").option("driver", "org.apache.derby.jdbc.EmbeddedDriver").load()
    assert sorted((r[0], r[1]) for r in stored.collect()) == [(1, "a"), (3, None)]
