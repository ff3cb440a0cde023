import sqlite3
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrabrook import catalogue
from terrabrook import streaming as S
from terrabrook.operators import relational as R
from terrabrook.streaming import event_stream, run_available, run_every, state_store, stream_collector, stream_counts
from terrabrook.streaming.barrier import Barrier, observed, run_until_done
from terrabrook.streaming.queue import QueueTable, read_queue

DATA = "/root/testdata/sf0.001"


def test_stream_limiter_equals_batch(spark):
    batch = R.fixed_windows(spark.read.parquet(f"{DATA}/events.parquet"), "user_id", "ts", "event_id", 86400, 3).select("user_id", "event_id", "counter", "allowed")
    stream = catalogue.QUERIES["stream_rate_limit"](spark, DATA)
    assert sorted(map(tuple, stream.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_session_counts_over_files(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:30"), (2, "2024-01-01 00:01:00"), (1, "2024-01-01 01:00:00"), (9, "2024-01-02 00:00:00")]
    for i, (job, ts) in enumerate(rows):
        spark.createDataFrame([(job, ts)], "job long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    schema = T.StructType([T.StructField("job", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    found = []
    stream = stream_counts(event_stream(spark, f"{tmp_path}/in/*", schema, "ts"), "job", "ts", "0 seconds", "5 minutes")
    run_available(stream.select("job", "result_count"), f"{tmp_path}/state", lambda df, _: found.extend(map(tuple, df.collect())))
    assert sorted(found) == [(1, 1), (1, 2), (2, 1)]


def test_stream_collector_equals_batch(spark):
    """On every column, over several micro-batches; a run that is still open has no row yet."""
    events = catalogue.collector_events(spark.read.parquet(f"{DATA}/events.parquet"))
    batch = R.collected(events).filter("status <> 'running'")
    stream = catalogue.QUERIES["stream_collector"](spark, DATA)
    assert sorted(map(tuple, stream.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    assert stream.agg(F.sum("dropped")).first()[0] > 0


def test_stream_collector_times_out(spark, tmp_path):
    rows = [("a", 1, "register", "2024-01-01 00:00:00"), ("a", 2, "add", "2024-01-01 00:01:00"), ("b", 1, "register", "2024-01-01 00:00:00"), ("z", 1, "register", "2024-01-01 02:00:00"), ("z", 2, "add", "2024-01-01 03:00:00")]
    for i, part in enumerate((rows[:3], rows[3:4], rows[4:])):
        spark.createDataFrame(part, "job_id string, seq long, op string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    schema = T.StructType([T.StructField("job_id", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()), T.StructField("ts", T.TimestampNTZType())])
    found = []
    with state_store(spark):
        timed = stream_collector(event_stream(spark, f"{tmp_path}/in/*", schema, "ts"), "ts", "0 seconds", timeout_s=600)
        run_available(timed, f"{tmp_path}/state", lambda df, _: found.extend(map(tuple, df.collect())), "append")
    assert sorted(f for f in found if f[0] != "z") == [("a", 1, 1, 0, "completed"), ("b", 1, 0, 0, "failed")]


def test_state_store_is_set_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with state_store(spark):
        assert spark.conf.get(name).endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(name, None) == before


def test_run_every(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    found = []
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    query = run_every(stream, f"{tmp_path}/state", lambda df, _: found.extend(r.id for r in df.collect()), "1 second")
    query.processAllAvailable()
    query.stop()
    assert sorted(found) == [0, 1, 2]


class Handle:
    """A driven stand-in of Spark's state: values, timers and a clock."""

    def __init__(self):
        self.value, self.timers, self.now = None, [], 0

    def getValueState(self, name, schema, ttlDurationMs=None):  # noqa: N802, N803
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):  # noqa: N802
        return iter([(t,) for t in self.timers])

    def deleteTimer(self, t):  # noqa: N802
        self.timers.remove(t)

    def registerTimer(self, t):  # noqa: N802
        self.timers.append(t)

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now


class Job:
    """One job's collector under a driven clock, in seconds."""

    def __init__(self, timeout_s, grace_s=90):
        self.handle = Handle()
        self.collector = S.Collector(timeout_s * 1000, grace_s * 1000, True)
        self.collector.init(self.handle)
        self.seq = 0

    def events(self, now, *events):
        self.handle.now = now * 1000
        rows = []
        for op, t in events:
            self.seq += 1
            rows.append((self.seq, {"register": S.REGISTER, "add": S.ADD, "discard": S.DISCARD, "flush": S.FLUSH}[op], t * 1000))
        out = self.collector.handleInputRows(("j",), iter([pd.DataFrame(rows, columns=["seq", "op", "t"])]), self.handle)
        return [tuple(r)[1:] for part in out for r in part.itertuples(index=False)]

    def wait(self, now):
        self.handle.now = now * 1000
        out = []
        for timer in [t for t in self.handle.timers if t <= self.handle.now]:
            self.handle.timers.remove(timer)
            out += [tuple(r)[1:] for part in self.collector.handleExpiredTimer(("j",), self.handle, None) for r in part.itertuples(index=False)]
        return out


def test_silent_jobs_end_after_timeout_and_grace():
    job = Job(600)
    assert job.events(0, ("register", 0), ("add", 10)) == [] and job.wait(600) == [] and job.wait(689) == []
    assert job.wait(690) == [(1, 1, 0, "completed")]
    empty = Job(600)
    empty.events(0, ("register", 0))
    assert empty.wait(690) == [(1, 0, 0, "failed")]
    assert empty.wait(5000) == [] and empty.events(5001, ("flush", 5001)) == []


def test_grace_counts_results_of_the_job_s_time():
    job = Job(600)
    job.events(0, ("register", 0), ("add", 10))
    assert job.events(650, ("add", 599), ("add", 601)) == [(1, 0, 1, None)]
    assert job.wait(690) == [(1, 2, 0, "completed")]
    assert job.events(700, ("add", 599)) == [(1, 0, 1, None)]


def test_a_flush_or_a_new_run_sets_the_timer_anew():
    job = Job(600)
    assert job.events(0, ("register", 0), ("add", 1), ("flush", 2)) == [(1, 1, 0, "completed")] and job.handle.timers == []
    assert job.events(100, ("register", 100)) == [] and job.handle.timers == [790_000]
    assert job.events(200, ("add", 200), ("register", 200)) == [(2, 1, 0, "replaced")] and job.handle.timers == [890_000]
    assert job.events(300, ("discard", 300), ("add", 301)) == [(3, 0, 1, None), (3, 0, 0, "discarded")] and job.handle.timers == []


def test_ties_follow_the_batch_rules(spark):
    rows = [("a", 1, "register"), ("a", 2, "add"), ("a", 2, "flush"), ("a", 3, "add"), ("a", 3, "register"), ("a", 4, "flush"), ("a", 4, "discard")]
    batch = R.collected(spark.createDataFrame(rows, "job_id string, seq long, op string")).collect()
    job = Job(600)
    code = {"register": S.REGISTER, "add": S.ADD, "discard": S.DISCARD, "flush": S.FLUSH}
    frame = pd.DataFrame([(seq, code[op], 0) for _, seq, op in rows], columns=["seq", "op", "t"])
    found = {}
    for part in job.collector.handleInputRows(("a",), iter([frame]), job.handle):
        for _, run, n, dropped, status in part.itertuples(index=False):
            a, b, c = found.get(run, (0, 0, None))
            found[run] = a + n, b + dropped, status or c
    assert found == {r.run: (r.result_count, r.dropped, r.status) for r in batch}


def test_jobs_share_the_calls_of_a_bucket(spark, tmp_path):
    """3,000 jobs, ids that no float holds and null, over three micro-batches: the batch's result, and no more keys than buckets."""
    spread = F.xxhash64("id")
    op = F.get(F.array(*[F.lit(x) for x in ("register", "add", "add", "flush", "add", "discard", "add")]), F.pmod(spread, F.lit(7)).cast("int"))
    job = F.when(F.col("id") % 3001 < 3000, F.col("id") % 3001 + F.lit(2**53))
    events = spark.range(36_000).select(job.alias("job_id"), F.floor(F.col("id") / 3001).alias("seq"), op.alias("op"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"))
    for k in range(3):
        events.filter(F.floor(F.col("seq") / 4) == k).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        time.sleep(0.02)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    with state_store(spark):
        run_available(stream_collector(stream, "ts", "60 days"), f"{tmp_path}/state", lambda df, n: df.write.parquet(f"{tmp_path}/out/{n}"))
        keys = spark.read.format("statestore").option("stateVarName", "runs").load(f"{tmp_path}/state").select("key").distinct().count()
    found = S.collected_so_far(spark.read.parquet(f"{tmp_path}/out/*")).select("job_id", "run", "result_count", "dropped", "status")
    assert found.filter("job_id is null").count() > 0
    found = found.na.fill(-1, ["job_id"])
    batch = R.collected(events.na.fill(-1, ["job_id"])).filter("status <> 'running'").select(*found.columns)
    assert found.exceptAll(batch).count() == batch.exceptAll(found).count() == 0 < batch.count()
    assert keys <= S.BUCKETS < found.select("job_id").distinct().count()


def test_timeout_by_the_machine_s_time(spark, tmp_path):
    """A running stream whose job falls silent: no later event moves a watermark."""
    spark.createDataFrame([("a", 1, "register"), ("a", 2, "add"), ("b", 1, "register")], "job_id string, seq long, op string").withColumn("ts", F.current_timestamp()).coalesce(1).write.parquet(f"{tmp_path}/in")
    found = []
    with state_store(spark):
        events = spark.readStream.schema("job_id string, seq long, op string, ts timestamp").parquet(f"{tmp_path}/in")
        tagged = stream_collector(events, "ts", timeout_s=2, grace_s=1, clock="processing")
        query = run_every(tagged, f"{tmp_path}/state", lambda df, _: found.extend(map(tuple, df.collect())), "500 milliseconds")
        try:
            end = time.time() + 60
            while len(found) < 2 and time.time() < end:
                time.sleep(0.5)
        finally:
            query.stop()
    assert sorted(found) == [("a", 1, 1, 0, "completed"), ("b", 1, 0, 0, "failed")]
    with pytest.raises(ValueError):
        stream_collector(events, "ts", clock="sun")


def hits_of(spark, folder):
    schema = "user_id long, event_id long, ts timestamp, reset boolean"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_limiter_state_equals_the_batch_replay(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), F.lit(False).alias("reset"))
    events.coalesce(1).sortWithinPartitions("ts").write.parquet(f"{tmp_path}/in")
    with state_store(spark):
        run_available(S.stream_rate_limit(hits_of(spark, f"{tmp_path}/in"), "user_id", "ts", "event_id", 86400, 3), f"{tmp_path}/state", lambda df, _: df.collect())
        found = {r.key: (r.counter, r.remaining, r.reset_at.timestamp()) for r in S.limiter_state(spark, f"{tmp_path}/state", 86400, 3).collect()}
        late = S.limiter_state(spark, f"{tmp_path}/state", 86400, 3, F.lit("2024-01-30 00:00:00").cast("timestamp")).count()
    batch = R.fixed_windows(events, "user_id", "ts", "event_id", 86400, 3)
    last = batch.groupBy("user_id").agg(F.max_by(F.struct("counter", "remaining", "reset_at"), F.struct("reset_at", "counter")).alias("x")).select("user_id", "x.*").collect()
    assert found == {r.user_id: (r.counter, r.remaining, r.reset_at) for r in last} and 0 < late < len(found)


def test_limiter_reset_and_expiry(spark, tmp_path):
    def add(k, *rows):
        frame = spark.createDataFrame([(key, i, f"2024-01-01 00:00:{i:02d}", reset) for key, i, reset in rows], "user_id long, event_id long, ts string, reset boolean")
        frame.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    found = []

    def run(name, ttl_s=None, hits=0):
        """With a time to live, batches go on by the clock: such a query is stopped when it has given its hits."""
        limited = S.stream_rate_limit(hits_of(spark, f"{tmp_path}/in"), "user_id", "ts", "event_id", 60, 2, F.col("reset"), ttl_s)
        before, write = len(found), lambda df, _: found.extend(map(tuple, df.collect()))
        if ttl_s is None:
            run_available(limited, f"{tmp_path}/{name}", write)
        else:
            query, end = run_every(limited, f"{tmp_path}/{name}", write, "300 milliseconds"), time.time() + 30
            while len(found) - before < hits and time.time() < end:
                time.sleep(0.2)
            time.sleep(2)
            query.stop()
        return sorted(r.key for r in S.limiter_state(spark, f"{tmp_path}/{name}", 60, 2).collect())

    with state_store(spark):
        add(0, (1, 1, False), (1, 2, False), (1, 3, False), (2, 4, False))
        assert run("a") == [1, 2] and run("ttl", ttl_s=60, hits=4) == [1, 2]
        found.clear()
        add(1, (1, 5, True), (1, 6, False), (2, 7, True))
        assert run("a") == [1]
        assert found == [(1, 6, 1, True)]
        assert run("short", ttl_s=1, hits=5) == []


def test_a_stream_ends_at_the_barrier(spark, tmp_path):
    """Ten files of two seeds, eight places; the counts are complete after the seventh."""
    for k in range(10):
        rows = [("seed", 2)] if k in (0, 3) else [("place", 0)] if k in (1, 2, 5, 6) else [("other", 0)]
        spark.createDataFrame(rows, "kind string, found int").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        time.sleep(0.02)
    stream = spark.readStream.schema("kind string, found int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    counted = observed(stream, (F.col("kind") == "seed").cast("int"), F.col("found"), (F.col("kind") == "place").cast("int"))
    barrier, seen = Barrier(2), []
    assert run_until_done(counted, barrier, f"{tmp_path}/state", lambda df, n: (seen.append(n), df.write.mode("append").parquet(f"{tmp_path}/out")), "2 seconds", timeout_s=120)
    assert max(barrier.batches) == 6 and len(seen) <= 9 and not spark.streams.active
    assert (barrier.total("seeds_done"), barrier.total("places_found"), barrier.total("places_done")) == (2, 4, 4)
    never = Barrier(3, {"seeds_done": 0})
    assert not run_until_done(observed(stream, F.lit(0), F.lit(0), F.lit(0)), never, f"{tmp_path}/other", lambda df, n: df.count(), "1 second", timeout_s=3)


def test_a_bounded_source_restarts_from_its_offset(spark, tmp_path):
    path = f"{tmp_path}/queue"

    def connect():
        return sqlite3.connect(path, timeout=60)

    with connect() as db:
        db.execute("CREATE TABLE jobs (id INTEGER PRIMARY KEY, keyword TEXT)")
        db.executemany("INSERT INTO jobs VALUES (?, ?)", [(i * 3 + 5, f"k{i}") for i in range(25)])
    queue, sizes, found = QueueTable(connect, "jobs", "id", "id long, keyword string", "?"), [], []

    def write(df, n):
        rows = df.collect()
        if rows:
            sizes.append(len(rows))
            found.extend(map(tuple, rows))

    def run():
        query = run_every(read_queue(spark, queue, 10, tasks=3), f"{tmp_path}/state", write, "100 milliseconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    run()
    assert sizes == [10, 10, 5] and sorted(found) == [(i * 3 + 5, f"k{i}") for i in range(25)]
    with connect() as db:
        db.executemany("INSERT INTO jobs VALUES (?, ?)", [(i * 3 + 5, f"k{i}") for i in range(25, 37)])
    run()
    assert sizes[3:] == [10, 2] and sorted(found) == [(i * 3 + 5, f"k{i}") for i in range(37)]
    run()
    assert len(found) == 37
