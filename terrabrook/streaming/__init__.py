"""Structured Streaming forms of the stateful steps."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(spark: SparkSession, path: str, schema: T.StructType, time: str, files_per_trigger: int = 1) -> DataFrame:
    """A file stream whose NTZ event time is cast, so that it takes a watermark; the source's rate is bounded."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path).withColumn(time, F.col(time).cast("timestamp"))


def stream_dedup(events: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """First of each key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


class WindowLimiter(StatefulProcessor):
    """The fixed-window limiter with (start, n) per key as state; a reset forgets the key.

    With a time to live, Spark forgets keys that had no hit for so long.
    """

    def __init__(self, width_us: int, ttl_ms: int | None = None):
        self.width_us, self.ttl_ms = width_us, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(LIMITER_STATE, "start long, n long", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        start, n = self.state.get() if self.state.exists() else (0, 0)
        for pdf in rows:
            pdf = pdf.sort_values(["t", "o"])
            starts, counts, hits = [], [], []
            for t, o, reset in zip(pdf["t"].tolist(), pdf["o"].tolist(), pdf["reset"].tolist(), strict=True):
                if reset:
                    n = 0
                    continue
                start, n = (t, 1) if n == 0 or t >= start + self.width_us else (start, n + 1)
                starts.append(start)
                counts.append(n)
                hits.append(o)
            yield pd.DataFrame({"key": [key[0]] * len(hits), "o": hits, "n": counts, "start": starts})
        if n:
            self.state.update((int(start), int(n)))
        elif self.state.exists():
            self.state.clear()

    def close(self) -> None:
        pass


LIMITER_STATE = "window"


def stream_rate_limit(events: DataFrame, key: str, time: str, order: str, window_s: int, limit: int, reset: Column | None = None, ttl_s: int | None = None) -> DataFrame:
    """Counter and verdict for every hit, over hits that arrive in order of time per key.

    Rows for which reset is true are no hits: they open the key's window anew.  With ttl_s a key
    without a hit for so long (by the clock) leaves the state; take at least the window's length.
    """
    again = F.lit(False) if reset is None else F.coalesce(reset, F.lit(False))
    rows = events.select(F.col(key).cast("long").alias("key"), F.col(order).cast("long").alias("o"), F.unix_micros(F.col(time)).alias("t"), again.alias("reset"))
    processor = WindowLimiter(window_s * 1_000_000, None if ttl_s is None else ttl_s * 1000)
    out = rows.groupBy("key").transformWithStateInPandas(processor, "key long, o long, n long, start long", "Append", "none" if ttl_s is None else "processingTime")
    return out.select(F.col("key").alias(key), F.col("o").alias(order), F.col("n").alias("counter"), (F.col("n") <= limit).alias("allowed"))


def limiter_state(spark: SparkSession, checkpoint: str, window_s: int, limit: int, now: Column | None = None) -> DataFrame:
    """key, counter, remaining, start and reset_at of every key in a limiter's checkpoint, read without a hit.

    With now (a timestamp), keys whose window has passed are left out.
    """
    found = spark.read.format("statestore").option("stateVarName", LIMITER_STATE).load(checkpoint)
    value = F.col("value.value") if "value" in found.schema["value"].dataType.names else F.col("value")  # with a time to live, it stands beside the value
    rows = found.select(F.col("key.key").alias("key"), value["n"].alias("counter"), F.timestamp_micros(value["start"]).alias("start"))
    rows = rows.withColumn("reset_at", F.col("start") + F.expr(f"interval {window_s} seconds"))
    rows = rows if now is None else rows.filter(F.col("reset_at") > now)
    return rows.select("key", "counter", F.greatest(F.lit(limit) - F.col("counter"), F.lit(0)).alias("remaining"), "start", "reset_at")


def stream_counts(events: DataFrame, job: str, time: str, late: str, gap: str) -> DataFrame:
    """Results per job and session: a job with no result for gap is flushed; later ones are dropped."""
    return events.withWatermark(time, late).groupBy(job, F.session_window(time, gap)).agg(F.count("*").alias("result_count"))


#: Codes of the collector's events; anything else is an add.
REGISTER, ADD, DISCARD, FLUSH = 0, 1, 2, 3
NEVER = np.iinfo(np.int64).max
#: What a job may still deliver after its time, in seconds.
GRACE_S = 90


#: Groups of jobs whose state a micro-batch goes through together, where no timer needs a key of its own.
BUCKETS = 1024


class Step(NamedTuple):
    """What a micro-batch makes of some jobs: rows of output by job, and the run at hand of each job afterwards."""

    job: np.ndarray
    rows: pd.DataFrame
    run: np.ndarray
    taken: np.ndarray
    deadline: np.ndarray
    open: np.ndarray


def collect_step(job: np.ndarray, seq: np.ndarray, op: np.ndarray, t: np.ndarray, base: np.ndarray, taken: np.ndarray, deadline: np.ndarray, is_open: np.ndarray, timeout_ms: int | None) -> Step:
    """The collector's rules over events of many jobs at once, without a Python step an event or a job.

    job holds places in base, taken, deadline and is_open, the jobs' runs so far; each has an event.
    Runs are numbered through: a job's one at hand, then those it registers now.
    """
    order = np.lexsort((op, seq, job))
    job, seq, op, t = job[order], seq[order], op[order], t[order]
    at = np.arange(len(job))
    begins = np.flatnonzero(np.r_[True, job[1:] != job[:-1]])  # of each job's events
    ties = np.maximum.accumulate(np.where(np.r_[True, (job[1:] != job[:-1]) | (seq[1:] != seq[:-1])], at, 0))  # first event of the same number
    opens = op == REGISTER
    before = np.cumsum(opens) - opens
    first_run = before[begins] + np.arange(len(begins))
    last_run = np.r_[first_run[1:], opens.sum() + len(begins)] - 1
    runs = int(last_run[-1]) + 1
    run_job = np.repeat(np.arange(len(begins)), last_run - first_run + 1)
    is_run = np.ones(runs, bool)
    is_run[first_run] = is_open
    limits = np.full(runs, NEVER)
    if timeout_ms is not None:
        limits[before[opens] + job[opens] + 1] = t[opens] + timeout_ms
    limits[first_run] = deadline
    ends, adds = (op == DISCARD) | (op == FLUSH), op == ADD
    end_of, first = np.unique(before[ends] + job[ends], return_index=True)  # a registration comes before the ends of its number
    end_seq, end_op = np.full(runs, NEVER), np.full(runs, -1)
    end_seq[end_of], end_op[end_of] = seq[ends][first], op[ends][first]
    run_of = before[ties[adds]] + job[adds]  # but after the adds of its number
    within = is_run[run_of] & (seq[adds] < end_seq[run_of]) & (t[adds] <= limits[run_of])
    counts = np.bincount(run_of[within], minlength=runs)
    counts[first_run] += taken
    dropped = np.bincount(run_of[~within], minlength=runs)
    is_last = np.zeros(runs, bool)
    is_last[last_run] = True
    over = np.flatnonzero(is_run & ((end_op >= 0) | ~is_last))
    status = np.select([end_op[over] < 0, end_op[over] == DISCARD, counts[over] > 0], ["replaced", "discarded", "completed"], "failed").astype(object)
    late = np.flatnonzero(dropped)
    number = np.arange(runs) - first_run[run_job] + base[run_job]
    rows = {"run": np.r_[number[late], number[over]], "result_count": np.r_[np.zeros(len(late), np.int64), counts[over]], "dropped": np.r_[dropped[late], np.zeros(len(over), np.int64)], "status": np.r_[np.full(len(late), None, object), status]}
    still = is_run[last_run] & (end_op[last_run] < 0)
    return Step(run_job[np.r_[late, over]], pd.DataFrame(rows), number[last_run], np.where(still, counts[last_run], 0), limits[last_run], still)


def whole(rows: Iterator[pd.DataFrame], *columns: str) -> list[np.ndarray]:
    """The columns of a key's rows of the micro-batch, each in one piece."""
    parts = [[r[c].to_numpy() for c in columns] for r in rows]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


class Collector(StatefulProcessor):
    """The run of a job as state: its number, results, deadline and whether it is open.

    Gives two kinds of rows: a run that ended (status), and how many adds of a micro-batch came
    outside of an open run (dropped, no status).

    With a timeout, a run has that long from its registration, by the events' times; a timer ends it
    grace later by the chosen clock, until when adds of its time still count.  It then ends with what
    it has: completed if that is anything, else failed.  Timers belong to a key, so each job is one.
    """

    def __init__(self, timeout_ms: int | None, grace_ms: int, by_clock: bool):
        self.timeout_ms, self.grace_ms, self.by_clock = timeout_ms, grace_ms, by_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "run long, taken long, deadline long, open boolean")

    def output(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        rows.insert(0, "job_id", pd.Series([key[0]] * len(rows), dtype=object))
        return rows

    def set_timer(self, at_ms: int | None) -> None:
        for (old,) in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if at_ms is not None:
            self.handle.registerTimer(int(at_ms))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Holds three numbers of each of the key's events in the micro-batch."""
        before = self.state.get() if self.state.exists() else (0, 0, NEVER, False)
        was_open = before[3]
        seq, op, t = whole(rows, "seq", "op", "t")
        step = collect_step(np.zeros(len(seq), np.int64), seq, op, t, *(np.array([x]) for x in before), self.timeout_ms)
        still, deadline = bool(step.open[0]), int(step.deadline[0])
        self.state.update((int(step.run[0]), int(step.taken[0]), deadline, still))
        if self.timeout_ms is not None and ((op == REGISTER).any() or (was_open and not still)):
            now = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms if self.by_clock else deadline
            self.set_timer(now + self.grace_ms if still else None)
        yield self.output(key, step.rows)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run, taken, deadline, is_open = self.state.get()
        self.state.update((int(run), 0, int(deadline), False))
        ended = [(run, taken, 0, "completed" if taken else "failed")] if is_open else []
        frame = pd.DataFrame(ended, columns=["run", "result_count", "dropped", "status"])
        yield self.output(key, frame.astype({"run": "int64", "result_count": "int64", "dropped": "int64", "status": object}))

    def close(self) -> None:
        pass


class BucketCollector(StatefulProcessor):
    """The collector without a timeout: a key is a bucket of jobs, and the state maps each job to its run.

    A micro-batch reads and writes the state of the jobs that it has events of, and only where it changes.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getMapState("runs", "job string", "run long, taken long, open boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Holds a bucket's events of the micro-batch: job, number and kind."""
        names, seq, op = whole(rows, "job", "seq", "op")
        job, names = pd.factorize(names, use_na_sentinel=False)
        names = [None if pd.isna(name) else name for name in names]
        before = [self.runs.getValue((name,)) or (0, 0, False) for name in names]
        base, taken, is_open = (np.array(x) for x in zip(*before, strict=True))
        step = collect_step(job, seq, op, np.zeros(len(seq), np.int64), base, taken, np.full(len(names), NEVER), is_open, None)
        after = zip(step.run.tolist(), step.taken.tolist(), step.open.tolist(), strict=True)
        for name, old, new in zip(names, before, after, strict=True):
            if new != tuple(old):
                self.runs.updateValue((name,), new)
        step.rows.insert(0, "job", np.array(names, object)[step.job])
        yield step.rows

    def close(self) -> None:
        pass


def stream_collector(events: DataFrame, time: str, late: str = "1 minute", timeout_s: int | None = None, grace_s: int = GRACE_S, clock: str = "event") -> DataFrame:
    """job_id, run, result_count, dropped, status: tagged rows of (job_id, seq, op, time) events, by the rules of collected().

    A row with a status is a run that ended; one without counts adds of that run (0: before any) that
    came after its end or before a registration.  ended_runs() and dropped_rows() split them,
    collected_so_far() puts them together.  A job's events come in order of seq between micro-batches.
    With a timeout a run that is open for longer, and grace_s more, ends with what it has; clock is
    "event" (the watermark) or "processing" (the machine's time, for jobs that fall silent).
    Without one, jobs share the calls of their bucket.  job_id: text or whole numbers, or null.
    """
    codes = F.when(F.col("op") == "register", REGISTER).when(F.col("op") == "discard", DISCARD).when(F.col("op") == "flush", FLUSH).otherwise(ADD)
    if clock not in ("event", "processing"):
        raise ValueError("clock must be event or processing")
    kind = events.schema["job_id"].dataType.simpleString()
    timed = events.withWatermark(time, late)
    if timeout_s is None:
        rows = timed.select(F.pmod(F.xxhash64("job_id"), F.lit(BUCKETS)).alias("bucket"), F.col("job_id").cast("string").alias("job"), "seq", codes.alias("op"), time)
        out = rows.groupBy("bucket").transformWithStateInPandas(BucketCollector(), "job string, run long, result_count long, dropped long, status string", "Append", "none")
        return out.select(F.col("job").cast(kind).alias("job_id"), "run", "result_count", "dropped", "status")
    rows = timed.select("job_id", "seq", codes.alias("op"), F.unix_millis(time).alias("t"), time)
    processor = Collector(timeout_s * 1000, grace_s * 1000, clock == "processing")
    return rows.groupBy("job_id").transformWithStateInPandas(processor, f"job_id {kind}, run long, result_count long, dropped long, status string", "Append", "eventTime" if clock == "event" else "processingTime")


def ended_runs(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("status").isNotNull()).select("job_id", "run", "result_count", "status")


def dropped_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("status").isNull()).select("job_id", "run", "dropped")


def collected_so_far(tagged: DataFrame) -> DataFrame:
    """What collected() has of the runs that ended, and of adds before any, from the collector's stored output."""
    out = tagged.groupBy("job_id", "run").agg(F.sum("result_count").alias("result_count"), F.sum("dropped").alias("dropped"), F.max("status").alias("status"))
    return out.withColumn("status", F.when(F.col("run") == 0, "unregistered").otherwise(F.col("status")))


@contextlib.contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that stateful processors need, for the queries started inside; then the session's own again."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STATE_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def run_every(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], every: str = "1 minute", mode: str = "append") -> StreamingQuery:
    """Processes what has come in each interval, until stopped."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=every).foreachBatch(write).start()


def run_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Processes what is there in micro-batches and ends."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return query
