"""Filters, ranks, dedup, joins, upserts, retention and rollups over places and jobs."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.geo import haversine_m, within_box


def radius_search(places: DataFrame, lat: float, lon: float, radius_m: float) -> DataFrame:
    """Places within the radius with their distance, nearest first."""
    box = within_box(F.col("lat"), F.col("lon"), F.lit(lat), F.lit(lon), radius_m)
    distance = haversine_m(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))
    return places.filter(box).withColumn("distance_m", distance).filter(F.col("distance_m") <= radius_m).orderBy("distance_m", "place_id")


EARTH_M = 6_371_000.0


def nearest_per_query(places: DataFrame, queries: DataFrame, radius_m: float, k: int) -> DataFrame:
    """For every query centre (query_id, q_lat, q_lon) the k nearest places (place_id, lat, lon) within the radius.

    Places and centres meet on cells of about the radius's size: latitude bands, each cut into columns
    that are wide enough at its poleward edge; a centre is copied to the cells that its circle may
    touch, across the antimeridian and the poles too.  So the join is an equi-join at any size, and the
    rank keeps k rows per task before the shuffle.  Rows with a null coordinate are in no circle.
    """
    half = math.sin(min(radius_m / (2 * EARTH_M), math.pi / 2))
    height = max(min(math.degrees(radius_m / EARTH_M), 180.0), 1e-6)
    band_of = lambda lat: F.floor((lat + 90) / height)

    def reach(cosines: Column) -> Column:
        """Degrees of longitude between two points within the radius, by the root of their latitudes' cosines' product."""
        return F.degrees(2 * F.asin(F.least(F.lit(1.0), half / F.greatest(cosines, F.lit(1e-12)))))

    def edge(band: Column) -> Column:
        """The cosine of the band's latitude nearest to a pole."""
        far = F.greatest(F.abs(band * height - 90), F.abs((band + 1) * height - 90))
        return F.cos(F.radians(F.least(far, F.lit(90.0))))

    columns = lambda band: F.greatest(F.lit(1), F.floor(180.0 / reach(edge(band)))).cast("long")
    cell = next(name for i in itertools.count() if (name := f"_cell_{i}") not in {*places.columns, *queries.columns})
    band = band_of(F.col("lat"))
    place_cell = F.struct(band.alias("band"), F.least(F.floor(F.pmod(F.col("lon") + 180, F.lit(360.0)) * columns(band) / 360), columns(band) - 1).alias("column"))

    def touched(band: Column) -> Column:
        n = columns(band)
        wide = reach(F.sqrt(F.greatest(F.cos(F.radians("q_lat")), F.lit(0.0)) * edge(band)))
        first, last = F.floor((F.col("q_lon") + 180 - wide) * n / 360), F.floor((F.col("q_lon") + 180 + wide) * n / 360)
        return F.transform(F.sequence(first, F.least(last, first + n - 1)), lambda c: F.struct(band.alias("band"), F.pmod(c, n).alias("column")))

    near_bands = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: band_of(F.col("q_lat")) + i)
    left = places.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).withColumn(cell, place_cell)
    right = queries.filter(F.col("q_lat").isNotNull() & F.col("q_lon").isNotNull()).withColumn(cell, F.explode(F.flatten(F.transform(near_bands, touched))))
    distance = haversine_m(F.col("q_lat"), F.col("q_lon"), F.col("lat"), F.col("lon"))
    near = left.join(right, cell).withColumn("distance_m", distance).filter(F.col("distance_m") <= radius_m).drop(cell)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance_m", "place_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k)


def first_wins(df: DataFrame, keys: list[str], order: list[str], enabled: bool = True) -> DataFrame:
    """The first row of each key in the given order, by full keys; hot keys shrink before the shuffle.

    Null keys are equal. Not enabled: all rows, for modes that run without dedup.
    """
    if not enabled:
        return df
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")) if rest else df.distinct()
    return picked.select(*keys, "r.*").select(*df.columns) if rest else picked


def insert_ignore(existing: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """existing plus the new rows whose key it lacks, the first of each."""
    return existing.unionByName(first_wins(new, [key], order).join(existing.select(key), key, "left_anti").select(*existing.columns))


def upsert_last_wins(existing: DataFrame, updates: DataFrame, key: str, seq: str, keep: list[str]) -> DataFrame:
    """existing with the latest update of each key; the columns in keep stay those of the first row."""
    when = next(name for i in itertools.count() if (name := f"_seq_{i}") not in existing.columns)
    both = existing.withColumn(when, F.lit(None).cast(updates.schema[seq].dataType)).unionByName(updates.withColumnRenamed(seq, when))
    rank = F.coalesce(F.col(when), F.lit(-(1 << 60)).cast("long"))
    values = [c for c in existing.columns if c != key]
    return both.groupBy(key).agg(*[(F.min_by if c in keep else F.max_by)(F.struct(c), rank)[c].alias(c) for c in values]).select(*existing.columns)


def claim(jobs: DataFrame, order: list[Column], k: int, status: str | None = "new") -> DataFrame:
    """The k first new jobs in order, marked as queued (TakeOrderedAndProject: k rows per task move).

    status: the one that can be claimed; None if jobs has no status yet.
    """
    jobs = jobs if status is None else jobs.filter(F.col("status") == status)
    return jobs.orderBy(*order).limit(k).withColumn("status", F.lit("queued"))


def keyset_page(jobs: DataFrame, limit: int | None, after: tuple | None, time: str, key: str) -> DataFrame:
    """The next page, newest first, after a (time, key) cursor; limit is 20 if not positive, at most 100."""
    limit = 20 if not limit or limit <= 0 else min(limit, 100)
    if after is not None:
        jobs = jobs.filter((F.col(time) < F.lit(after[0])) | ((F.col(time) == F.lit(after[0])) & (F.col(key) < F.lit(after[1]))))
    return jobs.orderBy(F.desc(time), F.desc(key)).limit(limit)


def job_status(state: Column, listing: bool = True) -> Column:
    """The outside name of a queue state; pending has one in lists only."""
    waiting = ["available", "scheduled", "retryable", *["pending"][: int(listing)]]
    return F.when(state.isin(waiting), "pending").when(state == "running", "running").when(state == "completed", "completed").when(state.isin("discarded", "cancelled"), "failed").otherwise("")


def result_counts(jobs: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """jobs with result_count, 0 where a job has none; counts are made before the join."""
    counts = results.groupBy(key).agg(F.count("*").alias("result_count"))
    return jobs.join(counts, key, "left").withColumn("result_count", F.coalesce("result_count", F.lit(0)))


def retained(results: DataFrame, jobs: DataFrame, key: str, expired: Column) -> DataFrame:
    """results of jobs that are not expired."""
    return results.join(jobs.filter(expired).select(key), key, "left_anti")


def worker_rollup(workers: DataFrame) -> DataFrame:
    """Per host: expected, reachable, jobs, results per minute of those, and ok / degraded / down."""
    of_up = lambda c: F.sum(F.when(F.col("reachable"), F.col(c)).otherwise(0))
    out = workers.groupBy("host").agg(F.count("*").alias("expected"), F.count_if("reachable").alias("up"), of_up("jobs").alias("jobs"), of_up("results_per_min").alias("results_per_min"))
    return out.withColumn("status", F.when(F.col("up") == F.col("expected"), "ok").when(F.col("up") == 0, "down").otherwise("degraded"))


def remove_first(codes: Column, used: Column) -> Column:
    """A comma list without the first element equal to used."""
    items = F.split(codes, ",")
    at = F.array_position(items, used).cast("int")
    return F.when(at > 0, F.array_join(F.concat(F.slice(items, F.lit(1), at - 1), F.slice(items, at + 1, F.size(items))), ",")).otherwise(codes)


def fixed_windows(hits: DataFrame, key: str, time: str, order: str, window_s: int, limit: int) -> DataFrame:
    """A fixed-window rate limiter replayed over each key's hits.

    A window opens at a hit; a hit at or after its end opens the next.  Returns key, order, counter,
    allowed, remaining and reset_at (seconds).  The rule is sequential in a key; rows arrive sorted and
    stream through one batch at a time, so no key is ever held whole, and cost a step per window.
    """
    rows = hits.select(F.col(key).alias("key"), F.col(order).cast("long").alias("o"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"))
    schema = hits.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    out = replayed(rows, schema, window_s * 1_000_000, "left")
    return out.select(
        F.col("key").alias(key), F.col("o").alias(order), F.col("n").alias("counter"), (F.col("n") <= limit).alias("allowed"),
        F.greatest(F.lit(limit) - F.col("n"), F.lit(0)).cast("long").alias("remaining"), (F.col("start") / 1_000_000 + window_s).alias("reset_at"),
    )


def touches(hits: DataFrame, key: str, time: str, order: str, gap_s: int = 60) -> DataFrame:
    """key, order, time of the hits that update a last-used time: the first, and each more than gap_s after
    the last that did."""
    rows = hits.select(F.col(key).alias("key"), F.col(order).cast("long").alias("o"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"))
    schema = hits.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    found = replayed(rows, schema, gap_s * 1_000_000, "right").filter(F.col("n") == 1)
    return found.select(F.col("key").alias(key), F.col("o").alias(order), F.timestamp_micros("start").alias(time))


def replayed(rows: DataFrame, key_type: str, width: int, side: str) -> DataFrame:
    """key, o, n, start: of each row (key, o, t in microseconds) its window's start and its number there.

    A window opens at a row and holds those less than width later (side left) or up to width later (right).
    """
    ordered = rows.repartition("key").sortWithinPartitions("key", "t", "o")
    return ordered.mapInArrow(lambda b: replay_windows(b, width, side), f"key {key_type}, o long, n long, start long")


def replay_windows(batches: Iterator[pa.RecordBatch], width: int, side: str) -> Iterator[pa.RecordBatch]:
    """A step per window, not per row, over batches sorted by key and t; holds a batch."""
    held = None  # key, start, n
    for batch in batches:
        key, t = batch.column("key"), batch.column("t").to_numpy(zero_copy_only=False)
        codes = key.dictionary_encode(null_encoding="encode").indices.to_numpy()
        cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(t)]
        start, n = np.empty(len(t), np.int64), np.empty(len(t), np.int64)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            own, at = key[a].as_py(), a
            while at < b:
                begins, before = (held[1], held[2]) if at == 0 and held is not None and held[0] == own else (int(t[at]), 0)
                end = at + int(np.searchsorted(t[at:b], begins + width, side))
                start[at:end], n[at:end] = begins, np.arange(before + 1, before + 1 + end - at)
                if end == at:  # the window that was held is over
                    held = None
                    continue
                held, at = (own, begins, before + end - at), end
        yield pa.RecordBatch.from_arrays([key, batch.column("o"), pa.array(n), pa.array(start)], ["key", "o", "n", "start"])


def strip_nul(df: DataFrame) -> DataFrame:
    """df without NUL characters in any string, array, map key or value, or struct field."""

    def clean(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return F.replace(c, F.lit("\u0000"), F.lit(""))
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: clean(x, kind.elementType))
        if isinstance(kind, T.MapType):
            out = F.transform_keys(c, lambda k, v: clean(k, kind.keyType))
            return F.transform_values(out, lambda k, v: clean(v, kind.valueType))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[clean(c[f.name], f.dataType).alias(f.name) for f in kind]))
        return c

    return df.select(*[clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def has_nul(c: Column, kind: T.DataType) -> Column:
    """Whether any string in the value holds a NUL character; null counts as without."""
    none = F.lit(False)
    if isinstance(kind, T.StringType):
        return F.coalesce(F.contains(c, F.lit("\u0000")), none)
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(c, lambda x: has_nul(x, kind.elementType)), none)
    if isinstance(kind, T.MapType):
        return has_nul(F.map_keys(c), T.ArrayType(kind.keyType)) | has_nul(F.map_values(c), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return functools.reduce(lambda a, f: a | has_nul(c[f.name], f.dataType), kind, none)
    return none


def quarantined(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows fit to store, rows with a NUL character in any string of the columns, nested ones too)."""
    bad = functools.reduce(lambda a, f: a | has_nul(F.col(f"`{f.name}`"), f.dataType), [f for f in df.schema if columns is None or f.name in columns], F.lit(False))
    return df.filter(~bad), df.filter(bad)


def barrier(jobs: DataFrame) -> DataFrame:
    """Adds done: all seeds are done and all places found are done."""
    return jobs.withColumn("done", (F.col("seeds_done") >= F.col("seeds")) & (F.col("places_done") >= F.col("places_found")))


ENDS = ("flush", "discard")


def collected(events: DataFrame) -> DataFrame:
    """job_id, run, result_count, dropped, status of register / add / flush / discard events (job_id, seq, op).

    Each registration of a job opens a run; the first flush or discard after it ends the run, and so does
    the next registration, whose predecessor's results are lost.  A flush or discard of a job that
    isn't open does nothing.  Adds outside of an open run are dropped and counted in the run before
    them (run 0: before any).  status: completed (flushed with results), failed (flushed without),
    discarded, replaced, running, or unregistered for run 0.

    Only the few events that open and end runs are ordered; adds look their run up in the job's list
    and are counted before they are shuffled.
    """
    control = events.filter(F.col("op").isin("register", *ENDS)).select("job_id", "seq", "op")
    job = Window.partitionBy("job_id").orderBy("seq")
    numbered = control.withColumn("run", F.count_if(F.col("op") == "register").over(job)).filter("run > 0")
    end = F.struct("seq", "op")
    runs = numbered.groupBy("job_id", "run").agg(F.min("seq").alias("opened"), F.min(F.when(F.col("op") != "register", end)).alias("ended"))
    lists = runs.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("run", "opened", "ended"))).alias("runs"))
    adds = events.filter(F.col("op") == "add").select("job_id", "seq").join(lists, "job_id", "left")
    before = F.filter(F.coalesce("runs", F.array().cast(lists.schema["runs"].dataType)), lambda r: r["opened"] < F.col("seq"))
    run = F.size(before).cast("long")
    last = F.get(before, F.size(before) - 1)
    counted = adds.select("job_id", run.alias("run"), (last["opened"].isNotNull() & (last["ended"].isNull() | (F.col("seq") < last["ended"]["seq"]))).alias("taken"))
    counts = counted.groupBy("job_id", "run").agg(F.count_if("taken").alias("result_count"), F.count_if(~F.col("taken")).alias("dropped"))
    final = runs.withColumn("newest", F.max("run").over(Window.partitionBy("job_id")))
    out = final.join(counts, ["job_id", "run"], "full").na.fill(0, ["result_count", "dropped"])
    status = (
        F.when(F.col("opened").isNull(), "unregistered").when(F.col("ended.op") == "discard", "discarded").when(F.col("ended.op") == "flush", F.when(F.col("result_count") > 0, "completed").otherwise("failed"))
        .when(F.col("run") < F.col("newest"), "replaced").otherwise("running")
    )
    return out.select("job_id", "run", "result_count", "dropped", status.alias("status"))


# A lead's source and the names of its text attributes, each with the place's field.
LEAD_SOURCE = "google_maps"
LEAD_ATTRIBUTES = [
    ("google_maps_link", "link"), ("plus_code", "plus_code"), ("status", "status"), ("price_range", "price_range"), ("timezone", "timezone"), ("full_address", "address"),
    ("borough", "complete_address.borough"), ("reviews_link", "reviews_link"), ("owner_name", "owner.name"), ("owner_link", "owner.link"), ("menu_link", "menu.link"),
]


def leads(places: DataFrame) -> DataFrame:
    """The lead projection: nulls for what is missing, tags, conditional attributes in a fixed order, and error.

    full_address stands only without a street, additional_emails from the second e-mail on.  A place
    without a title is no lead: its error says so.
    """
    some = lambda c: F.nullif(F.coalesce(F.col(c), F.lit("")), F.lit(""))
    located = (F.col("latitude") != 0) | (F.col("longitude") != 0)
    street = F.coalesce(F.col("complete_address.street"), F.lit(""))

    def attribute(name: str, kind: str, value: Column, given: Column) -> Column:
        return F.when(given, F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), value.alias("value")))

    given = [attribute(n, "text", F.col(f), some(f).isNotNull() & ((street == "") if n == "full_address" else F.lit(True))) for n, f in LEAD_ATTRIBUTES]
    given.append(attribute("additional_emails", "list", F.array_join(F.slice("emails", 2, 1 << 30), ", "), F.coalesce(F.size("emails"), F.lit(0)) > 1))
    address = {c: F.col(f"complete_address.{c}").alias(c) for c in ("city", "state", "country", "postal_code")}
    return places.select(
        F.col("title").alias("name"), F.lit(LEAD_SOURCE).alias("source"), some("description").alias("description"), some("data_id").alias("source_id"), some("category").alias("category"), some("thumbnail").alias("logo_url"), some("web_site").alias("website"), some("phone").alias("phone"), F.get("emails", 0).alias("email"),
        F.when(located, F.col("latitude")).alias("latitude"), F.when(located, F.col("longitude")).alias("longitude"), F.when(F.col("review_rating") > 0, F.col("review_rating")).alias("rating"), F.when(F.col("review_count") > 0, F.col("review_count")).alias("review_count"),
        F.nullif(street, F.lit("")).alias("street"), *address.values(), F.col("categories").alias("tags"), F.filter(F.array(*given), lambda a: a.isNotNull()).alias("attributes"),
        F.when(some("title").isNull(), "title is empty").alias("error"),
    )


# The columns of a CSV of places, in order, and the two headers that differ from their field.
CSV_COLUMNS = [
    "input_id", "link", "title", "category", "address", "open_hours", "popular_times", "web_site", "phone", "plus_code", "review_count", "review_rating", "reviews_per_rating", "latitude", "longitude", "cid", "status", "description",
    "reviews_link", "thumbnail", "timezone", "price_range", "data_id", "place_id", "images", "reservations", "order_online", "menu", "owner", "complete_address", "about", "user_reviews", "user_reviews_extended", "emails",
]
CSV_HEADERS = {"web_site": "website", "description": "descriptions"}


def place_csv(places: DataFrame) -> DataFrame:
    """The CSV form of places: 34 text columns under their headers; fields that are absent are empty, e-mails are listed."""
    from ..functions.text import listed

    known = [F.col(f) if f in places.columns else F.lit("").alias(f) for f in CSV_COLUMNS]
    chosen = places.select(*[listed(c).alias("emails") if f == "emails" and f in places.columns else c for c, f in zip(known, CSV_COLUMNS, strict=True)])
    return csv_rows(chosen, CSV_HEADERS)


def csv_rows(df: DataFrame, renamed: dict[str, str] | None = None) -> DataFrame:
    """Every column as the text a CSV of places holds; renamed maps field to header."""
    from ..functions.text import float_text, json_text

    out = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, T.StringType):
            text = F.coalesce(c, F.lit(""))
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            text = float_text(c)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            text = json_text(c, kind)
        else:
            text = F.coalesce(c.cast("string"), F.lit(""))
        out.append(text.alias((renamed or {}).get(f.name, f.name)))
    return df.select(*out)
