"""Lookups and small state changes: keys, sessions, settings, workers, counters, pages of jobs."""

from __future__ import annotations

import base64
import itertools
import json
from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .relational import job_status, keyset_page


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have."""
    return next(name for k in itertools.count() if (name := f"_{stem}_{k}") not in df.columns)


def looked_up(left: DataFrame, given: Column, right: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """left with the row of right whose key equals given, as one struct (null without one), and that struct.

    Keys of right are unique. A null finds nothing. Columns of one name on both sides don't clash.
    """
    row = fresh(left, "row")
    packed = right.select(F.struct("*").alias(row))
    return left.join(packed, given == F.col(row)[key], "left"), F.col(row)


def checked_keys(requests: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """requests with key_id, key_name and verdict: "not found", "revoked" or "ok".

    key is the secret as sent; keys holds id, name, key_hash (SHA-256 in hex) and revoked_at.
    """
    found, row = looked_up(requests, F.sha2(key, 256), keys, "key_hash")
    verdict = F.when(row.isNull(), "not found").when(row["revoked_at"].isNotNull(), "revoked").otherwise("ok")
    mine = verdict == "ok"
    return found.select(*[F.col(f"`{c}`") for c in requests.columns], F.when(mine, row["id"]).alias("key_id"), F.when(mine, row["name"]).alias("key_name"), verdict.alias("verdict"))


def checked_sessions(requests: DataFrame, session: str, sessions: DataFrame, now: Column) -> DataFrame:
    """requests with session_state: "absent", "expired" (now is past expires_at) or "ok". sessions: id, expires_at."""
    found, row = looked_up(requests, F.col(session), sessions, "id")
    state = F.when(row.isNull(), "absent").when(now > row["expires_at"], "expired").otherwise("ok")
    return found.select(*[F.col(f"`{c}`") for c in requests.columns], state.alias("session_state"))


def open_sessions(sessions: DataFrame, now: Column) -> DataFrame:
    """Sessions without the expired ones; an expiry that is unknown doesn't expire."""
    return sessions.filter(~F.coalesce(F.col("expires_at") < now, F.lit(False)))


def recent_limits(limits: DataFrame, now: Column) -> DataFrame:
    """Limiter rows of the last hour, by reset_at."""
    return limits.filter(~F.coalesce(F.col("reset_at") < now - F.expr("interval 1 hour"), F.lit(False)))


def unfinished_or_recent(jobs: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Jobs but for those that completed more than days ago."""
    return jobs.filter(~F.coalesce((F.col("state") == "completed") & (F.col("finalized_at") < now - F.make_dt_interval(F.lit(days))), F.lit(False)))


def aes_decrypted(value: Column, key: Column) -> Column:
    """The text of a base64 AES-GCM value, null if it isn't one of this key."""
    return F.try_aes_decrypt(F.unbase64(value), key, F.lit("GCM"), F.lit("DEFAULT")).cast("string")


def settings(names: DataFrame, name: str, config: DataFrame, decrypt: Callable[[Column], Column] | None = None) -> DataFrame:
    """names with setting: the value of config (key, value, encrypted), null where it has none.

    Encrypted values go through decrypt; without one they are null.
    """
    found, row = looked_up(names, F.col(name), config, "key")
    secret = decrypt(row["value"]) if decrypt else F.lit(None).cast("string")
    return found.select(*[F.col(f"`{c}`") for c in names.columns], F.when(row["encrypted"], secret).otherwise(row["value"]).alias("setting"))


def json_set(document: Column, key: str, value: Column) -> Column:
    """A JSON object's text with one top-level key set to a string; a null or broken document is {}."""
    members = F.coalesce(F.try_variant_get(F.try_parse_json(document), "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    text = F.try_parse_json(F.regexp_replace(F.to_json(F.array(value)), r"(?s)^\[(.*)\]$", "$1"))
    return F.to_json(F.map_concat(F.map_filter(members, lambda k, _: k != key), F.create_map(F.lit(key), text)))


def provisioned(status: Column) -> Column:
    """A machine that has come up: active, but only if it was still being provisioned."""
    return F.when(status == "provisioning", "active").otherwise(status)


def reached(status: Column, reachable: Column) -> Column:
    """Any status but active becomes active when the worker answers."""
    return F.when((status != "active") & reachable, "active").otherwise(status)


def failed(workers: DataFrame, chosen: Column, message: Column) -> DataFrame:
    """workers with status failed and the message as metadata's error, where chosen."""
    chosen = F.coalesce(chosen, F.lit(False))
    return workers.withColumns({"status": F.when(chosen, "failed").otherwise(F.col("status")), "metadata": F.when(chosen, json_set(F.col("metadata"), "error", message)).otherwise(F.col("metadata"))})


def dashboard(jobs: DataFrame, today: Column | None = None) -> DataFrame:
    """One row: scrape jobs created today or later, and all results. jobs: kind, created_at, result_count."""
    today = F.current_date() if today is None else today
    return jobs.agg(F.count_if((F.col("kind") == "scrape") & (F.col("created_at") >= today)).alias("jobs_today"), F.coalesce(F.sum("result_count"), F.lit(0)).cast("long").alias("total_results"))


def average_rate(results: Column, uptime_s: Column) -> Column:
    """Results per minute of whole seconds of uptime; 0 without any."""
    minutes = F.floor(uptime_s) / F.lit(60.0)
    return F.when(minutes > 0, results / minutes).otherwise(0.0)


def encoded_cursor(time: datetime, key: int) -> str:
    """An opaque cursor: the last row's time and key."""
    return base64.urlsafe_b64encode(json.dumps([time.isoformat(), key]).encode()).decode()


def decoded_cursor(cursor: str) -> tuple[datetime, int]:
    try:
        time, key = json.loads(base64.urlsafe_b64decode(cursor.encode()))
        return datetime.fromisoformat(time), int(key)
    except (ValueError, TypeError) as error:
        raise ValueError("invalid cursor") from error


class Page(NamedTuple):
    rows: list[Row]
    next_cursor: str | None
    has_more: bool


LISTED = ("pending", "running", "completed", "failed")


def in_state(jobs: DataFrame, status: str | None) -> DataFrame:
    """jobs (state) whose outside status is the given one; all for none."""
    if not status:
        return jobs
    if status not in LISTED:
        raise ValueError(f"invalid state: {status}")
    return jobs.filter(job_status(F.col("state")) == status)


def all_jobs(jobs: DataFrame, status: str | None = None) -> DataFrame:
    """Every job of a status, newest first: one filter, in place of reading page after page."""
    return in_state(jobs, status).orderBy(F.desc("created_at"), F.desc("id"))


def job_page(jobs: DataFrame, status: str | None = None, limit: int | None = None, cursor: str | None = None) -> Page:
    """A page of jobs (id, state, created_at), newest first; at most 100 rows come to the driver.

    has_more says that the page is full, so it may be said of the last one too.
    """
    after = decoded_cursor(cursor) if cursor else None
    page = keyset_page(in_state(jobs, status), limit, after, "created_at", "id").collect()
    size = 20 if not limit or limit <= 0 else min(limit, 100)
    return Page(page, encoded_cursor(page[-1].created_at, page[-1].id) if page else None, len(page) == size)
