"""Jobs and their results: defaults, validation, enrichment, rollups, lists, status views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.html import feed_links
from ..functions.url import single_place
from ..plans.seeds import rule_errors

JOB_TYPES = ("search", "place", "email")
INACTIVE = ("failed", "deleted", "deleting")


def with_defaults(requests: DataFrame) -> DataFrame:
    """Requests with lang, depth and timeout filled where they are missing or zero."""
    filled = {"lang": F.when(F.coalesce("lang", F.lit("")) == "", "en").otherwise(F.col("lang"))}
    filled |= {c: F.when(F.coalesce(c, F.lit(0)) == 0, d).otherwise(F.col(c)) for c, d in (("depth", 1), ("timeout", 300))}
    return requests.withColumns(filled)


def web_job_errors(name: Column, keywords: Column, lang: Column, depth: Column, max_time: Column) -> Column:
    return rule_errors([
        (F.coalesce(name, F.lit("")) == "", "missing name"), (F.coalesce(F.size(keywords), F.lit(0)) <= 0, "missing keywords"), (F.length(lang) != 2, "missing lang"),
        (depth <= 0, "missing depth"), (max_time <= 0, "missing max time"),
    ])


def place_errors(title: Column, category: Column) -> Column:
    return rule_errors([(F.coalesce(title, F.lit("")) == "", "title is empty"), (F.coalesce(category, F.lit("")) == "", "category is empty")])


def may_hold_feed(html: Column) -> Column:
    """Whether a page names a feed, or a character reference may spell it."""
    return F.contains(html, F.lit("feed")) | F.contains(html, F.lit("&"))


def place_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """A row per place link: the page's own URL if it is a single place, else its feed's links.

    Only pages whose text can hold a feed reach the parser; null pages have no link.
    """
    single = pages.filter(single_place(F.col(url))).select(url, F.lit(0).alias("position"), F.col(url).alias("link"))
    feed = pages.filter(~single_place(F.col(url))).select(url, F.posexplode(feed_links(F.when(may_hold_feed(F.col(html)), F.col(html)))).alias("position", "link"))
    return single.unionByName(feed)


def enriched(places: DataFrame, found: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """places with the distinct values of a child table as an array in order of first appearance.

    The children shrink to one row per key and value before they meet, then to one per key.
    """
    firsts = found.groupBy(key, value).agg(F.struct(F.min(order)).alias("at")).select(key, F.struct("at", F.col(value).alias("v")).alias("first"))
    lists = firsts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("first")), lambda x: x["v"]).alias(value))
    joined = places.join(lists, key, "left")
    return joined.withColumn(value, F.coalesce(value, F.slice(F.array(F.lit(None).cast(found.schema[value].dataType)), 1, 0)))


def all_reviews(pages: DataFrame, key: str) -> DataFrame:
    """key, reviews: the reviews of all pages of a place, pages in order."""
    return pages.groupBy(key).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "reviews"))), lambda p: p["reviews"])).alias("reviews"))


def rendered_reviews(rows: Column) -> Column:
    """Reviews read from a rendered page, under the names of the others; nameless ones are left out."""
    named = F.transform(rows, lambda r: F.struct(
        r["author"].alias("Name"), r["picture"].alias("ProfilePicture"), r["rating"].cast("int").alias("Rating"), r["text"].alias("Description"), r["images"].alias("Images"), r["when"].alias("When")
    ))
    return F.filter(named, lambda r: F.coalesce(r["Name"], F.lit("")) != "")


def cluster_rollup(resources: DataFrame) -> DataFrame:
    """One row: workers, reachable ones, results per minute and jobs; a worker without health counts as one only."""
    health = F.from_json("health", "reachable boolean, results_per_min double, jobs_processed long")
    workers = resources.filter((F.col("type") == "worker") & F.col("deleted_at").isNull()).withColumn("h", health)
    up = F.coalesce(F.col("h.reachable"), F.lit(False))
    return workers.agg(
        F.count("*").alias("workers"), F.count_if(up).alias("reachable"),
        F.coalesce(F.sum(F.when(up, F.col("h.results_per_min"))), F.lit(0.0)).alias("results_per_min"), F.coalesce(F.sum(F.when(up, F.col("h.jobs_processed"))), F.lit(0)).alias("jobs"),
    )


def active(workers: DataFrame) -> DataFrame:
    return workers.filter(~F.col("status").isin(*INACTIVE) & (F.col("ip") != "") & F.col("deleted_at").isNull())


def newest(rows: DataFrame, time: str, key: str, deleted: str | None = None, limit: int | None = None, **equal) -> DataFrame:
    """Rows newest first, without soft-deleted ones, with the given values; a positive limit keeps that many."""
    for column, value in equal.items():
        rows = rows if value is None else rows.filter(F.col(column) == value)
    rows = rows if deleted is None else rows.filter(F.col(deleted).isNull())
    ordered = rows.orderBy(F.desc(time), F.desc(key))
    return ordered.limit(limit) if limit and limit > 0 else ordered


def retryable(jobs: DataFrame, limit: int = 1) -> DataFrame:
    """The first retryable jobs, at most 50 at once."""
    return jobs.filter(F.col("state") == "retryable").orderBy("scheduled_at", "id").limit(min(max(limit, 1), 50))


def soft_deleted(rows: DataFrame, chosen: Column, column: str, now: Column) -> DataFrame:
    """rows with the deletion time set on chosen ones that have none."""
    return rows.withColumn(column, F.when(chosen & F.col(column).isNull(), now).otherwise(F.col(column)))


def job_view(jobs: DataFrame) -> DataFrame:
    """id, started_at (not of waiting jobs), finished_at (only of ended ones) and the last error's text."""
    waiting = F.col("state").isin("available", "scheduled", "retryable", "pending")
    ended = F.col("state").isin("completed", "discarded", "cancelled")
    return jobs.select("id", F.when(~waiting, F.col("attempted_at")).alias("started_at"), F.when(ended, F.col("finalized_at")).alias("finished_at"), F.coalesce(F.get(F.col("errors"), F.size("errors") - 1)["error"], F.lit("")).alias("error"))


def pushed(jobs: DataFrame, new: DataFrame) -> DataFrame:
    """jobs and the new ones of a known type."""
    return jobs.unionByName(new.filter(F.col("payload_type").isin(*JOB_TYPES)).select(*jobs.columns))


def timed_out_status(count: Column) -> Column:
    """A job that ran out of time succeeds with what it has; without any result it fails."""
    return F.when(count > 0, "completed").otherwise("failed")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, and an observation that has its number of rows after an action."""
    observation = Observation(name)
    return df.observe(observation, F.count("*").alias("rows")), observation
