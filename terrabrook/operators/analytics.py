"""The user-facing questions about places, as plain DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def highest_rated(places: DataFrame, min_reviews: int = 0, k: int = 20) -> DataFrame:
    return places.filter(F.col("review_count") > min_reviews).orderBy(F.desc("review_rating"), F.desc("review_count"), "place_id").limit(k)


def category_counts(places: DataFrame) -> DataFrame:
    return places.groupBy("category").agg(F.count("*").alias("places"))


def area_ratings(places: DataFrame, area: str) -> DataFrame:
    return places.groupBy(area).agg(F.avg("review_rating").alias("avg_rating"), F.count("*").alias("places"))


def open_on(places: DataFrame, day: str) -> DataFrame:
    return places.filter(F.size(F.coalesce(F.element_at("open_hours", F.lit(day)), F.array().cast("array<string>"))) > 0)


def without_email(places: DataFrame) -> DataFrame:
    """Places with a website and no e-mail."""
    return places.filter((F.coalesce("web_site", F.lit("")) != "") & (F.coalesce(F.size("emails"), F.lit(0)) <= 0))


def rating_histogram(reviews: DataFrame, key: str, rating: str) -> DataFrame:
    """key, rating 1 to 5, n, zero-filled: one aggregate row per key, then five rows from it."""
    counts = reviews.groupBy(key).agg(*[F.count_if(F.col(rating) == r).alias(f"r{r}") for r in range(1, 6)])
    return counts.select(key, F.explode(F.array(*[F.struct(F.lit(r).alias("rating"), F.col(f"r{r}").alias("n")) for r in range(1, 6)])).alias("x")).select(key, "x.rating", "x.n")
