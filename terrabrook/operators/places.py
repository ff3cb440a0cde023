"""Captured payloads to places: the positional JSON of a place, a search page, a review page.

One select per payload: every field is an expression over one parsed variant, so column pruning
leaves out what a query doesn't read.  Missing or mistyped values are zero values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions.geo import plus_code
from ..functions.text import address_of, after_first_line, day_name, no_spaces, review_date, without_guard
from ..functions.url import unescaped, unwrap

REVIEWER_LINK = "https://www.google.com/maps/contrib/"


def open_hours(d: Column) -> Column:
    """map<day, times>; days without times are left out, a later row of a day wins."""
    first = P.items(d, 203, 0)
    rows = F.when(F.size(first) > 0, first).otherwise(P.items(d, 34, 1))

    def entry(row: Column) -> Column:
        slots = P.items(row, 3)
        times = F.when(F.size(slots) > 0, F.transform(slots, lambda s: P.text(s, 0))).otherwise(F.transform(P.items(row, 1), lambda s: P.text(s)))
        return F.struct(P.text(row, 0).alias("key"), F.filter(times, lambda t: t != "").alias("value"))

    return P.last_wins(F.filter(F.transform(rows, entry), lambda e: F.size(e["value"]) > 0))


def popular_times(d: Column) -> Column:
    """map<day, map<hour, traffic>>; null if any item is malformed. A pair without two numbers is malformed,
    one that is too short makes the whole place an error (short_pair)."""
    days = P.items(d, 84, 0)
    bad = F.exists(days, lambda x: ~P.is_array(x) | F.exists(P.items(x, 1), lambda h: ~P.is_array(h) | ~P.is_number(h, 0) | ~P.is_number(h, 1)))

    def entry(x: Column) -> Column:
        hours = F.transform(P.items(x, 1), lambda h: F.struct(P.whole(h, 0).cast("int").alias("key"), P.whole(h, 1).cast("int").alias("value")))
        return F.struct(day_name(P.whole(x, 0)).alias("key"), P.last_wins(hours).alias("value"))

    return F.when(~bad, P.last_wins(F.transform(days, entry)))


def short_pair(d: Column) -> Column:
    """Whether an hour's pair in the popular times has fewer than two values."""
    return F.exists(P.items(d, 84, 0), lambda x: F.exists(P.items(x, 1), lambda h: P.is_array(h) & (F.size(P.items(h)) < 2)))


def link_source(rows: Column, link: list[int], source: list[int]) -> Column:
    pairs = F.transform(rows, lambda r: F.struct(P.text(r, *link).alias("link"), P.text(r, *source).alias("source")))
    return F.filter(pairs, lambda p: (p["link"] != "") & (p["source"] != ""))


def first_text(v: Column, *options: tuple[int, ...]) -> Column:
    return F.coalesce(*[F.nullif(P.text(v, *o), F.lit("")) for o in options], F.lit(""))


# Where a review's fields sit, in the order they are tried.
WHEN = [(2, 2, 0, 1, 21, 6, 8), (2, 2, 0, 1, 6, 8)]
PICTURE = [(1, 4, 5, 1), (1, 2, 0), (0, 2, 0)]
NAME = [(1, 4, 5, 0), (1, 4, 4), (0, 1)]
RATING = [(2, 0, 0), (2, 0), (1, 0, 0)]
DESCRIPTION = [(2, 15, 0, 0), (2, 15, 0), (3, 0)]
IMAGES = [(2, 2, 0, 1, 21, 7), (2, 2, 0, 1, 7)]


def longer(a: Column, b: Column) -> Column:
    return F.when(F.size(a) > 0, a).otherwise(b)


def reviews(rows: Column) -> Column:
    """array of Name, ProfilePicture, Rating, Description, Images, When; authorless rows are left out.

    Image strings lose their first two characters.
    """

    def review(row: Column) -> Column:
        r = F.coalesce(F.when(F.size(P.items(row, 0)) > 0, P.at(row, 0)), row)
        when = longer(P.items(r, *WHEN[0]), P.items(r, *WHEN[1]))
        images = F.transform(longer(P.items(r, *IMAGES[0]), P.items(r, *IMAGES[1])), lambda i: P.text(i))
        picture = F.nullif(unescaped(P.text(r, *PICTURE[0])), F.lit(""))
        rating = F.coalesce(*[F.nullif(P.whole(r, *p), F.lit(0)) for p in RATING], F.lit(0))
        return F.struct(
            first_text(r, *NAME).alias("Name"), F.coalesce(picture, first_text(r, *PICTURE[1:])).alias("ProfilePicture"), rating.cast("int").alias("Rating"), first_text(r, *DESCRIPTION).alias("Description"),
            F.transform(F.filter(images, lambda i: F.length(i) > 2), lambda i: F.substring(i, 3, 1 << 30)).alias("Images"),
            review_date(F.transform(when, lambda x: P.number(x))).alias("When"),
        )

    return F.filter(F.transform(rows, review), lambda r: r["Name"] != "")


def parse_places(raw: DataFrame, column: str = "payload") -> DataFrame:
    """The input's other columns, the place's fields, and error for payloads that hold no place.

    Null, broken and short payloads give zero values and an error.  Other columns of the input must
    not bear a field's name: ValueError names those that do.
    """
    root, data = ("_" * 8 + "root", "_" * 8 + "data")
    parsed = raw.withColumn(root, P.parsed(F.col(column))).withColumn(data, P.at(F.col(root), 6))
    r, d = F.col(root), F.col(data)
    t = lambda *p: P.text(d, *p)
    category = F.transform(P.items(d, 13), lambda c: P.text(c))
    orders = link_source(P.items(d, 75, 0, 1, 2), [1, 2, 0], [0, 0])
    nested, flat = reviews(P.items(d, 175, 9, 0, 0)), reviews(P.items(d, 175, 9, 0))
    about = F.transform(P.items(d, 100, 1), lambda a: F.struct(P.text(a, 0).alias("id"), P.text(a, 1).alias("name"), F.filter(
        F.transform(P.items(a, 2), lambda o: F.struct(P.text(o, 1).alias("name"), (P.number(o, 2, 1, 0, 0) == 1).alias("enabled"))), lambda o: o["name"] != ""
    ).alias("options")))
    images = F.transform(P.items(d, 171, 0), lambda i: F.struct(P.text(i, 2).alias("title"), P.text(i, 3, 0, 6, 0).alias("image")))
    fields = {
        "link": t(27), "cid": P.text(r, 25, 3, 0, 13, 0, 0, 1), "title": t(11), "categories": category, "category": F.coalesce(F.get(category, 0), F.lit("")), "address": address_of(t(11), t(18)),
        "open_hours": open_hours(d), "popular_times": popular_times(d), "web_site": unwrap(t(7, 0)), "phone": t(178, 0, 0), "plus_code": t(183, 2, 2, 0), "review_count": P.whole(d, 4, 8), "review_rating": P.number(d, 4, 7),
        "reviews_per_rating": F.map_from_arrays(F.array(*[F.lit(i) for i in range(1, 6)]), F.array(*[P.whole(d, 175, 3, i).cast("int") for i in range(5)])),
        "latitude": P.number(d, 9, 2), "longitude": P.number(d, 9, 3), "status": t(34, 4, 4), "description": t(32, 1, 1), "reviews_link": t(4, 3, 0), "thumbnail": t(72, 0, 1, 6, 0), "timezone": t(30), "price_range": t(4, 2), "data_id": t(10), "place_id": t(78),
        "images": F.filter(images, lambda i: (i["title"] != "") & (i["image"] != "")), "reservations": link_source(P.items(d, 46), [0], [1]),
        "order_online": F.when(F.size(orders) > 0, orders).otherwise(link_source(P.items(d, 75, 0, 0, 2), [1, 2, 0], [0, 0])),
        "menu": F.struct(t(38, 0).alias("link"), t(38, 1).alias("source")),
        "owner": F.struct(t(57, 2).alias("id"), t(57, 1).alias("name"), F.when(t(57, 2) != "", F.concat(F.lit(REVIEWER_LINK), t(57, 2))).otherwise("").alias("link")),
        "complete_address": F.struct(*[t(183, 1, i).alias(n) for i, n in ((0, "borough"), (1, "street"), (3, "city"), (4, "postal_code"), (5, "state"), (6, "country"))]),
        "about": about, "user_reviews": F.when(F.size(nested) > 0, nested).otherwise(flat),
        "error": F.when(F.coalesce(F.size(P.items(r)) < 7, F.lit(True)) | ~P.is_array(r, 6), "invalid json").when(short_pair(d), "short popular times"),
    }
    keep = [c for c in raw.columns if c != column]
    if clash := sorted(set(keep) & set(fields)):
        raise ValueError(f"columns with names of a place's fields: {', '.join(clash)}")
    return parsed.select(*keep, *[c.alias(n) for n, c in fields.items()])


def review_counts(raw: DataFrame, column: str = "payload") -> DataFrame:
    """Only the review count; pruning does the rest."""
    return parse_places(raw, column).select(*[c for c in raw.columns if c != column], "review_count")


def parse_search(raw: DataFrame, column: str = "payload") -> DataFrame:
    """A row per business of search payloads. Their first line, the guard, is left out, whatever it holds; what
    isn't a list of two or more gives no row (search_errors says why)."""
    keep = [c for c in raw.columns if c != column]
    found = raw.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(True).alias("_")).alias("kept"), F.posexplode(P.items(search_root(F.col(column)), 0, 1)).alias("position", "item")).filter(F.col("position") > 0).filter(P.is_array(F.col("item")))
    found = found.select("*", P.at(F.col("item"), 14).alias("b"))
    b = F.col("b")
    keep = [F.col(f"kept.`{c}`") for c in keep]
    t = lambda *p: P.text(b, *p)
    as_text = lambda xs: F.transform(xs, lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("<nil>")))
    lat, lon = P.number(b, 9, 2), P.number(b, 9, 3)
    return found.select(
        *keep, "position", t(0).alias("id"), t(11).alias("title"), as_text(P.items(b, 13)).alias("categories"), t(7, 0).alias("web_site"), P.number(b, 4, 7).alias("review_rating"), P.whole(b, 4, 8).alias("review_count"),
        F.array_join(as_text(P.items(b, 2)), ", ").alias("address"), lat.alias("latitude"), lon.alias("longitude"), no_spaces(t(178, 0, 0)).alias("phone"), open_hours(b).alias("open_hours"), t(34, 4, 4).alias("status"), t(30).alias("timezone"), t(10).alias("data_id"),
        plus_code(lat, lon).alias("plus_code"),
    )


def search_root(body: Column) -> Column:
    return P.parsed(after_first_line(body))


def search_errors(body: Column) -> Column:
    """Why a search payload has no businesses; null if it has some."""
    root = search_root(body)
    return (
        F.when(~P.is_array(root), "invalid json").when(F.size(P.items(root)) == 0, "empty data").when(F.size(P.items(root, 0)) == 0, "invalid business list")
        .when(F.size(P.items(root, 0, 1)) < 2, "empty business list")
    )


def parse_review_pages(raw: DataFrame, column: str = "payload") -> DataFrame:
    """reviews and next_token of review pages."""
    root = P.parsed(without_guard(F.col(column)))
    second = P.items(root, 2)
    rows = F.when(F.size(second) > 0, second).otherwise(P.items(root, 0))
    long_enough = F.size(P.items(root)) >= 3
    keep = [c for c in raw.columns if c != column]
    none = F.slice(reviews(rows), 1, 0)
    return raw.select(*keep, F.when(long_enough, reviews(rows)).otherwise(none).alias("reviews"), P.text(root, 1).alias("next_token"))


def distinct_reviews(column: Column) -> Column:
    """Suppresses a review when an earlier kept one has its author and its text, or, both over 20
    characters, the same first 20."""

    def same(a: Column, b: Column) -> Column:
        prefix = (F.length(a["Description"]) > 20) & (F.length(b["Description"]) > 20) & (F.left(a["Description"], F.lit(20)) == F.left(b["Description"], F.lit(20)))
        return (a["Name"] == b["Name"]) & ((a["Description"] == b["Description"]) | prefix)

    return F.aggregate(column, F.slice(column, 1, 0), lambda kept, r: F.when(F.exists(kept, lambda k: same(k, r)), kept).otherwise(F.concat(kept, F.array(r))))


def with_fallback(paged: Column, rendered: Column) -> Column:
    """Reviews from pages if there are any, else those of the rendered page."""
    return F.when(F.size(paged) > 0, paged).otherwise(rendered)
