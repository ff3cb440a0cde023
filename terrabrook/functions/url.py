"""URL column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAPS = "https://www.google.com/maps"


HOST = "https://www.google.com"
REDIRECT = "/url?q="


def unwrap(url: Column) -> Column:
    """The decoded q of a "/url?q=..." redirect; any other URL as it is."""
    target = F.try_url_decode(F.try_parse_url(F.concat(F.lit(HOST), url), F.lit("QUERY"), F.lit("q")))
    return F.when(F.startswith(url, F.lit(REDIRECT)) & (F.coalesce(target, F.lit("")) != ""), target).otherwise(url)


def normalized(url: Column) -> Column:
    """unwrap; what wasn't a redirect and starts with / is made absolute. A redirect's target stays as it is."""
    target = unwrap(url)
    return F.when((target == url) & F.startswith(url, F.lit("/")), F.concat(F.lit(HOST), url)).otherwise(target)


def search_url(query: Column, geo: Column, zoom: Column, lang: Column) -> Column:
    """The search page of a query; centred only with coordinates and a positive zoom."""
    place = F.concat(F.lit("/@"), F.replace(geo, F.lit(" "), F.lit("")), F.lit(","), zoom.cast("string"), F.lit("z"))
    centred = (F.coalesce(geo, F.lit("")) != "") & (F.coalesce(zoom, F.lit(0)) > 0)
    return F.concat(F.lit(f"{MAPS}/search/"), F.url_encode(query), F.when(centred, place).otherwise(""), F.lit("?hl="), lang)


# Fixed values of the fast search and of the review pages
FAST_SEARCH = (
    "!4m12!1m3!1d3826.902183192154!2d%.4f!3d%.4f!2m3!1f0!2f0!3f0!3m2!1i600!2i800!4f%.1f!7i20!8i0"
    "!10b1!12m22!1m3!18b1!30b1!34e1!2m3!5m1!6e2!20e3!4b0!10b1!12b1!13b1!16b1!17m1!3e1!20m3!5e2!6b1!14b1!46m1!1b0"
    "!96b1!19m4!2m3!1i360!2i120!4i8"
)
REVIEW_PAGE = "!1m6!1s{place}!6m4!4m1!1e1!4m1!1e3!2m2!1i{size}!2s{token}!5m2!1s{request}!7e81!8m9!2b1!3b1!5b1!7b1!12m4!1b1!2b1!4m1!1e1!11m0!13m1!1e1"


def fast_search_parameters(query: Column, lang: Column, lat: Column, lon: Column, zoom: Column) -> Column:
    """map of the fast search's request parameters."""
    given = {"tbm": F.lit("map"), "authuser": F.lit("0"), "hl": lang, "q": query, "pb": F.format_string(FAST_SEARCH, lon.cast("double"), lat.cast("double"), zoom.cast("double"))}
    return F.create_map(*[x for k, v in given.items() for x in (F.lit(k), v)])


def review_page_url(url: Column, token: Column, page_size: int, request: Column) -> Column:
    """The URL of a page of a place's reviews, from the place's URL; null without a place id."""
    parts = {"place": F.url_encode(place_id(url)), "size": F.lit(str(page_size)), "token": F.coalesce(F.url_encode(token), F.lit("")), "request": request}
    pb = F.lit(REVIEW_PAGE)
    for name, value in parts.items():
        pb = F.replace(pb, F.lit("{" + name + "}"), value)
    return F.when(place_id(url) != "", F.concat(F.lit(f"{MAPS}/rpc/listugcposts?authuser=0&hl=en&pb="), pb))


# Where a map URL carries a place id - a field of its data part, a query parameter, or two hex numbers anywhere.
DATA_FIELD, QUERY_FIELD = "!1s", "place_id="
HEX_PAIR = "0x[0-9a-fA-F]+:0x[0-9a-fA-F]+"


def between(text: Column, mark: str, stop: str) -> Column:
    """What follows a mark up to stop or the end: of the first mark that is followed by anything; null if none is."""
    return F.nullif(F.regexp_extract(text, f"{mark}([^{stop}]+)", 1), F.lit(""))


def place_id(url: Column) -> Column:
    """The place id in a URL, decoded; "" if none. The data part comes first, bare hex numbers last."""
    found = F.coalesce(between(url, DATA_FIELD, "!"), between(url, QUERY_FIELD, "&"))
    return F.coalesce(F.try_url_decode(found), found, F.regexp_extract(url, HEX_PAIR, 0))


def unescaped(quoted: Column) -> Column:
    """A script-quoted URL with its escapes resolved; as it is if malformed."""
    return F.coalesce(F.get(F.from_json(F.concat(F.lit('["'), quoted, F.lit('"]')), "array<string>"), 0), quoted)


def eligible_for_email(site: Column) -> Column:
    """A site that isn't a social page. The misspelt name is the rule in force, so instagram.com passes."""
    blocked = F.lit(False)
    for name in ("facebook", "instragram", "twitter"):
        blocked = blocked | F.contains(site, F.lit(name))
    return (F.coalesce(site, F.lit("")) != "") & ~F.coalesce(blocked, F.lit(False))


def single_place(url: Column) -> Column:
    return F.contains(url, F.lit("/maps/place/"))
