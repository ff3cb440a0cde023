"""Seed planning: query lines, geographic grids, seed jobs, keyword chunks."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geo import KM_PER_DEGREE, LEAST_COSINE, coordinate_text, lat_step, lon_step
from ..functions.text import trim_white
from ..functions.url import fast_search_parameters, search_url

SEPARATOR = "#!#"


def parse_query_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """text, id, error per non-blank line "text [#!# id]"; a line with an id but no text is an error row."""
    line = trim_white(F.col(column))
    at = F.instr(line, SEPARATOR)
    text = F.when(at > 0, F.substring(line, F.lit(1), at - 1)).otherwise(line)
    id_ = F.when(at > 0, trim_white(F.substring(line, at + len(SEPARATOR), F.length(line)))).otherwise("")
    found = lines.filter(line != "").select(trim_white(text).alias("text"), id_.alias("id"))
    return found.withColumn("error", F.when(F.col("text") == "", "query text is empty"))


def bounding_box(text: str) -> tuple[float, float, float, float]:
    """min lat, min lon, max lat, max lon of "a,b,c,d"; ValueError names the first broken rule."""
    parts = text.split(",")
    if len(parts) != 4:
        raise ValueError("a bounding box has four numbers")
    values = [float(p) for p in parts]
    if not all(map(math.isfinite, values)):
        raise ValueError("bounding box values must be finite")
    south, west, north, east = values
    if south >= north:
        raise ValueError("minLat must be less than maxLat")
    if west >= east:
        raise ValueError("minLon must be less than maxLon")
    for name, v, most in (("minLat", south, 90), ("maxLat", north, 90), ("minLon", west, 180), ("maxLon", east, 180)):
        if abs(v) > most:
            raise ValueError(f"{name} must be between -{most} and {most}")
    return south, west, north, east


def box_columns(text: Column) -> Column:
    """bounding_box as a column: struct of south, west, north, east and error, which names the first broken rule."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("double"))
    south, west, north, east = (F.get(parts, i) for i in range(4))
    finite = F.lit(True)
    for v in (south, west, north, east):
        finite = finite & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rules = [
        (F.coalesce(F.size(parts), F.lit(0)) != 4, "a bounding box has four numbers"), (F.exists(parts, lambda p: p.isNull()), "bounding box values must be numbers"), (~finite, "bounding box values must be finite"),
        (south >= north, "minLat must be less than maxLat"), (west >= east, "minLon must be less than maxLon"),
    ]
    rules += [(F.abs(v) > most, f"{name} must be between -{most} and {most}") for name, v, most in (("minLat", south, 90), ("maxLat", north, 90), ("minLon", west, 180), ("maxLon", east, 180))]
    return F.struct(south.alias("south"), west.alias("west"), north.alias("north"), east.alias("east"), rule_errors(rules).alias("error"))


def axis_counts(box: tuple[float, float, float, float], km: float, estimate: bool = False) -> tuple[int, int]:
    """Cells per axis: centres strictly below the far edge, or with estimate the rounded-up spans."""
    south, west, north, east = box
    d_lat, d_lon = lat_step(km), lon_step(km, (south + north) / 2)
    shift = 0.0 if estimate else 0.5
    return max(0, math.ceil((north - south) / d_lat - shift)), max(0, math.ceil((east - west) / d_lon - shift))


def box_counts(box: Column, km: Column, estimate: bool = False) -> tuple[Column, Column]:
    """axis_counts as columns, of a struct of south, west, north and east."""
    shift = 0.0 if estimate else 0.5
    d_lat, d_lon = box_steps(box, km)
    return tuple(F.greatest(F.lit(0), F.ceil(span / step - shift)).cast("long") for span, step in ((box["north"] - box["south"], d_lat), (box["east"] - box["west"], d_lon)))


def box_steps(box: Column, km: Column) -> tuple[Column, Column]:
    """lat_step and lon_step as columns, at the middle of a box."""
    size = F.when(km > 0, km).otherwise(1.0)
    cosine = F.cos(F.radians((box["south"] + box["north"]) / 2))
    least = F.when(cosine < 0, -LEAST_COSINE).otherwise(LEAST_COSINE)
    return size / KM_PER_DEGREE, size / (F.lit(KM_PER_DEGREE) * F.when(F.abs(cosine) < LEAST_COSINE, least).otherwise(cosine))


def cells_of_boxes(boxes: DataFrame, box: str, km: str) -> DataFrame:
    """boxes with lat_index, lon_index, lat and lon: a row for each cell of each row's box; boxes without cells have none."""
    b, size = F.col(box), F.col(km)
    (n_lat, n_lon), (d_lat, d_lon) = box_counts(b, size), box_steps(b, size)
    numbered = boxes.filter((n_lat > 0) & (n_lon > 0)).select("*", F.explode(F.sequence(F.lit(0).cast("long"), n_lat * n_lon - 1)).alias("cell"))
    i, j = F.floor(F.col("cell") / n_lon), F.col("cell") % n_lon
    found = numbered.select("*", i.alias("lat_index"), j.alias("lon_index"), (b["south"] + d_lat * (i + 0.5)).alias("lat"), (b["west"] + d_lon * (j + 0.5)).alias("lon"))
    return found.drop("cell")


def grid_cells(spark: SparkSession, box: tuple[float, float, float, float], km: float) -> DataFrame:
    """lat_index, lon_index, lat, lon of every cell centre, in latitude-major order of the indices.

    One range over all cells: no join, and any number of partitions.
    """
    south, west, _, _ = box
    n_lat, n_lon = axis_counts(box, km)
    i, j = F.floor(F.col("id") / max(n_lon, 1)), F.col("id") % max(n_lon, 1)
    d_lat, d_lon = lat_step(km), lon_step(km, (box[0] + box[2]) / 2)
    return spark.range(n_lat * n_lon).select(
        i.alias("lat_index"), j.alias("lon_index"), (F.lit(south) + F.lit(d_lat) * (i + 0.5)).alias("lat"), (F.lit(west) + F.lit(d_lon) * (j + 0.5)).alias("lon")
    )


def check_zoom(zoom: int) -> None:
    if not 1 <= zoom <= 21:
        raise ValueError("zoom must be between 1 and 21")


def named(queries: DataFrame) -> DataFrame:
    """queries with a uuid for each null or blank id."""
    return queries.withColumn("id", F.when(F.coalesce("id", F.lit("")) == "", F.uuid()).otherwise(F.col("id")))


#: Cells of a grid and keyword parts that are worth a broadcast; a grid's size is known before it is made.
BROADCAST_CELLS = 1_000_000


def seed_jobs(queries: DataFrame, lang: str = "en", depth: int = 1, geo: str = "", zoom: int = 15, fast: bool = False, radius: float = 0.0) -> DataFrame:
    """A search job per query (text, id). A blank id becomes a random one, as in named().

    Fast mode needs coordinates, a zoom of 1-21 and a radius.
    """
    queries = named(queries)
    if fast:
        parts = geo.replace(" ", "").split(",")
        if len(parts) != 2:
            raise ValueError("fast mode needs coordinates")
        lat, lon = map(float, parts)
        if not (-90 <= lat <= 90 and -180 <= lon <= 180):
            raise ValueError("coordinates must lie within -90..90 and -180..180")
        check_zoom(zoom)
        if radius < 0:
            raise ValueError("radius must not be negative")
        return queries.select("id", "text", F.lit("fast").alias("kind"), fast_search_parameters(F.col("text"), F.lit(lang), F.lit(lat), F.lit(lon), F.lit(zoom)).alias("parameters"), F.lit(radius).alias("radius"))
    return queries.select("id", "text", F.lit("search").alias("kind"), search_url(F.col("text"), F.lit(geo), F.lit(zoom), F.lit(lang)).alias("url"), F.lit(depth).alias("depth"))


def grid_seed_jobs(queries: DataFrame, cells: DataFrame, zoom: int, lang: str = "en") -> DataFrame:
    """Every query at every cell: a job is one of the two sides' product by definition.

    ids are the query's and the cell's indices, so they are the same each time; a blank query id is a
    uuid.  ValueError without a query or a cell.  Cells up to BROADCAST_CELLS are broadcast.
    """
    check_zoom(zoom)
    n = cells.count()
    if not n:
        raise ValueError("the grid has no cells")
    if queries.isEmpty():
        raise ValueError("there are no queries")
    queries = named(queries)
    cells = F.broadcast(cells) if n <= BROADCAST_CELLS else cells
    geo = coordinate_text(F.col("lat"), F.col("lon"))
    return queries.crossJoin(cells).select(
        F.concat_ws("-", F.col("id"), F.col("lat_index"), F.col("lon_index")).alias("id"), F.col("text"), geo.alias("geo"),
        search_url(F.col("text"), geo, F.lit(zoom), F.lit(lang)).alias("url"),
    )


def keyword_chunks(keywords: DataFrame, key: str, order: str, size: int = 100) -> DataFrame:
    """part (from 0), n, keywords: non-blank trimmed keywords in order, size to a part.

    Numbers come from counts per range partition, so no task sorts all rows.  ValueError without a
    keyword.
    """
    clean = keywords.select(trim_white(F.col(key)).alias("k"), F.col(order).alias("o")).filter(F.col("k") != "")
    if clean.isEmpty():
        raise ValueError("there are no keywords")
    return numbered(clean, ["o", "k"]).groupBy(F.floor(F.col("number") / size).alias("part")).agg(
        F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "k"))), lambda x: x["k"]), "|").alias("keywords")
    )


def numbered(df: DataFrame, order: list[str], column: str = "number") -> DataFrame:
    """Adds consecutive numbers from 0 in the given total order, without a single-partition window.

    df's own columns may have any names but the new one's.
    """
    part, inside, size, before = (next(f"_{stem}_{i}" for i in itertools.count() if f"_{stem}_{i}" not in df.columns) for stem in ("part", "inside", "size", "before"))
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    tagged = ranged.withColumn(part, F.spark_partition_id()).withColumn(inside, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = tagged.groupBy(part).agg(F.count("*").alias(size))
    starts = sizes.withColumn(before, F.sum(size).over(Window.orderBy(part)) - F.col(size)).select(part, before)  # a row per partition
    return tagged.join(F.broadcast(starts), part).withColumn(column, F.col(inside) + F.col(before)).drop(part, inside, before)


def rule_errors(rules: list[tuple[Column, str]]) -> Column:
    """The message of the first broken rule, null if none."""
    return F.coalesce(*[F.when(broken, message) for broken, message in rules], F.lit(None).cast("string"))


def request_errors(keyword: Column, geo: Column, zoom: Column, radius: Column, depth: Column, timeout: Column, fast: Column) -> Column:
    """What is wrong with a scrape request after its defaults; null if nothing. No zoom is 0, no coordinates are blank."""
    given = F.coalesce(geo, F.lit("")) != ""
    lat, lon = (F.trim(F.get(F.split(geo, ","), i)).try_cast("double") for i in range(2))
    zoom, fast = F.coalesce(zoom, F.lit(0)), F.coalesce(fast, F.lit(False))
    return rule_errors([
        (F.coalesce(keyword, F.lit("")) == "", "keyword is required"), (given & (F.size(F.split(geo, ",")) != 2), "geo_coordinates must contain exactly one comma"),
        (given & lat.isNull(), "invalid latitude"), (given & lon.isNull(), "invalid longitude"), (given & ~lat.between(-90, 90), "latitude must be between -90 and 90"), (given & ~lon.between(-180, 180), "longitude must be between -180 and 180"),
        (fast & ~given, "geo_coordinates are required in fast mode"), (fast & (zoom == 0), "zoom is required in fast mode"),
        (~zoom.between(0, 21), "zoom must be between 1 and 21"), (radius < 0, "radius must be non-negative"),
        (~depth.between(0, 100), "max_depth must be between 0 and 100"), (~timeout.between(1, 300), "timeout must be between 1 and 300 seconds"),
    ])


def effective_timeout(seconds: Column) -> Column:
    return F.when((seconds <= 0) | (seconds > 300), 300).otherwise(seconds)


def web_time_budget(seeds: Column, depth: Column, max_time: Column) -> Column:
    """Seconds: at least 60, or the given maximum (at least 180)."""
    usual = F.greatest(F.lit(60), F.floor(seeds * 10 * depth / 50) + 120)
    return F.when(max_time > 0, F.greatest(F.lit(180), max_time)).otherwise(usual)
