"""Registers the domain functions for use in SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from .functions import email, geo, url
from .plans.seeds import axis_counts, bounding_box, lat_step, lon_step

#: name -> (parameters, result, the column function that the library uses itself).
FUNCTIONS = {
    "haversine_m": ("lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE", "DOUBLE", geo.haversine_m),
    "olc_encode": ("lat DOUBLE, lon DOUBLE", "STRING", geo.plus_code),
    "strip_nul": ("s STRING", "STRING", lambda s: F.replace(s, F.lit("\u0000"), F.lit(""))),
    "extract_emails": ("s STRING", "ARRAY<STRING>", email.text_emails),
    "unwrap_url": ("u STRING", "STRING", url.unwrap),
    "place_id": ("u STRING", "STRING", url.place_id),
    "site_eligible": ("u STRING", "BOOLEAN", url.eligible_for_email),
    "rating_histogram": ("ratings ARRAY<INT>", "MAP<INT, BIGINT>", lambda r: F.map_from_arrays(F.array(*[F.lit(i) for i in range(1, 6)]), F.array(*[(F.size(r) - F.size(F.array_remove(r, i))).cast("long") for i in range(1, 6)]))),
}


class GridCells:
    """grid_cells('minLat,minLon,maxLat,maxLon', km): lat and lon of every cell centre."""

    def eval(self, box: str, km: float):
        b = bounding_box(box)
        n_lat, n_lon = axis_counts(b, km)
        d_lat, d_lon = lat_step(km), lon_step(km, (b[0] + b[2]) / 2)
        for i in range(n_lat):
            for j in range(n_lon):
                yield b[0] + d_lat * (i + 0.5), b[1] + d_lon * (j + 0.5)


def place_from_json(spark: SparkSession, view: str, result: str, column: str = "payload") -> None:
    """Makes the view result: the places parsed from a column of another view. A place has 34 fields, so it is a
    view and not a function; columns that a query doesn't read are not parsed."""
    from .operators.places import parse_places

    parse_places(spark.table(view), column).createOrReplaceTempView(result)


def sql_text(spark: SparkSession, parameters: str, function: Callable[..., Column]) -> str:
    """A column function of the parameters as SQL text: what the analyzer makes of it, printed."""
    row = spark.createDataFrame([], parameters.replace(" ", ": ").replace(",:", ","))
    plan = row.select(function(*[F.col(c) for c in row.columns]).alias("out"))._jdf.queryExecution().analyzed()
    return plan.expressions().head().child().sql()


def register(spark: SparkSession) -> None:
    for name, (parameters, result, function) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {sql_text(spark, parameters, function)}")
    spark.udtf.register("grid_cells", udtf(GridCells, returnType="lat double, lon double"))
