"""Geographic column functions. Distances in metres, angles in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model
EARTH_RADIUS_M = 6_371_000
KM_PER_DEGREE = 111.32
LEAST_COSINE = 1e-6
CODE_ALPHABET = "23456789CFGHJMPQRVWX"


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    half = lambda a, b: F.pow(F.sin((F.radians(b) - F.radians(a)) / 2), F.lit(2.0))
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2.0 * EARTH_RADIUS_M * F.atan2(F.sqrt(h), F.sqrt(1.0 - h))


def within_box(lat: Column, lon: Column, at_lat: Column, at_lon: Column, radius_m: float) -> Column:
    """A cheap necessary condition of haversine_m <= radius_m, on plain column ranges.

    Circles that reach a pole or the antimeridian only bound the latitude.
    """
    d_lat = math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9)
    cosine = F.cos(F.radians(F.least(F.abs(at_lat) + d_lat, F.lit(90.0))))
    d_lon = F.when(cosine > F.lit(radius_m / EARTH_RADIUS_M), F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(min(radius_m / EARTH_RADIUS_M, math.pi / 2))) / cosine)))).otherwise(F.lit(360.0)) * (1 + 1e-9)
    crosses = (at_lon - d_lon < -180) | (at_lon + d_lon > 180)
    return lat.between(at_lat - d_lat, at_lat + d_lat) & (crosses | lon.between(at_lon - d_lon, at_lon + d_lon))


def coordinate_text(lat: Column, lon: Column) -> Column:
    """"lat,lon" with six decimals."""
    return F.format_string("%f,%f", lat.cast("double"), lon.cast("double"))


def coordinates(text: Column) -> Column:
    """struct<lat, lon> of "lat,lon"; anything malformed is 0, 0."""
    parts = F.split(text, ",")
    lat, lon = F.get(parts, 0), F.get(parts, 1)
    number = lambda p: F.trim(p).try_cast("double")
    good = (F.size(parts) == 2) & number(lat).isNotNull() & number(lon).isNotNull()
    return F.struct(F.when(good, number(lat)).otherwise(0.0).alias("lat"), F.when(good, number(lon)).otherwise(0.0).alias("lon"))


def plus_code(lat: Column, lon: Column) -> Column:
    """Open Location Code of ten digits, by the public specification."""
    cells = 8000  # per degree at ten digits
    north = F.greatest(F.lit(0), F.least(F.lit(180 * cells - 1), F.floor(lat * cells) + 90 * cells))
    east = F.pmod(F.floor(lon * cells) + 180 * cells, F.lit(360 * cells))
    digits = []
    for k in range(4, -1, -1):
        for value in (north, east):
            digits.append(F.substring(F.lit(CODE_ALPHABET), (F.pmod(F.floor(value / 20**k), F.lit(20)) + 1).cast("int"), F.lit(1)))
    return F.concat(*digits[:8], F.lit("+"), *digits[8:])


def lat_step(km: float) -> float:
    return (km if km > 0 else 1.0) / KM_PER_DEGREE


def lon_step(km: float, mid_lat: float) -> float:
    cosine = math.cos(math.radians(mid_lat))
    if abs(cosine) < LEAST_COSINE:
        cosine = math.copysign(LEAST_COSINE, cosine)
    return (km if km > 0 else 1.0) / (KM_PER_DEGREE * abs(cosine))
