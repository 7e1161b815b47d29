"""Hotspots near cities, and hotspots inside the province."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.config import BBOX, CITIES, DISTANCE_BANDS_KM
from airshed.functions.geo import haversine_km
from airshed.functions.moments import strict_date
from airshed.operators import nearby
from airshed.operators.cover import inside_polygon
from airshed.operators.grouping import literal_rows

# So many cities are measured in one scan; expressions for more would not compile well.
CITIES_PER_SCAN = 32


def bbox_time_filter(
    df: DataFrame,
    start: str,
    end: str,
    time_col: str = "rep_date",
    box: dict[str, float] = BBOX,
) -> DataFrame:
    """Rows in the rectangle from the first second of ``start`` to the last second of ``end``."""
    first, last = strict_date(start), strict_date(end)
    if first > last:
        raise ValueError("the start date lies after the end date")
    lower = F.lit(str(first)).cast("timestamp_ntz")
    upper = F.lit(f"{last} 23:59:59").cast("timestamp_ntz")
    return df.where(
        F.col(time_col).between(lower, upper)
        & F.col("lat").between(box["min_lat"], box["max_lat"])
        & F.col("lon").between(box["min_lon"], box["max_lon"])
    )


def city_exposure(
    hotspots: DataFrame,
    cities: Sequence[tuple] = CITIES,
    bands: Sequence[int] = DISTANCE_BANDS_KM,
    day: str = "date",
) -> DataFrame:
    """Per city and day: hotspots within each band, and the distance to the nearest one.

    Each distance is an expression of the row, so one scan and one partial aggregate per day do the
    work for up to ``CITIES_PER_SCAN`` cities; more cities take further scans, to the same result.
    The nearest distance is over all hotspots of the day; a day without any has no rows. Hotspots
    without a position count for nothing.
    """
    hotspots = hotspots.where("lat is not null and lon is not null")
    parts = [
        _exposure_of(hotspots, cities[i : i + CITIES_PER_SCAN], bands, day)
        for i in range(0, len(cities), CITIES_PER_SCAN)
    ]
    return reduce(DataFrame.unionByName, parts)


def _exposure_of(hotspots: DataFrame, cities: Sequence[tuple], bands: Sequence[int], day: str) -> DataFrame:
    measured = hotspots.select(
        day, *[haversine_km("lat", "lon", c[3], c[4]).alias(f"km_{c[0]}") for c in cities]
    )
    wide = measured.groupBy(day).agg(
        *[
            F.expr(f"count_if(km_{c[0]} <= {b}) as n{b}_{c[0]}") for c in cities for b in bands
        ],
        *[F.min(f"km_{c[0]}").alias(f"near_{c[0]}") for c in cities],
    )
    per_city = ", ".join(
        "struct("
        + ", ".join(
            [
                f"{c[0]} as city_id",
                *[f"n{b}_{c[0]} as hotspots_within_{b}km" for b in bands],
                f"near_{c[0]} as nearest_hotspot_distance_km",
            ]
        )
        + ")"
        for c in cities
    )
    return wide.selectExpr(day, f"inline(array({per_city}))")


def site_exposure(
    hotspots: DataFrame,
    sites: DataFrame,
    bands: Sequence[int] = DISTANCE_BANDS_KM,
    day: str = "date",
    cell_degrees: float = 0.25,
    crowded: int = 100_000,
) -> DataFrame:
    """The same rows as ``city_exposure`` for any number of sites (city_id, site_lat, site_lon), at any distance.

    The work of a site grows with the root of the number of hotspots: see ``strips``. Sites far from any
    hotspot look for the nearest in cells of ``cell_degrees`` (see ``nearby``); a cell with more than ``crowded``
    positions on a day is measured by several tasks.
    """
    return nearby.exposure_of_sites(hotspots, sites, bands, day, cell_degrees, crowded)


def outline_vertices(spark: SparkSession, rings: Sequence[Sequence[tuple[float, float]]]) -> DataFrame:
    """The vertices of rings that are given as lists of (latitude, longitude)."""
    rows = [(r, i, float(lat), float(lon)) for r, ring in enumerate(rings) for i, (lat, lon) in enumerate(ring)]
    return literal_rows(spark, ["ring", "seq", "lat", "lon"], rows)


def inside_outline(
    points: DataFrame, rings: Sequence[Sequence[tuple[float, float]]], first_degrees: float = 0.5
) -> DataFrame:
    """``cover.inside_polygon`` for rings given as lists; the rectangle around them reaches the scan."""
    lats, lons = [p[0] for ring in rings for p in ring], [p[1] for ring in rings for p in ring]
    boxed = points.where(
        F.col("lat").between(min(lats), max(lats)) & F.col("lon").between(min(lons), max(lons))
    )
    return inside_polygon(boxed, outline_vertices(points.sparkSession, rings), first_degrees)


def province_daily_totals(
    inside: DataFrame, day: str = "date", north_of: float = 48.0, west_of: float = -85.0
) -> DataFrame:
    """Hotspots per day in the province, those in its north-west, and the earliest date overall."""
    return inside.groupBy(day).agg(
        F.count(F.lit(1)).alias("total_hotspots"),
        F.count_if((F.col("lat") >= north_of) & (F.col("lon") <= west_of)).alias(
            "northwest_hotspots"
        ),
    )


def earliest_hotspot(inside: DataFrame, time_col: str = "rep_date") -> DataFrame:
    return inside.agg(
        F.min(time_col).alias("earliest_hotspot"), F.count(F.lit(1)).alias("hotspots_inside")
    )
