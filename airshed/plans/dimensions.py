"""City, date and station dimensions, and the city-by-day grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.config import AQO_STATIONS, CITIES, CITY_OFFSET_HOURS, GEOMET_LOCATIONS, WEATHER_STATIONS
from airshed.functions.moments import iso_weekday
from airshed.operators.grouping import literal_rows


def dim_city(spark: SparkSession, cities: Sequence[tuple] = CITIES) -> DataFrame:
    rows = literal_rows(
        spark, ["city_id", "city_name", "region", "latitude", "longitude"], list(cities)
    )
    return rows.withColumns(
        {c: F.col(c).cast("decimal(9,6)") for c in ("latitude", "longitude")}
    )


def calendar(bounds: DataFrame, first: str, last: str, name: str = "date_id") -> DataFrame:
    """Every day from ``first`` to ``last`` of a one-row table of bounds."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias(name))


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes follow from the date; the fire season stays null until a rule exists."""
    d = F.col("date_id")
    return days.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        iso_weekday(d).alias("day_of_week"),
        F.lit(None).cast("boolean").alias("is_fire_season"),
    )


def station_register(spark: SparkSession) -> DataFrame:
    """All source stations with surrogate ids in natural-key order (stable, unlike an identity), and the
    offset of their local standard time from UTC."""
    city_ids = {c[1]: c[0] for c in CITIES}
    places = {c[0]: (c[3], c[4]) for c in CITIES}
    offsets = {city_ids[name]: hours for name, hours in CITY_OFFSET_HOURS.items()}
    natural = sorted(
        [("aqo", str(i), name, city_ids[city]) for i, city, name in AQO_STATIONS]
        + [("geomet", i, i, city_ids[city]) for i, city in GEOMET_LOCATIONS]
        + [("eccc_weather", str(i), name, city_ids[city]) for i, city, name, _ in WEATHER_STATIONS]
    )
    rows = [
        (n, source_id, name, system, city, *places[city], offsets[city])
        for n, (system, source_id, name, city) in enumerate(natural, start=1)
    ]
    return literal_rows(
        spark,
        [
            "station_id",
            "source_station_id",
            "station_name",
            "source_system",
            "city_id",
            "latitude",
            "longitude",
            "utc_offset_hours",
        ],
        rows,
    )


def with_station_city(
    rows: DataFrame, stations: DataFrame, system: str, source_id: Column
) -> DataFrame:
    """Warehouse station and city of each row; rows of unknown stations stay, with nulls.

    The register is VALUES of known size, so the optimizer broadcasts it by its own size check.
    """
    lookup = stations.select(
        F.col("station_id").alias("warehouse_station_id"),
        "source_system",
        "source_station_id",
        "city_id",
        "utc_offset_hours",
    )
    keyed = rows.withColumns(
        {"source_system": F.lit(system), "source_station_id": source_id.cast("string")}
    )
    return keyed.join(lookup, ["source_system", "source_station_id"], "left")


def city_day_grid(days: DataFrame, cities: Sequence[tuple] = CITIES) -> DataFrame:
    """Every city on every day, by exploding the short city list beside each date."""
    return days.select(
        F.explode(F.array(*[F.lit(c[0]) for c in cities])).alias("city_id"), "date_id"
    )
