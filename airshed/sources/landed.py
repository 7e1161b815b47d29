"""Landed tables to the columns that the operators read, one function per source.

Each takes the table as it was landed, all text or already typed, conforms it to the source's
schema and renames or parses what the operators call otherwise. Landed columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions.moments import parse_date
from airshed.operators.aqhi import clean_history
from airshed.sources.schemas import (
    ACTIVE_FIRES,
    AQHI_CURRENT,
    AQHI_HISTORICAL,
    EVACUATION_LOG,
    HOTSPOTS,
    WEATHER_HOURLY,
    conform,
)

# Headers of hourly station files after normalisation -> names of the operators.
WEATHER_NAMES = {
    "temp_c": "temp",
    "rel_hum": "rh",
    "precip_amount_mm": "precip",
    "precip_amount_flag": "precip_flag",
    "wind_dir_flag": "wind_flag",
    "wind_spd_km_h": "wind_speed",
}


def hotspots(df: DataFrame) -> DataFrame:
    return conform(df, HOTSPOTS, ["uid", "rep_date", "lat", "lon"]).withColumn("date", F.col("rep_date").cast("date"))


def current(df: DataFrame) -> DataFrame:
    rows = conform(df, AQHI_CURRENT, ["id"])
    instant = F.col("observation_datetime").try_cast("timestamp").cast("timestamp_ntz")
    return rows.withColumn("observation_datetime", instant)


def history(df: DataFrame) -> DataFrame:
    """Adds the parsed date, the flag of capped readings and their number."""
    return clean_history(conform(df, AQHI_HISTORICAL, ["date", "time", "aqhi", "station_id", "value_type", "requested_year"]))


def fires(df: DataFrame) -> DataFrame:
    return conform(df, ACTIVE_FIRES, ["OBJECTID"])


def weather(df: DataFrame, priority: DataFrame | None = None) -> DataFrame:
    """Adds city, station_id, station_name; with ``priority`` (station_id, priority) the station's rank."""
    for landed, name in WEATHER_NAMES.items():
        if landed in df.columns and name not in df.columns:
            df = df.withColumnRenamed(landed, name)
    rows = conform(df, WEATHER_HOURLY, ["date_time_lst", "project_city", "project_station_id"]).withColumns(
        {
            "city": F.col("project_city"),
            "station_id": F.col("project_station_id"),
            "station_name": F.col("project_station_name"),
        }
    )
    return rows if priority is None else rows.join(priority.select("station_id", "priority"), "station_id", "left")


def evacuations(df: DataFrame) -> DataFrame:
    """Adds status and the parsed dates; a text that is no date gives null and stays beside it."""
    rows = conform(df, EVACUATION_LOG, ["event_id", "community", "evacuation_start_date", "event_status"])
    return rows.withColumns(
        {
            "status": F.col("event_status"),
            "start_date": parse_date(F.col("evacuation_start_date")),
            "end_date": parse_date(F.col("evacuation_end_date")),
            "status_as_of_date": parse_date(F.col("status_as_of_date")),
        }
    )
