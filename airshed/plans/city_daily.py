"""fact_city_daily: one row per city and calendar day, with a flag per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.config import CITIES, DISTANCE_BANDS_KM

HOTSPOT_COUNTS = [f"hotspots_within_{b}km" for b in DISTANCE_BANDS_KM]


def pivot_modes(city_aqhi: DataFrame) -> DataFrame:
    """Both daily AQHI definitions side by side; neither is chosen here."""
    return city_aqhi.groupBy("city", "date").agg(
        F.expr("max(if(value_type = 'daily_4pm', aqhi, null)) as aqhi_daily_4pm"),
        F.expr("max(if(value_type = 'daily_max', aqhi, null)) as aqhi_daily_max"),
        F.expr("max(any_10_plus) as aqhi_any_10_plus"),
    )


def assemble(
    grid: DataFrame,
    city_aqhi: DataFrame,
    exposure: DataFrame,
    weather: DataFrame,
    fire_days: DataFrame,
) -> DataFrame:
    """The grid with all three daily tables.

    ``fire_days`` (date, ok) says which days a hotspot extract covered. A covered day without
    hotspots is a true zero with no nearest distance; any other day is unknown. Stations other than the
    primary that a day's weather rests on are named, joined by commas. Every input is already at
    city-day grain, so the joins move the small daily tables only, all on the same two keys.
    """
    ids = ", ".join(f"'{c[1]}', {c[0]}" for c in CITIES)
    city_id = f"try_element_at(map({ids}), city) as city_id"
    air = pivot_modes(city_aqhi).selectExpr(
        city_id, "date as date_id", "aqhi_daily_4pm", "aqhi_daily_max", "aqhi_any_10_plus"
    )
    wx = weather.selectExpr(
        city_id,
        "date as date_id",
        "temp_mean",
        "temp_min",
        "temp_max",
        "precip_total",
        "wind_speed_mean",
        "wind_dir_mean_deg",
        "weather_data_available as wx_ok",
        "fallback_stations as weather_fallback_stations",
    )
    covered = fire_days.selectExpr("date as date_id", "ok as fire_ok")
    keys = ["city_id", "date_id"]
    joined = (
        grid.join(covered, "date_id", "left")
        .join(air, keys, "left")
        .join(exposure.withColumnRenamed("date", "date_id"), keys, "left")
        .join(wx, keys, "left")
    )
    return joined.selectExpr(
        *keys,
        "aqhi_daily_4pm",
        "aqhi_daily_max",
        "aqhi_any_10_plus",
        "aqhi_daily_4pm is not null or aqhi_daily_max is not null as aqhi_data_available",
        *[f"if(fire_ok, coalesce({c}, 0), null) as {c}" for c in HOTSPOT_COUNTS],
        "if(fire_ok, nearest_hotspot_distance_km, null) as nearest_hotspot_distance_km",
        "coalesce(fire_ok, false) as fire_data_available",
        "temp_mean",
        "temp_min",
        "temp_max",
        "precip_total",
        "wind_speed_mean",
        "wind_dir_mean_deg",
        "coalesce(wx_ok, false) as weather_data_available",
        "weather_fallback_stations",
    )
