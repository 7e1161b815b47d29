"""Great-circle distance and coordinate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.config import EARTH_RADIUS_KM


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; arguments are column names or numbers, in degrees."""
    a, b, c, d = (x if isinstance(x, str) else f"{float(x)!r}D" for x in (lat1, lon1, lat2, lon2))
    return F.expr(
        f"2 * {EARTH_RADIUS_KM}D * asin(least(1D, sqrt("
        f"pow(sin(radians({c} - {a}) / 2), 2)"
        f" + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"
    )


def degrees_minutes(deg: Column, minutes: Column, seconds: Column | None = None) -> Column:
    """Decimal degrees from degrees, minutes and seconds; the sign is that of the degrees."""
    part = minutes / F.lit(60.0)
    if seconds is not None:
        part = part + seconds / F.lit(3600.0)
    return F.when(deg < 0, deg - part).otherwise(deg + part)
