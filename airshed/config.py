"""Stations, cities, code tables, thresholds."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values that must equal the published sources (identifiers, names, codes).
# ---------------------------------------------------------------------------

# Historical AQHI stations: source id, project city, station name.
AQO_STATIONS = [
    (47045, "Barrie", "Barrie"),
    (52023, "Kingston", "Kingston"),
    (63200, "Thunder Bay", "Thunder Bay"),
    (31129, "Toronto", "Toronto Downtown"),
    (33003, "Toronto", "Toronto East"),
    (34021, "Toronto", "Toronto North"),
    (35125, "Toronto", "Toronto West"),
]

# Current AQHI locations: location id, project city.
GEOMET_LOCATIONS = [
    ("FAFFD", "Barrie"),
    ("FEVJR", "Kingston"),
    ("FCWFX", "Thunder Bay"),
    ("FEUZB", "Toronto"),
    ("FCWYG", "Toronto"),
    ("FDQBU", "Toronto"),
    ("FDQBX", "Toronto"),
    ("FCKTB", "Toronto"),
]

# Hourly weather stations: source id, project city, station name, climate id.
WEATHER_STATIONS = [
    (42183, "Barrie", "BARRIE-ORO", "6117700"),
    (47267, "Kingston", "KINGSTON CLIMATE", "6104142"),
    (30682, "Thunder Bay", "THUNDER BAY CS", "6048268"),
    (31688, "Toronto", "TORONTO CITY", "6158355"),
]

# AQHI request modes: show_day code, value type.
VALUE_TYPES = [(0, "daily_4pm"), (2, "daily_max")]

# Study rectangle (degrees).
BBOX = {"min_lat": 41.5, "max_lat": 57.0, "min_lon": -95.5, "max_lon": -74.0}

# Stage-of-control codes: code, label, status of the mapping.
STAGE_CODES = [
    ("OC", "Out of Control", "Confirmed"),
    ("BH", "Being Held", "Confirmed"),
    ("UC", "Under Control", "Confirmed"),
    ("EX", "Out (Extinguished)", "Confirmed"),
    ("BM", "Being Monitored (provisional, unconfirmed code)", "Provisional"),
]
ACTIVE_STAGE_CODES = ["OC", "BH", "UC", "BM"]

RESPONSE_CODES = [
    ("FUL", "Full Response"),
    ("MOD", "Modified Response"),
    ("MON", "Monitored Response"),
]

DOCUMENTED_CAUSE_CODES = ["H", "N", "U"]

SENTINEL_FIELDS = [
    "FIELD_LOCATION",
    "FIELD_PERCENT_CONTAINED",
    "FIELD_SEVERITY_NEAREST_DSR",
    "FIELD_AGENCY_PREPARE_LEVEL",
    "FIELD_FIRE_TYPE_ICS",
]

CODED_FIELDS = [
    "FIELD_STAGE_OF_CONTROL_STATUS",
    "FIELD_AGENCY_FIRE_CAUSE",
    "FIELD_SYSTEM_FIRE_CAUSE",
    "FIELD_RESPONSE_TYPE",
    "FIELD_AGENCY_CODE",
]

SOURCE_SYSTEMS = ["geomet", "aqo", "eccc_weather"]
EVENT_STATUSES = ["Ongoing", "Lifted", "Unknown"]
DISTANCE_BANDS_KM = [100, 250, 500]
EARTH_RADIUS_KM = 6371.0088

# Columns of a historical reading as they are compared.
SOURCE_FIELDS = [
    "date",
    "time",
    "aqhi_raw",
    "aqhi_numeric",
    "category",
    "station_id",
    "requested_year",
    "value_type",
]

# Cleaned column -> source field.
TEXT_FIELDS = {
    "fire_id": "FIELD_AGENCY_FIRE_ID",
    "agency_code": "FIELD_AGENCY_CODE",
    "stage_of_control_code": "FIELD_STAGE_OF_CONTROL_STATUS",
    "agency_fire_cause_code": "FIELD_AGENCY_FIRE_CAUSE",
    "system_fire_cause_code": "FIELD_SYSTEM_FIRE_CAUSE",
    "response_type_code": "FIELD_RESPONSE_TYPE",
}
INSTANT_FIELDS = {
    "situation_report_datetime_utc": "FIELD_SITUATION_REPORT_DATE",
    "status_datetime_utc": "FIELD_STATUS_DATE",
    "refreshed_datetime_utc": "REFRESHED_DATETIME",
}

# Checks of the published validation report, in its order.
FIRE_CHECKS = [
    "total_records",
    "missing_fire_ids",
    "missing_latitude",
    "missing_longitude",
    "missing_fire_size",
    "minimum_fire_size_hectares",
    "maximum_fire_size_hectares",
    "confirmed_stage_records",
    "provisional_stage_records",
    "unmapped_stage_records",
    "cause_codes_requiring_review",
]

# ---------------------------------------------------------------------------
# Our own choices where the sources name none (public coordinates, limits, simplified outline).
# ---------------------------------------------------------------------------

# city_id, city_name, region, latitude, longitude
CITIES = [
    (1, "Barrie", "Central Ontario", 44.3894, -79.6903),
    (2, "Kingston", "Eastern Ontario", 44.2312, -76.4860),
    (3, "Thunder Bay", "Northwestern Ontario", 48.3809, -89.2477),
    (4, "Toronto", "Greater Toronto Area", 43.6532, -79.3832),
]
CITY_NAMES = [c[1] for c in CITIES]

# Offset of local standard time from UTC, by city, and the civil zone of all four.
STANDARD_OFFSET_HOURS = -5
CITY_OFFSET_HOURS = {c[1]: STANDARD_OFFSET_HOURS for c in CITIES}
CIVIL_ZONE = "America/Toronto"
CLOCK_OFFSETS = {"EST": -5, "EDT": -4}

# Plausible ranges for hourly weather.
WEATHER_LIMITS = {
    "temp": (-60.0, 50.0),
    "rh": (0.0, 100.0),
    "wind_speed": (0.0, 200.0),
    "wind_dir_10s_deg": (0.0, 36.0),
}
MIN_VALID_HOURS = 18

# Order in which a city's weather stations are asked: station id, place. The fallback ids are stand-ins
# until a fallback is chosen for good.
FALLBACK_WEATHER_STATIONS = [(900000 + s[0], s[1]) for s in WEATHER_STATIONS]
WEATHER_RANKS = [(s[0], 1) for s in WEATHER_STATIONS] + [(s[0], 2) for s in FALLBACK_WEATHER_STATIONS]
LOG_START = "2026-01-01"
PUBLISHER_HOSTS = ["www.cbc.ca", "www.ctvnews.ca"]

# A sketch to try the polygon queries with, not a boundary: corners as (latitude, longitude), first
# point not repeated, and a lake cut out of it. Pass a published boundary (``read_polygon``) instead.
SKETCH_OUTER = [
    (42.0, -83.1),
    (42.7, -82.4),
    (45.3, -82.5),
    (46.1, -83.6),
    (46.5, -84.6),
    (48.2, -88.4),
    (48.0, -89.6),
    (48.6, -92.9),
    (48.9, -94.6),
    (49.4, -95.15),
    (52.84, -95.15),
    (56.85, -88.99),
    (55.2, -82.3),
    (51.2, -79.6),
    (47.5, -79.55),
    (46.2, -78.9),
    (45.5, -76.3),
    (45.2, -74.4),
    (44.1, -76.5),
    (43.6, -79.2),
    (43.2, -79.05),
    (42.8, -79.2),
]
SKETCH_LAKE = [(46.5, -88.0), (48.4, -88.0), (48.0, -85.5), (46.7, -85.2)]
PROVINCE_SKETCH = [SKETCH_OUTER, SKETCH_LAKE]
