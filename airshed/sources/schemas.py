"""Column types of the landed sources, and typed empty tables for optional columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(columns: str) -> T.StructType:
    """Schema from "name type, name type", without needing a session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Named columns of each source; a file may hold more, which are kept as text.
HOTSPOTS = struct(
    "uid string, rep_date timestamp_ntz, lat double, lon double, source string, sensor string, "
    "satellite string, agency string, temp double, rh double, ws double, wd double, pcp double, "
    "ffmc double, dmc double, dc double, isi double, bui double, fwi double, ros double, "
    "sfc double, tfc double, hfi double, frp double, estarea double"
)
AQHI_CURRENT = struct(
    "id string, location_id string, location_name_en string, location_name_fr string, "
    "observation_type string, aqhi_type string, observation_datetime string, "
    "observation_datetime_text_en string, observation_datetime_text_fr string, "
    "special_notes_en string, special_notes_fr string, aqhi double, latest boolean"
)
AQHI_HISTORICAL = struct(
    "row_id bigint, date string, time string, aqhi string, category string, city string, "
    "station_name string, station_id int, requested_year int, value_type string, show_day_code int"
)
ACTIVE_FIRES = struct(
    "OBJECTID bigint, FIELD_AGENCY_FIRE_ID string, FIELD_AGENCY_CODE string, "
    "FIELD_STAGE_OF_CONTROL_STATUS string, FIELD_AGENCY_FIRE_CAUSE string, "
    "FIELD_SYSTEM_FIRE_CAUSE string, FIELD_RESPONSE_TYPE string, FIELD_FIRE_SIZE string, "
    "FIELD_LATITUDE string, FIELD_LONGITUDE string, FIELD_SITUATION_REPORT_DATE string, "
    "FIELD_STATUS_DATE string, REFRESHED_DATETIME string, FIELD_LOCATION double, "
    "FIELD_PERCENT_CONTAINED double, FIELD_SEVERITY_NEAREST_DSR double, "
    "FIELD_AGENCY_PREPARE_LEVEL double, FIELD_FIRE_TYPE_ICS double"
)
WEATHER_HOURLY = struct(
    "date_time_lst timestamp_ntz, temp double, rh double, precip double, precip_flag string, "
    "wind_dir_10s_deg double, wind_speed double, wind_flag string, project_city string, "
    "project_station_name string, project_station_id int, project_climate_id string"
)
EVACUATION_LOG = struct(
    "event_id string, community string, nearby_project_city string, evacuation_start_date string, "
    "evacuation_end_date string, event_status string, status_as_of_date string, "
    "related_fire_id string, source_name string, source_publication_date string, "
    "source_url string, secondary_source_name string, secondary_source_publication_date string, "
    "secondary_source_url string, notes string"
)


def conform(
    df: DataFrame, schema: T.StructType, required: Sequence[str] = (), keep_extra: bool = True
) -> DataFrame:
    """The table with the schema's columns in order and typed.

    A missing required column is an error, a missing optional one becomes typed nulls, text that
    does not parse becomes null.
    """
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    typed = [
        F.col(f.name).try_cast(f.dataType).alias(f.name)
        if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    extra = [c for c in df.columns if c not in schema.fieldNames()] if keep_extra else []
    return df.select(*typed, *extra)
