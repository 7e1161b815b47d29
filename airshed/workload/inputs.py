"""The library's sources, derived row by row from the given tables.

None of the given tables is environmental, so each source is a fixed projection of a whole table:
every row is used, and defects (nulls, repeats, unknown codes, bad dates) are planted by
arithmetic on the ids. ``oracle.py`` states the same projections in its own SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from airshed.config import AQO_STATIONS, CITIES, FALLBACK_WEATHER_STATIONS, WEATHER_STATIONS
from airshed.operators.aqhi import clean_history
from airshed.operators.grouping import latest


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once and stated after that."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def pick(values: list, at: str) -> str:
    """Element of a fixed list by zero-based position."""
    items = ", ".join("null" if v is None else repr(v) for v in values)
    return f"element_at(array({items}), cast({at} + 1 as int))"


def hotspots(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id as uid",
        "ts as rep_date",
        "cast(ts as date) as date",
        "41e0 + ((event_id % 16500) * 7919 % 16500) / 1000e0 as lat",
        "-96e0 + ((event_id % 22500) * 104729 % 22500) / 1000e0 as lon",
        "event_type as sensor",
        f"if(event_id % 9 <> 0, {pick(['ON', 'MB', 'QC', 'MN'], 'event_id % 4')}, null) as agency",
    )


def aqhi_raw(spark: SparkSession, sf: str, sparse: bool = False) -> DataFrame:
    """Historical readings as landed. The sparse form leaves most calendar days without a row,
    because squares modulo 400 take few values. A station's readings of a day agree, but for
    planted days on which some records differ by one."""
    day = "(event_id % 400) * (event_id % 400) % 400" if sparse else "(event_id % 400) * 31 % 400"
    based = table(spark, sf, "events").selectExpr(
        "event_id as e",
        "user_id % 7 as station",
        f"{day} as day",
        "floor(event_id / 3) % 2 = 1 as is_max",
    )
    levelled = based.selectExpr(
        "*",
        "1 + (day * 7 + floor(day / 9) + station * 3"
        " + if((day + station) % 13 = 0 and e % 5 = 0, 1, 0)"
        " + if(is_max and day % 3 = 0, 1, 0)) % 11 as level",
    )
    return levelled.selectExpr(
        "e as row_id",
        "if(e % 211 = 0, 'not stated',"
        " cast(date_add(date'2024-01-01', cast(day as int)) as string)) as date",
        "if(e % 97 <> 0, concat("
        " if(is_max, concat(1 + e % 12, if(e % 24 < 12, ':00 am', ':00 pm')), '4:00 pm'),"
        " if(e % 3 = 0, ' EDT', ' EST')), null) as time",
        "if(e % 53 <> 0, concat(if(e % 7 = 0, ' ', ''), if(level = 11, '10+', string(level)),"
        " if(e % 7 = 0, ' ', '')), null) as aqhi",
        "case when e % 53 = 0 then null when level = 11 then 'very high risk'"
        " when level <= 3 then 'low risk' when level <= 6 then 'moderate risk'"
        " else 'high risk' end as category",
        f"{pick([s[1] for s in AQO_STATIONS], 'station')} as city",
        f"{pick([s[2] for s in AQO_STATIONS], 'station')} as station_name",
        f"{pick([s[0] for s in AQO_STATIONS], 'station')} as station_id",
        "if(e % 5 = 4, 2025, 2024) as requested_year",
        "if(is_max, 'daily_max', 'daily_4pm') as value_type",
        "if(is_max, 2, 0) as show_day_code",
    )


def aqhi(spark: SparkSession, sf: str, sparse: bool = False) -> DataFrame:
    return clean_history(aqhi_raw(spark, sf, sparse))


HOUR_START = (
    "make_timestamp_ntz(year(ts), month(ts), dayofmonth(ts), hour(ts), 0, 0)"
)


def current(spark: SparkSession, sf: str) -> DataFrame:
    return current_rows(table(spark, sf, "events"))


def current_rows(events: DataFrame) -> DataFrame:
    """Polls of the current feed: an observation is a location and hour, polled many times."""
    locations = ["FAFFD", "FEVJR", "FCWFX", "FEUZB", "FCWYG", "FDQBU", "FDQBX", "XOTHR"]
    location = pick(locations, "user_id % 8")
    return events.selectExpr(
        f"concat_ws('-', {location}, cast(ts as date), hour(ts)) as id",
        f"if(event_id % 103 <> 0, {location}, null) as location_id",
        "concat('Location ', user_id % 8) as location_name_en",
        f"{HOUR_START} as observation_datetime",
        "ts as snapshot_ts",
        "event_id as row_id",
        "if(event_id % 61 <> 0, double(floor(value) % 12 + 1), null) as aqhi",
        "41.5e0 + user_id % 8 as latitude",
        "-95e0 + user_id % 8 as longitude",
    )


def weather(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        *more,
        "event_id as row_id",
        f"{pick([s[0] for s in WEATHER_STATIONS], 'user_id % 4')} as station_id",
        "if(event_id % 499 = 0, 'RENAMED',"
        f" {pick([s[2] for s in WEATHER_STATIONS], 'user_id % 4')}) as station_name",
        f"{pick([s[1] for s in WEATHER_STATIONS], 'user_id % 4')} as city",
        f"{HOUR_START} as date_time_lst",
        "case when event_id % 1009 = 0 then 99e0"
        " when event_id % 17 <> 0 then double(event_id % 60 - 25) end as temp",
        "if(event_id % 1013 = 0, 130e0, double(event_id % 101)) as rh",
        "case when event_id % 997 = 0 then -0.5e0"
        " when event_id % 19 <> 0 then (event_id % 5) * 0.25e0 end as precip",
        "if(event_id % 29 = 0, 'M', null) as precip_flag",
        "case when event_id % 991 = 0 then 40e0"
        " when event_id % 13 <> 0 then double(event_id % 37) end as wind_dir_10s_deg",
        "if(event_id % 31 <> 0, double(event_id % 25), null) as wind_speed",
        "if(event_id % 29 = 1, 'M', null) as wind_flag",
        "1 + user_id % 3 as priority",
    )


def weather_network(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows from three stations a city: the primary, its fallback and one without a rank."""
    ids = [s[0] for s in WEATHER_STATIONS], [s[0] for s in FALLBACK_WEATHER_STATIONS], [800000 + i for i in range(4)]
    at = [pick(x, "row_id2 % 4") for x in ids]
    return weather(spark, sf, "user_id as row_id2").selectExpr(
        "* except (station_id, row_id2)", f"case floor(row_id2 / 4) % 3 when 0 then {at[0]} when 1 then {at[1]} else {at[2]} end as station_id"
    )


def fires_raw(spark: SparkSession, sf: str) -> DataFrame:
    based = table(spark, sf, "orders").selectExpr(
        "o_orderkey as k",
        "o_totalprice",
        "bigint(datediff(cast(o_orderdate as date), date'1970-01-01')) * 86400000"
        " + o_orderkey % 86400000 as ms",
    )
    sentinels = {
        "FIELD_LOCATION": 5,
        "FIELD_PERCENT_CONTAINED": 7,
        "FIELD_SEVERITY_NEAREST_DSR": 11,
        "FIELD_AGENCY_PREPARE_LEVEL": 13,
        "FIELD_FIRE_TYPE_ICS": 17,
    }
    return based.selectExpr(
        "k as OBJECTID",
        "if(k % 301 <> 0, concat('F', k), null) as FIELD_AGENCY_FIRE_ID",
        "if(k % 307 = 0, '', 'ON') as FIELD_AGENCY_CODE",
        f"{pick(['EX', 'EX', ' BM ', 'OC', 'BH', 'UC', 'ZZ', None], 'k % 8')}"
        " as FIELD_STAGE_OF_CONTROL_STATUS",
        f"{pick(['LTG', 'HUM', 'LTG', None], 'k % 4')} as FIELD_AGENCY_FIRE_CAUSE",
        f"{pick(['L', 'H', 'H', 'L', 'X'], 'k % 5')} as FIELD_SYSTEM_FIRE_CAUSE",
        f"{pick(['FUL', 'MON', 'MNP', 'MOD', 'MDP', '-1'], 'k % 6')} as FIELD_RESPONSE_TYPE",
        "case when k % 53 = 0 then 'n/a' when k % 109 = 0 then 'NaN' when k % 113 = 0 then '1d'"
        " when k % 127 = 0 then '7f' else string(o_totalprice) end as FIELD_FIRE_SIZE",
        "if(k % 59 <> 0, string(41.5e0 + ((k % 15500) * 7919 % 15500) / 1000e0), null)"
        " as FIELD_LATITUDE",
        "if(k % 59 <> 0, string(-95.5e0 + ((k % 21500) * 104729 % 21500) / 1000e0), null)"
        " as FIELD_LONGITUDE",
        "if(k % 41 = 0, 'bad', string(ms)) as FIELD_SITUATION_REPORT_DATE",
        "if(k % 37 <> 0, string(ms), null) as FIELD_STATUS_DATE",
        "string(ms) as REFRESHED_DATETIME",
        *[
            f"if(k % 23 <> 0, if(k % {mod} = 0, -1e0, double(k % 100)), null) as {name}"
            for name, mod in sentinels.items()
        ],
    )


def fire_history(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot rows of fires: a fire is an order, a snapshot a line number."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey as fire_id",
        "l_linenumber as snapshot_no",
        "cast(l_shipdate as date) as status_date",
        "l_partkey as part",
        "l_suppkey as supp",
        "l_quantity as size_hectares",
        f"{pick(['EX', 'BM', 'OC', 'BH', 'UC'], 'l_partkey % 5')} as stage",
        "l_returnflag as response",
        "l_extendedprice as price",
    )


def fire_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """One row per fire and snapshot, the last reported one."""
    return latest(
        fire_history(spark, sf),
        ["fire_id", "snapshot_no"],
        ["status_date", "part", "supp", "price", "size_hectares", "response"],
    )


def evacuation_log(spark: SparkSession, sf: str) -> DataFrame:
    cities = [*[c[1] for c in CITIES], "Not applicable", "Ottawa"]
    based = table(spark, sf, "orders").selectExpr(
        "o_orderkey as k",
        "cast(o_orderdate as date) as d",
        "concat('Community ', o_custkey % 50) as place",
    )
    raw = based.selectExpr(
        "case when k % 41 = 0 then concat('EV-', k)"
        " when k % 43 = 0 then concat('EVAC-', lpad(string(k % 1000), 3, '0'))"
        " when k < 1000 then concat('EVAC-', lpad(string(k), 3, '0'))"
        " when k % 101 <> 0 then concat('EVAC-', string(k)) end as event_id",
        "if(k % 47 = 0, upper(place), place) as community",
        f"{pick(cities, 'k % 6')} as nearby_project_city",
        "if(k % 71 = 0, 'not known', string(d)) as evacuation_start_date",
        "case when k % 73 = 0 then 'Ongoing'"
        " when k % 4 <> 0 then string(date_add(d, int(k % 9 - 1))) end as evacuation_end_date",
        f"case when k % 103 = 0 then null when k % 79 = 0 then 'Active' else {pick(['Ongoing', 'Lifted', 'Unknown'], 'k % 3')} end as status",
        "date_add(d, int(k % 20)) as status_as_of_date",
        "'CBC News' as source_name",
        "case when k % 83 = 0 then concat('https://news.aggregator.example/item/', k)"
        " when k % 89 <> 0 then concat('https://www.cbc.ca/news/', k) end as source_url",
        "k as row_id",
    )
    return raw.selectExpr(
        "*",
        "try_to_date(evacuation_start_date, 'yyyy-MM-dd') as start_date",
        "try_to_date(evacuation_end_date, 'yyyy-MM-dd') as end_date",
    )


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """A station register with planted defects, one station per supplier."""
    systems = pick(["geomet", "aqo", "eccc_weather", "aqo", "other"], "s_suppkey % 5")
    return table(spark, sf, "supplier").selectExpr(
        "if(s_suppkey % 31 = 30, s_suppkey - 1, s_suppkey) as station_id",
        "if(s_suppkey % 29 <> 28, concat('S', s_suppkey - (s_suppkey % 17) % 2), null)"
        " as source_station_id",
        "s_name as station_name",
        f"{systems} as source_system",
        "1 + s_nationkey % 6 as city_id",
        "if(s_suppkey % 23 = 7, 95.5e0, 42e0 + (s_suppkey % 140) / 10e0) as latitude",
        "if(s_suppkey % 37 = 9, -190.25e0, -95e0 + (s_suppkey % 200) / 10e0) as longitude",
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """A city table with planted defects, one city per supplier."""
    return table(spark, sf, "supplier").selectExpr(
        "if(s_suppkey % 41 <> 40, s_suppkey - (s_suppkey % 19) div 18, null) as city_id",
        "if(s_suppkey % 43 <> 42, concat('City ', s_suppkey - (s_suppkey % 13) div 12), null) as city_name",
        "if(s_suppkey % 47 <> 46, if(s_suppkey % 23 = 7, 95.5e0, 42e0 + (s_suppkey % 140) / 10e0), null) as latitude",
        "if(s_suppkey % 37 = 9, -190.25e0, -95e0 + (s_suppkey % 200) / 10e0) as longitude",
    )


def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    """A calendar with repeated and missing days, one per order."""
    return table(spark, sf, "orders").selectExpr(
        "if(o_orderkey % 101 <> 100, date_add(date'2024-01-01', int(o_orderkey - (o_orderkey % 53) div 52)), null) as date_id"
    )


def station_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Weather-station candidates, one per customer."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey as station_id",
        f"{pick([c[1] for c in CITIES], 'c_nationkey % 4')} as city",
        "if(c_custkey % 3 = 0, 'daily', 'hourly') as interval",
        "case c_custkey % 5 when 0 then 'NAVCAN' when 1 then 'ECCC-MSC' else 'CCN' end as operator",
        "date_add(date'2023-01-01', int(c_custkey % 700)) as first_date",
        "date_add(date'2026-01-01', int(c_custkey % 400)) as last_date",
        "c_custkey % 7 <> 0 as has_wind",
        "c_custkey % 11 <> 0 as has_precip",
        "(c_custkey * 7919 % 5000) / 10e0 as distance_km",
        "42 + c_custkey % 14 as lat_deg",
        "c_custkey % 60 as lat_min",
        "-95 + c_custkey % 20 as lon_deg",
        "c_custkey * 7 % 60 as lon_min",
    )


def fire_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every day with events and whether its hotspot extract succeeded; some outages are planted."""
    days = table(spark, sf, "events").selectExpr("cast(ts as date) as date").distinct()
    return days.selectExpr("date", "dayofmonth(date) % 7 <> 3 as ok")


def grid_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """First and last day of the readings."""
    return aqhi_raw(spark, sf).selectExpr(
        "min(try_to_date(date, 'yyyy-MM-dd')) as first_day",
        "max(try_to_date(date, 'yyyy-MM-dd')) as last_day",
    )
