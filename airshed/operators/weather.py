"""Hourly station weather: missing classes, completeness, daily features, station choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airshed.config import CIVIL_ZONE, MIN_VALID_HOURS, STANDARD_OFFSET_HOURS, WEATHER_RANKS
from airshed.functions import wind
from airshed.functions.moments import civil_date, hour_index, lst_to_utc
from airshed.operators.grouping import literal_rows
from airshed.operators.quality import n_rows

FIELDS = ["temp", "rh", "precip", "wind_dir_10s_deg", "wind_speed"]
STATISTICS = {"mean": "avg", "min": "min", "max": "max"}
# Distinct hours of a day, as the number of bits set.
HOURS_SEEN = "bit_count(bit_or(if({when}, shiftleft(1, hour(date_time_lst)), null)))"


def wind_missing_class(direction: Column, speed: Column, flag: Column) -> Column:
    """A missing direction is valid in calm air; a flagged or blowing one is a real gap."""
    return (
        F.when(F.coalesce(flag == "M", F.lit(False)), "flagged")
        .when(direction.isNotNull(), "observed")
        .when(speed == 0, "calm")
        .when(speed > 0, "missing")
        .otherwise("unknown")
    )


def precip_class(amount: Column, flag: Column) -> Column:
    """Zero is an observation, a blank is none."""
    return (
        F.when(F.coalesce(flag == "M", F.lit(False)), "flagged")
        .when(amount.isNull(), "blank")
        .when(amount < 0, "invalid_negative")
        .when(amount == 0, "zero")
        .otherwise("positive")
    )


def with_classes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "wind_class": wind_missing_class(
                F.col("wind_dir_10s_deg"), F.col("wind_speed"), F.col("wind_flag")
            ),
            "precip_class": precip_class(F.col("precip"), F.col("precip_flag")),
        }
    )


def with_utc(df: DataFrame, offset: Column | None = None) -> DataFrame:
    """UTC instant and civil date beside the untouched local-standard-time stamp."""
    hours = F.lit(STANDARD_OFFSET_HOURS) if offset is None else offset
    return df.withColumn("date_time_utc", lst_to_utc(F.col("date_time_lst"), hours)).withColumn(
        "civil_date", civil_date(F.col("date_time_utc"))
    )


def with_vectors(df: DataFrame) -> DataFrame:
    """Direction in degrees and wind vector components; null where either part is missing."""
    degrees = wind.direction_deg("wind_dir_10s_deg")
    return df.selectExpr(
        "*",
        f"{degrees} as wind_direction_degrees",
        f"{wind.component_u('wind_speed', degrees)} as wind_u",
        f"{wind.component_v('wind_speed', degrees)} as wind_v",
    )


def station_hours(df: DataFrame, keys: Sequence[str], station: str = "station_id") -> DataFrame:
    """One row per station and hour: the mean of what its rows say, and how many rows there were.

    An amount of precipitation that is flagged as missing or negative is none; the same hour landed
    twice counts once. Keys are kept beside the station.
    """
    flagged = "coalesce(precip_flag = 'M', false)" if "precip_flag" in df.columns else "false"
    amount = f"if(precip < 0 or {flagged}, null, precip)"
    values = ["temp", "rh", "wind_dir_10s_deg", "wind_speed", "wind_u", "wind_v"]
    by = list(dict.fromkeys([*keys, station]))
    return (
        with_vectors(df)
        .groupBy(*by, F.date_trunc("hour", "date_time_lst").cast("timestamp_ntz").alias("date_time_lst"))
        .agg(
            *[F.avg(c).alias(c) for c in values],
            F.expr(f"avg({amount})").alias("precip"),
            F.count(F.lit(1)).alias("landed_rows"),
        )
    )


HOURLY_VALUES = ["temp", "rh", "precip", "wind_dir_10s_deg", "wind_speed", "wind_u", "wind_v"]


def city_hours(
    df: DataFrame,
    keys: Sequence[str] = ("city",),
    ranks: DataFrame | None = None,
    fallback: bool = True,
    station: str = "station_id",
) -> DataFrame:
    """One row per city and hour: each field from the best-ranked station that has it, never a mixture.

    ``ranks`` (station, rank; 1 is the primary) is the configured register unless given. Stations
    without a rank come after all others, the smallest id first, and are counted in ``unranked``. Rows
    are first brought to one per station and hour, so a city's hour meets a handful of rows. Without
    ``fallback`` only primaries count. Columns beside the fields: landed_rows, stations (that
    reported), and fallback_stations, the stations other than the primary that a field was taken from.
    """
    if ranks is None:
        ranks = literal_rows(df.sparkSession, [station, "rank"], WEATHER_RANKS)
    places = ranks.select(F.col(station).cast(df.schema[station].dataType).alias(station), "rank")
    rows = station_hours(df, keys, station).join(places, station, "left")
    if not fallback:
        rows = rows.where("rank = 1")
    place = F.format_string("%09d %20s", F.coalesce("rank", F.lit(999_999_999)), F.col(station).cast("string"))
    source = F.when(F.coalesce(F.col("rank") > 1, F.lit(True)), F.col(station))

    def best(c: str):
        return F.min_by(F.struct(F.col(c).alias("v"), source.alias("s")), F.when(F.col(c).isNotNull(), place)).alias(c)

    picked = rows.groupBy(*keys, "date_time_lst").agg(
        *[best(c) for c in HOURLY_VALUES],
        F.sum("landed_rows").alias("landed_rows"),
        F.count(F.lit(1)).alias("stations"),
        F.count_if(F.col("rank").isNull()).alias("unranked"),
    )
    used = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.col(f"{c}.s") for c in HOURLY_VALUES]))))
    return picked.select(
        *keys, "date_time_lst", *[F.col(f"{c}.v").alias(c) for c in HOURLY_VALUES], "landed_rows", "stations", "unranked",
        used.alias("fallback_stations"),
    )


def daily_weather(
    df: DataFrame,
    keys: Sequence[str] = ("city",),
    day: str = "cast(date_time_lst as date)",
    min_hours: int = MIN_VALID_HOURS,
    ranks: DataFrame | None = None,
    fallback: bool = True,
    station: str = "station_id",
) -> DataFrame:
    """Hourly rows to daily features; the day is local standard time unless given.

    Rows are first brought to one per station and hour (``station_hours``), so repeated hours add
    nothing; ``repeated_rows`` counts them. Unless the station is among the keys, a city's hours are
    then those of its best-ranked stations (``city_hours``): several stations are never added up or
    averaged, and ``fallback_stations`` names those other than the primary that the day rests on, by
    ``fallback_hours`` of its hours; ``unranked_rows`` counts hours of stations without a rank. A sum over
    nothing stays null. A day counts as available with at least ``min_hours`` distinct hours of
    temperature; the hours are counted as bits, so no distinct aggregate is needed.
    """
    chosen = station not in keys
    hours = city_hours(df, keys, ranks, fallback, station) if chosen else station_hours(df, keys, station).withColumn("stations", F.lit(1))
    aggregates = [f"{f}({c}) as {c}_{n}" for c in ("temp", "rh") for n, f in STATISTICS.items()]
    aggregates += [
        "sum(precip) as precip_total",
        "avg(wind_speed) as wind_speed_mean",
        "max(wind_speed) as wind_speed_max",
        "avg(wind_u) as wind_u_mean",
        "avg(wind_v) as wind_v_mean",
        f"{wind.vector_direction('avg(wind_u)', 'avg(wind_v)')} as wind_dir_mean_deg",
        "count(1) as hourly_rows",
        "sum(landed_rows - stations) as repeated_rows",
        f"coalesce({HOURS_SEEN.format(when='temp is not null')}, 0) as valid_hours",
        *[f"avg(double({c} is null)) * 100 as {c}_missing_pct" for c in FIELDS],
        f"coalesce({HOURS_SEEN.format(when='temp is not null')}, 0) >= {min_hours} as weather_data_available",
    ]
    if chosen:
        aggregates += [
            "array_join(array_sort(array_distinct(flatten(collect_set(fallback_stations)))), ',') as fallback_stations",
            "count_if(size(fallback_stations) > 0) as fallback_hours",
            "sum(unranked) as unranked_rows",
        ]
    on_day = hours.withColumn("date", F.expr(day))
    return on_day.groupBy(*keys, "date").agg(*[F.expr(a) for a in aggregates])


def rows_per_month(df: DataFrame, city: str = "city") -> DataFrame:
    ts = F.col("date_time_lst")
    return df.groupBy(city, F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        n_rows().alias("row_count")
    )


def expected_hours(df: DataFrame, station: str = "station_id") -> DataFrame:
    """Distinct hours per station and month against days times 24."""
    per_day = (
        df.groupBy(station, F.col("date_time_lst").cast("date").alias("d"))
        .agg(F.expr(HOURS_SEEN.format(when="true")).alias("hours"))
        .withColumn("month_start", F.trunc("d", "month"))
    )
    return (
        per_day.groupBy(station, "month_start")
        .agg(F.sum("hours").alias("observed_hours"))
        .withColumn("expected_hours", F.dayofmonth(F.last_day("month_start")) * 24)
        .withColumn("missing_hours", F.col("expected_hours") - F.col("observed_hours"))
    )


def missing_percent(df: DataFrame, keys: Sequence[str], fields: Sequence[str] = FIELDS) -> DataFrame:
    """Missing share per field, city and year; one aggregate, then turned to long form."""
    wide = df.groupBy(*keys).agg(
        *[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in fields]
    )
    return wide.unpivot(list(keys), list(fields), "field_name", "missing_pct")


def _station_hours(df: DataFrame, station: str) -> DataFrame:
    return df.groupBy(station, hour_index(F.col("date_time_lst")).alias("hour_no")).agg(
        n_rows().alias("record_count"), F.min("date_time_lst").alias("date_time_lst")
    )


def duplicate_timestamps(df: DataFrame, station: str = "station_id") -> DataFrame:
    return df.groupBy(station, "date_time_lst").agg(n_rows().alias("record_count")).where(
        F.col("record_count") > 1
    )


def hour_gaps(df: DataFrame, station: str = "station_id", threshold: int = 1) -> DataFrame:
    """Pauses longer than ``threshold`` hours; the window sees one row per station and hour."""
    before = W.partitionBy(station).orderBy("hour_no")
    return (
        _station_hours(df, station)
        .withColumns(
            {
                "gap_hours": F.col("hour_no") - F.lag("hour_no").over(before),
                "gap_start": F.lag("date_time_lst").over(before),
            }
        )
        .where(F.col("gap_hours") > threshold)
        .select(station, "gap_start", F.col("date_time_lst").alias("gap_end"), "gap_hours")
    )


def station_coverage(df: DataFrame, station: str = "station_id") -> DataFrame:
    """First and last hour, rows and distinct days per station."""
    per_day = df.groupBy(station, F.col("date_time_lst").cast("date").alias("d")).agg(
        F.min("date_time_lst").alias("lo"), F.max("date_time_lst").alias("hi"), n_rows().alias("n")
    )
    return per_day.groupBy(station).agg(
        F.min("lo").alias("first_hour"),
        F.max("hi").alias("last_hour"),
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("days_with_rows"),
    )


def clock_change_days(df: DataFrame, station: str = "station_id", zone: str = CIVIL_ZONE) -> DataFrame:
    """Hours seen on the days the civil clock changes. Local standard time has 24 hours on these
    days too, so any other number means the stamps are not what they claim to be."""
    per_day = df.groupBy(station, F.col("date_time_lst").cast("date").alias("date")).agg(
        F.expr(HOURS_SEEN.format(when="true")).alias("hours")
    )

    def midnight_utc(day: str) -> Column:
        local = F.expr(f"cast({day} as timestamp_ntz)")
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)

    length = hour_index(midnight_utc("date_add(date, 1)")) - hour_index(midnight_utc("date"))
    return (
        per_day.withColumn("civil_day_hours", length.cast("int"))
        .where("civil_day_hours <> 24")
        .withColumn("is_standard_time", F.col("hours") == 24)
    )


def hour_runs(df: DataFrame, station: str = "station_id") -> DataFrame:
    """Unbroken stretches of hours per station."""
    order = W.partitionBy(station).orderBy("hour_no")
    return (
        _station_hours(df, station)
        .withColumn("run", F.col("hour_no") - F.row_number().over(order))
        .groupBy(station, "run")
        .agg(
            F.min("date_time_lst").alias("run_start"),
            F.max("date_time_lst").alias("run_end"),
            n_rows().alias("run_hours"),
        )
        .drop("run")
    )


def fallback_reading(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    priority: str = "priority",
    station: str = "station_id",
    tie: str = "row_id",
    enabled: bool = False,
) -> DataFrame:
    """Each field from the best-ranked station that has it, and which station that was.

    Unless ``enabled``, only rank-1 stations count.
    """
    rows = df if enabled else df.where(F.col(priority) == 1)

    def best(field: str) -> Column:
        pick = F.struct(
            F.col(priority).alias("p"), F.col(tie).alias("t"), F.col(field).alias("v"), F.col(station).alias("s")
        )
        return F.min(F.when(F.col(field).isNotNull(), pick))

    picked = rows.groupBy(*keys).agg(*[best(f).alias(f) for f in fields])
    out = []
    for f in fields:
        out += [F.col(f"{f}.v").alias(f), F.col(f"{f}.s").alias(f"{f}_station")]
    return picked.select(*keys, *out)


def primary_station(
    candidates: DataFrame, window_start: str, window_end: str, required: Sequence[str]
) -> DataFrame:
    """Best candidate per city: hourly, covering the window, with every required field, the
    preferred operator first, then the nearest, then the smallest id. A min over a struct, so a
    city with very many candidates needs no window."""
    fit = candidates.where(
        (F.col("interval") == "hourly")
        & (F.col("first_date") <= F.lit(window_start).cast("date"))
        & (F.col("last_date") >= F.lit(window_end).cast("date"))
    )
    for c in required:
        fit = fit.where(F.col(c))
    ranked = F.struct(
        F.when(F.col("operator") == "ECCC-MSC", 0).otherwise(1).alias("operator_rank"),
        F.col("distance_km"),
        F.col("station_id"),
        F.col("operator"),
    )
    best = fit.groupBy("city").agg(F.min(ranked).alias("b"), n_rows().alias("fit_candidates"))
    return best.select(
        "city",
        F.col("b.station_id").alias("station_id"),
        F.col("b.operator").alias("operator"),
        F.col("b.distance_km").alias("distance_km"),
        "fit_candidates",
    )
