"""Historical air-quality readings: censored values, defects, city series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airshed.config import CIVIL_ZONE, GEOMET_LOCATIONS
from airshed.functions.moments import civil_date, civil_hour, parse_date
from airshed.functions.text import NULL_MARK, SEPARATOR, number_sql
from airshed.operators.grouping import HOT_ROWS, attach_facts, keep_one, literal_rows
from airshed.operators.quality import group_sizes, year_mismatches

STATION_YEAR = ["station_id", "station_name", "requested_year"]
BOUNDARY_ISSUE = "possible_date_boundary_anomaly"
YEAR_ISSUE = "date_outside_requested_year"
LINE_RECORDS = 100_000


def censored(df: DataFrame, source: str = "aqhi") -> DataFrame:
    """Text as delivered, a flag for "10+", and the number or its lower bound.

    The flag of a missing reading is null: nothing says whether it was above ten.
    """
    raw = f"trim(cast({source} as string))"
    return df.selectExpr(
        "*",
        f"{raw} as aqhi_raw",
        f"{raw} = '10+' as aqhi_is_10_plus",
        f"{number_sql(f"replace({raw}, '+', '')")} as aqhi_numeric",
    )


def clean_history(raw: DataFrame) -> DataFrame:
    return censored(raw.withColumn("date", parse_date(F.col("date"))))


def station_mode(
    df: DataFrame, station_id: int, station_name: str, value_type: str, years: Sequence[int]
) -> DataFrame:
    return df.where(
        (F.col("station_id") == station_id)
        & (F.col("station_name") == station_name)
        & (F.col("value_type") == value_type)
        & F.col("requested_year").isin(list(years))
    )


def allowed_locations(current: DataFrame, locations: Sequence[tuple] = GEOMET_LOCATIONS, location: str = "location_id") -> DataFrame:
    """Rows of the current feed from the locations on the list, with the project city of each.

    The list is VALUES of known size; rows of other locations, or without one, go.
    """
    return current.join(literal_rows(current.sparkSession, [location, "city"], list(locations)), location)


def missing_and_capped(df: DataFrame) -> DataFrame:
    """Rows without a reading, and rows reported as "10+"."""
    return df.withColumn(
        "reason", F.when(F.col("aqhi_raw").isNull(), "missing").when(F.col("aqhi_is_10_plus"), "10+")
    ).where(F.col("reason").isNotNull())


def _boundary_dates(df: DataFrame) -> DataFrame:
    """Daily-max dates that occur twice or more while the day before is absent.

    The window runs over one row per station and date, so its partitions are as long as the
    calendar, however many records a date has.
    """
    maxima = df.where(
        (F.col("value_type") == "daily_max") & F.col("date").isNotNull()
    ).dropna(subset=STATION_YEAR)
    per_date = group_sizes(maxima, [*STATION_YEAR, "date"], "records_on_duplicated_date")
    day_before = F.date_sub("date", 1)
    seen = F.lag("date").over(W.partitionBy(*STATION_YEAR).orderBy("date"))
    return (
        per_date.withColumn("__seen", seen)
        .where(
            (F.col("records_on_duplicated_date") > 1)
            & (F.col("__seen").isNull() | (F.col("__seen") < day_before))
            & (F.year(day_before) == F.col("requested_year"))
        )
        .drop("__seen")
    )


def daily_max_date_anomalies(df: DataFrame, row_id: str = "row_id", line_records: int = LINE_RECORDS) -> DataFrame:
    """Date-boundary report: a line per suspicious date, with the time and value of each of its records
    in row order.

    A date with more than about ``line_records`` records goes on in further lines (``line_no``), so no
    task holds more than twice as many; row ids are unique. Nothing is left out.
    """
    keys = [*STATION_YEAR, "date"]
    maxima = df.where(F.col("value_type") == "daily_max").select(*keys, row_id, "time", "aqhi_raw")
    found = attach_facts(maxima, _boundary_dates(df), keys, "records_on_duplicated_date", row_id)
    found = found.withColumn("__piece", F.floor(F.col(row_id) / F.lit(line_records)))
    pieces = found.groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(*keys).orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    line = (F.floor(before / F.lit(line_records)) + 1).cast("int")
    ordered = F.array_sort(
        F.collect_list(
            F.struct(
                F.col(row_id).alias("k"),
                F.coalesce(F.col("time"), F.lit(NULL_MARK)).alias("t"),
                F.coalesce(F.col("aqhi_raw"), F.lit(NULL_MARK)).alias("v"),
            )
        )
    )
    return (
        found.join(pieces.select(*keys, "__piece", line.alias("line_no")), [*keys, "__piece"])
        .groupBy(*keys, "records_on_duplicated_date", "line_no")
        .agg(ordered.alias("r"))
        .select(
            *STATION_YEAR,
            F.date_sub("date", 1).alias("missing_previous_date"),
            F.col("date").alias("duplicated_reported_date"),
            "records_on_duplicated_date",
            "line_no",
            F.array_join(F.col("r.t"), SEPARATOR).alias("reported_times"),
            F.array_join(F.col("r.v"), SEPARATOR).alias("reported_aqhi_values"),
            F.lit(BOUNDARY_ISSUE).alias("issue_type"),
        )
    )


def date_anomaly_flags(df: DataFrame, row_id: str = "row_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every suspicious daily-max row with the kind of problem; dates are flagged, never shifted."""
    keys = [*STATION_YEAR, "date"]
    maxima = df.where(F.col("value_type") == "daily_max")
    out = [row_id, *STATION_YEAR, "date", "issue_type"]
    boundary = attach_facts(
        maxima, _boundary_dates(df), keys, "records_on_duplicated_date", row_id, hot_rows=hot_rows
    ).withColumn("issue_type", F.lit(BOUNDARY_ISSUE))
    outside = year_mismatches(maxima).withColumn("issue_type", F.lit(YEAR_ISSUE))
    return boundary.select(*out).unionByName(outside.select(*out))


def dedup_exact(df: DataFrame, fields: Sequence[str], row_id: str = "row_id") -> DataFrame:
    """One row per exact copy group, with the number of copies removed."""
    one = keep_one(df, list(fields), row_id)
    return one.withColumn("removed_copies", F.col("copies") - 1).drop("copies")


def conflict_facts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per date and time: size, whether readings disagree, and the category if all agree."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("record_count"),
        (F.min("aqhi_raw") < F.max("aqhi_raw")).alias("__differs"),
        F.when(F.min("category") == F.max("category"), F.min("category")).alias("agreed_category"),
    )


def conflict_quarantine(
    df: DataFrame,
    keys: Sequence[str] = ("station_id", "value_type", "date", "time"),
    row_id: str = "row_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All rows kept; conflicting ones flagged, out of the numeric series, category only if agreed."""
    facts = conflict_facts(df, keys)
    joined = attach_facts(df, facts, list(keys), "record_count", row_id, hot_rows=hot_rows)
    flag = F.coalesce(F.col("__differs"), F.lit(False))
    return joined.withColumns(
        {
            "source_value_conflict": flag,
            "series_value": F.when(~flag, F.col("aqhi_numeric")),
            "series_category": F.when(flag, F.col("agreed_category")).otherwise(F.col("category")),
        }
    ).drop("__differs", "agreed_category", "record_count")


def station_daily(df: DataFrame) -> DataFrame:
    """One usable reading per station, date and mode.

    A date and time whose records disagree gives no number. Where a date has several times left,
    daily_max takes their greatest value and daily_4pm needs them to agree.
    """
    per_time = (
        df.where("date is not null")
        .groupBy("city", "station_id", "value_type", "date", "time")
        .agg(
            F.expr("min(aqhi_raw) < max(aqhi_raw) as differs"),
            F.expr("max(aqhi_numeric) as v"),
            F.expr("max(aqhi_is_10_plus) as plus"),
        )
    )
    per_date = per_time.groupBy("city", "station_id", "value_type", "date").agg(
        F.expr("max(if(differs, null, v)) as hi"),
        F.expr("min(if(differs, null, v)) as lo"),
        F.expr("max(if(differs, null, plus)) as plus"),
        F.expr("count_if(differs) as conflicting_times"),
    )
    usable = "if(value_type = 'daily_max' or lo = hi, hi, null)"
    return per_date.selectExpr(
        "city",
        "station_id",
        "value_type",
        "date",
        f"{usable} as value",
        f"if({usable} is not null, coalesce(plus, false), null) as is_10_plus",
        "conflicting_times",
    )


def city_daily(stations: DataFrame, rule: str = "mean") -> DataFrame:
    """Stations of a city to one value per date and mode; the rule is a parameter, mean or max."""
    combine = {"mean": F.avg, "max": F.max}[rule]
    return stations.groupBy("city", "value_type", "date").agg(
        combine("value").alias("aqhi"),
        F.max("is_10_plus").alias("any_10_plus"),
        F.count("value").alias("station_count"),
    )


def station_spread(stations: DataFrame) -> DataFrame:
    """How far the stations of a city lie apart on a day, summarised per city and mode."""
    days = (
        stations.groupBy("city", "value_type", "date")
        .agg(
            F.count("value").alias("n"),
            (F.max("value") - F.min("value")).alias("spread"),
            F.stddev_samp("value").alias("sd"),
        )
        .where(F.col("n") > 1)
    )
    return days.groupBy("city", "value_type").agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("spread").alias("mean_spread"),
        F.max("spread").alias("max_spread"),
        F.avg("sd").alias("mean_sd"),
    )


def mode_comparison(stations: DataFrame) -> DataFrame:
    """Paired 4 PM and daily-max readings per station."""
    paired = (
        stations.groupBy("city", "station_id", "date")
        .agg(
            F.max(F.when(F.col("value_type") == "daily_4pm", F.col("value"))).alias("at_4pm"),
            F.max(F.when(F.col("value_type") == "daily_max", F.col("value"))).alias("daily_max"),
        )
        .dropna(subset=["at_4pm", "daily_max"])
    )
    return paired.groupBy("city", "station_id").agg(
        F.count(F.lit(1)).alias("paired_days"),
        F.avg(F.col("daily_max") - F.col("at_4pm")).alias("mean_difference"),
        F.avg((F.col("daily_max") == F.col("at_4pm")).cast("double")).alias("share_equal"),
        F.corr("at_4pm", "daily_max").alias("correlation"),
    )


def completeness(df: DataFrame) -> DataFrame:
    """Dates with a reading against the days of the requested year, per station and mode."""
    dated = df.where(
        F.col("aqhi_raw").isNotNull() & (F.year("date") == F.col("requested_year"))
    )
    year_start = F.make_date(F.col("requested_year"), F.lit(1), F.lit(1))
    return (
        dated.groupBy("station_id", "requested_year", "value_type")
        .agg(F.count_distinct("date").alias("days_with_value"))
        .withColumn("expected_days", F.datediff(F.add_months(year_start, 12), year_start))
        .withColumn("completeness", F.col("days_with_value") / F.col("expected_days"))
    )


def value_distribution(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Exact quartiles of a column on a fixed scale.

    Counts per distinct value come first; a reading on a ten-point scale leaves only a handful of
    rows per key for the percentile to look at.
    """
    counted = (
        df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    )

    def at(p: float):
        return F.percentile(column, p, F.col("n"))

    return counted.groupBy(*keys).agg(
        F.sum("n").alias("values"),
        F.min(column).alias("lowest"),
        at(0.25).alias("lower_quartile"),
        at(0.5).alias("median"),
        at(0.75).alias("upper_quartile"),
        F.max(column).alias("highest"),
    )


def daily_from_hourly(
    hourly: DataFrame, keys: Sequence[str], instant: str, value: str, zone: str = CIVIL_ZONE
) -> DataFrame:
    """Daily maximum and the 4 PM value rebuilt from hourly readings, by civil day.

    A 4 PM hour with several different readings gives no 4 PM value.
    """
    local = hourly.withColumns(
        {"date": civil_date(F.col(instant), zone), "__h": civil_hour(F.col(instant), zone)}
    )
    at_4pm = F.when(F.col("__h") == 16, F.col(value))
    return local.groupBy(*keys, "date").agg(
        F.max(value).alias("aqhi_daily_max"),
        F.when(F.min(at_4pm) == F.max(at_4pm), F.max(at_4pm)).alias("aqhi_daily_4pm"),
        F.count(value).alias("valid_readings"),
    )


def capped_like_history(df: DataFrame, column: str = "aqhi") -> DataFrame:
    """The current feed gives 11 where the history says "10+"; bring both to the same form."""
    return df.withColumns(
        {
            "aqhi_is_10_plus": F.col(column) > 10,
            "aqhi_numeric": F.when(F.col(column) > 10, 10.0).otherwise(F.col(column)),
        }
    )
