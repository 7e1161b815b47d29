"""Quality rules as tables: (rule_id, severity, entity_key, detail). Nothing is ever deleted.

Row rules of a table are all judged in one scan. Rules about groups report the group, with its
size, so an entity that breaks uniqueness a billion times is one line.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.config import (
    CITY_NAMES,
    EVENT_STATUSES,
    LOG_START,
    PUBLISHER_HOSTS,
    SOURCE_SYSTEMS,
    WEATHER_LIMITS,
)
from airshed.functions.text import url_host


@dataclass(frozen=True)
class RowRule:
    rule_id: str
    broken: Column
    detail: Column
    severity: str = "error"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("<NULL>"))


def check_rows(df: DataFrame, entity: Column, rules: Sequence[RowRule]) -> DataFrame:
    hits = F.array(
        *[
            F.when(
                F.coalesce(r.broken, F.lit(False)),
                F.struct(
                    F.lit(r.rule_id).alias("rule_id"),
                    F.lit(r.severity).alias("severity"),
                    text(entity).alias("entity_key"),
                    text(r.detail).alias("detail"),
                ),
            )
            for r in rules
        ]
    )
    return df.select(F.inline(F.array_compact(hits)))


def check_unique(
    df: DataFrame, rule_id: str, keys: Sequence[str], severity: str = "error"
) -> DataFrame:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return sizes.select(
        F.lit(rule_id).alias("rule_id"),
        F.lit(severity).alias("severity"),
        F.concat_ws("/", *[text(F.col(k)) for k in keys]).alias("entity_key"),
        F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("detail"),
    )


def check_parent(
    df: DataFrame, rule_id: str, fk: str, parent: DataFrame, pk: str, severity: str = "error"
) -> DataFrame:
    used = df.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    lost = used.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
    return lost.select(
        F.lit(rule_id).alias("rule_id"),
        F.lit(severity).alias("severity"),
        text(F.col(fk)).alias("entity_key"),
        F.concat(F.col("n").cast("string"), F.lit(" rows without parent")).alias("detail"),
    )


def check_consistent(
    df: DataFrame, rule_id: str, key: Column, value: Column, severity: str = "warning"
) -> DataFrame:
    """Keys that carry more than one value, e.g. two spellings of a community."""
    seen = df.select(key.alias("k"), value.alias("v")).groupBy("k").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    return seen.where(F.col("lo") < F.col("hi")).select(
        F.lit(rule_id).alias("rule_id"),
        F.lit(severity).alias("severity"),
        text(F.col("k")).alias("entity_key"),
        F.concat(F.col("lo").cast("string"), F.lit(" <> "), F.col("hi").cast("string")).alias(
            "detail"
        ),
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def outside(c: str, low: float, high: float) -> Column:
    return (F.col(c) < low) | (F.col(c) > high)


def coordinate_rules(rule_id: str = "Q3", lat: str = "latitude", lon: str = "longitude") -> list[RowRule]:
    return [
        RowRule(f"{rule_id}_latitude", outside(lat, -90, 90), F.col(lat)),
        RowRule(f"{rule_id}_longitude", outside(lon, -180, 180), F.col(lon)),
    ]


def missing_rules(rule_id: str, columns: Sequence[str]) -> list[RowRule]:
    return [RowRule(f"{rule_id}_{c}", F.col(c).isNull(), F.lit(c)) for c in columns]


def length_rules(limits: dict[str, int]) -> list[RowRule]:
    return [
        RowRule(f"Q2_length_{c}", F.length(c) > n, F.length(c)) for c, n in limits.items()
    ]


def city_rules(cities: DataFrame) -> DataFrame:
    """Q1 to Q3 over the cities."""
    rows = check_rows(
        cities, F.col("city_id"), [*missing_rules("Q2_city", ["city_id", "city_name", "latitude", "longitude"]), *coordinate_rules("Q3_city")]
    )
    return union_all(
        [rows, check_unique(cities, "Q1_city_id", ["city_id"]), check_unique(cities, "Q1_city_name", ["city_name"])]
    )


def date_rules(days: DataFrame) -> DataFrame:
    """Q1 and Q2 over the calendar."""
    rows = check_rows(days, F.col("date_id"), missing_rules("Q2_date", ["date_id"]))
    return union_all([rows, check_unique(days, "Q1_date_id", ["date_id"])])


def dimension_rules(stations: DataFrame, cities: DataFrame) -> DataFrame:
    """Q1 to Q5 over the station register; its cities have ``city_rules``."""
    rows = check_rows(
        stations,
        F.col("station_id"),
        [
            *missing_rules(
                "Q2", ["source_station_id", "station_name", "source_system", "city_id"]
            ),
            *missing_rules("Q2", ["latitude", "longitude"]),
            *length_rules({"source_station_id": 50, "station_name": 150, "source_system": 30}),
            *coordinate_rules(),
            RowRule(
                "Q4_source_system",
                ~F.col("source_system").isin(SOURCE_SYSTEMS),
                F.col("source_system"),
            ),
        ],
    )
    return union_all(
        [
            rows,
            check_unique(stations, "Q1_station_id", ["station_id"]),
            check_unique(stations, "Q1_source_station", ["source_system", "source_station_id"]),
            check_parent(stations, "Q5_city", "city_id", cities, "city_id"),
        ]
    )


def weather_rules(hourly: DataFrame, entity: Column) -> DataFrame:
    """Q6 and Q7: value ranges per row, station identity and stamps per group."""
    ranges = [
        RowRule(f"Q6_{c}", outside(c, *limits), F.col(c)) for c, limits in WEATHER_LIMITS.items()
    ]
    rows = check_rows(
        hourly,
        entity,
        [*ranges, RowRule("Q6_precip_negative", F.col("precip") < 0, F.col("precip"))],
    )
    return union_all(
        [
            rows,
            check_consistent(
                hourly, "Q7_station_identity", F.col("station_id"), F.col("station_name")
            ),
        ]
    )


def evacuation_rules(log: DataFrame, cutoff: str, start: str = LOG_START) -> DataFrame:
    """Q8 to Q15 over the raw text log; ``start_date``/``end_date`` are the parsed dates."""
    e = F.col
    rows = check_rows(
        log,
        e("event_id"),
        [
            RowRule("Q8_id_format", ~F.coalesce(e("event_id"), F.lit("")).rlike(r"^EVAC-\d{3,}$"), e("event_id")),
            RowRule("Q9_start_date", e("start_date").isNull(), e("evacuation_start_date")),
            RowRule(
                "Q9_end_date",
                e("evacuation_end_date").isNotNull() & e("end_date").isNull(),
                e("evacuation_end_date"),
            ),
            RowRule("Q10_status", ~F.coalesce(e("status"), F.lit("")).isin(EVENT_STATUSES), e("status")),
            RowRule(
                "Q11_city",
                ~F.coalesce(e("nearby_project_city"), F.lit("")).isin(
                    [*CITY_NAMES, "Not applicable"]
                ),
                e("nearby_project_city"),
            ),
            RowRule("Q12_url_missing", e("source_url").isNull(), e("source_name")),
            RowRule(
                "Q12_url_host",
                e("source_url").isNotNull()
                & ~F.coalesce(url_host(e("source_url")), F.lit("")).isin(PUBLISHER_HOSTS),
                e("source_url"),
            ),
            RowRule("Q14_end_before_start", e("end_date") < e("start_date"), e("end_date")),
            RowRule(
                "Q14_lifted_without_end",
                (e("status") == "Lifted") & e("evacuation_end_date").isNull(),
                e("status"),
            ),
            RowRule(
                "Q14_ongoing_with_end",
                (e("status") == "Ongoing") & e("evacuation_end_date").isNotNull(),
                e("end_date"),
            ),
            RowRule(
                "Q15_outside_window",
                (e("start_date") < F.lit(start).cast("date"))
                | (e("start_date") > F.lit(cutoff).cast("date")),
                e("start_date"),
            ),
        ],
    )
    return union_all(
        [
            rows,
            check_unique(log, "Q8_id_unique", ["event_id"]),
            check_unique(log, "Q13_community_start", ["community", "evacuation_start_date"]),
            check_consistent(
                log, "Q15_spelling", F.lower(F.trim(e("community"))), e("community")
            ),
        ]
    )


def fact_row_rules(columns: Sequence[str]) -> list[RowRule]:
    """Q17 over single rows of fact_city_daily: flags and values agree."""
    counts = [c for c in columns if c.startswith("hotspots_within_")]
    no_fire, no_air, no_wx = (
        ~F.col(f)
        for f in ("fire_data_available", "aqhi_data_available", "weather_data_available")
    )
    counted = [*counts, "nearest_hotspot_distance_km"]
    air = F.coalesce("aqhi_daily_4pm", "aqhi_daily_max")
    measured = [c for c in columns if c.startswith(("temp_", "precip_", "wind_"))]
    return [
        *[RowRule(f"Q17_{c}_without_source", no_fire & F.col(c).isNotNull(), F.col(c)) for c in counted],
        *[
            RowRule(f"Q17_{c}_unknown", F.col("fire_data_available") & F.col(c).isNull(), F.lit(c))
            for c in counts
        ],
        RowRule("Q17_aqhi_without_source", no_air & air.isNotNull(), air),
        RowRule("Q17_aqhi_unknown", F.col("aqhi_data_available") & air.isNull(), F.lit("aqhi")),
        *[
            RowRule(f"Q17_{c}_incomplete", no_wx & F.col(c).isNotNull(), F.lit(c), "warning")
            for c in measured
        ],
        RowRule(
            "Q17_weather_unknown",
            F.col("weather_data_available") & F.col("temp_mean").isNull(),
            F.lit("temp_mean"),
        ),
    ]


def fact_key() -> Column:
    return F.concat_ws("/", text(F.col("city_id")), text(F.col("date_id")))


def breaks(rules: Sequence[RowRule]) -> dict[str, Column]:
    """How many rows break each rule, as aggregates, for ``write_table`` to measure."""
    return {r.rule_id: F.count_if(F.coalesce(r.broken, F.lit(False))) for r in rules}


def fact_rules(fact: DataFrame, cities: DataFrame, days: DataFrame, measured: dict[str, int] | None = None) -> DataFrame:
    """Q16 to Q18 over fact_city_daily. Row rules that the write ``measured`` as unbroken are not looked at again."""
    doubtful = [r for r in fact_row_rules(fact.columns) if (measured or {}).get(r.rule_id) != 0]
    rows = check_rows(fact, fact_key(), doubtful) if doubtful else check_unique(fact.limit(0), "none", ["city_id"])
    # Every city has every day of the calendar; a repeated day does not stand for a missing one.
    known = fact.join(days.select("date_id"), "date_id", "left_semi").select("city_id", "date_id").distinct()
    present = known.groupBy("city_id").agg(F.count(F.lit(1)).alias("present"))
    expected = days.agg(F.count_distinct("date_id")).scalar()
    holes = (
        cities.select("city_id")
        .join(present, "city_id", "left")
        .withColumn("expected", expected)
        .where(F.col("expected") > F.coalesce("present", F.lit(0)))
        .select(
            F.lit("Q18_date_coverage").alias("rule_id"),
            F.lit("error").alias("severity"),
            text(F.col("city_id")).alias("entity_key"),
            F.concat(F.coalesce("present", F.lit(0)).cast("string"), F.lit(" of "), F.col("expected").cast("string")).alias("detail"),
        )
    )
    return union_all(
        [
            rows,
            check_unique(fact, "Q16_city_day", ["city_id", "date_id"]),
            check_parent(fact, "Q16_city", "city_id", cities, "city_id"),
            check_parent(fact, "Q16_date", "date_id", days, "date_id"),
            holes,
        ]
    )
