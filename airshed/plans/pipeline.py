"""Landed sources to staging tables, staging to dimensions, facts and reports.

Each step reads what the step before wrote to the shared store, so a lost executor or a failed run
costs one step. Staging keeps the source grain; business rules start after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.operators import aqhi, cover, evacuation, exposure, fires, rules, weather
from airshed.plans import city_daily, dimensions, staging
from airshed.plans.staging import STAGING
from airshed.sources import landed
from airshed.sources.files import read_csv, read_measures, read_table, write_table
from airshed.streaming.polls import stamp_rows

@dataclass(frozen=True)
class Store:
    """Folders of one warehouse."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, name))


def _rows() -> dict[str, Column]:
    """Measured in every write of a whole table."""
    return {"row_count": F.count(F.lit(1))}


# How each landed table becomes the table that is staged.
LANDED = {
    "cwfis_hotspots": landed.hotspots,
    "aqhi_geomet_current": landed.current,
    "aqhi_aqo_historical": landed.history,
    "ontario_active_fires": landed.fires,
    "eccc_hourly_weather": landed.weather,
    "evacuation_log": landed.evacuations,
}


def load_staging(
    store: Store,
    sources: dict[str, DataFrame],
    load: int,
    spans: dict[str, DataFrame] | None = None,
    replace: bool = False,
) -> None:
    """Each source at its own grain, by load and month; an empty source still makes a table.

    Loads are numbered by the caller; a number that is taken is refused, unless the same load is run
    again (``replace``). What a load replaces of earlier ones is in ``staging``; ``spans`` declares it
    per source where the rows alone do not show it.
    """
    for name, df in sources.items():
        staging.stage(df, store.path("staging", name), STAGING[name], load, (spans or {}).get(name), replace)


def load_landed(store: Store, files: dict[str, str], load: int, taken_at: str, page_url: str, replace: bool = False) -> None:
    """Landed CSV files (a path or a folder per source) to staging. Headers of weather files are normalised;
    the fire snapshot is stamped with the moment and the address it was taken from."""
    tables = {}
    for name, path in files.items():
        df = LANDED[name](read_csv(store.spark, path, normalise=name == "eccc_hourly_weather"))
        tables[name] = stamp_rows(df, taken_at, page_url) if name == "ontario_active_fires" else df
    load_staging(store, tables, load, replace=replace)


def staged(store: Store, name: str) -> DataFrame:
    """The rows of a staging table that count, of all loads."""
    return staging.staged(store.spark, store.path("staging", name), STAGING[name]).drop("load")


def load_dimensions(store: Store, first_day: str, last_day: str) -> None:
    spark = store.spark
    bounds = spark.range(1).select(
        F.lit(first_day).cast("date").alias("a"), F.lit(last_day).cast("date").alias("b")
    )
    write_table(dimensions.dim_city(spark), store.path("analytics", "dim_city"), measures=_rows())
    write_table(dimensions.station_register(spark), store.path("analytics", "dim_station"), measures=_rows())
    write_table(
        dimensions.dim_date(dimensions.calendar(bounds, "a", "b")),
        store.path("analytics", "dim_date"),
        measures=_rows(),
    )


def load_facts(
    store: Store,
    fire_days: DataFrame,
    aqhi_rule: str = "mean",
    boundary: DataFrame | None = None,
    station_ranks: DataFrame | None = None,
) -> None:
    """The city-day fact by month, the evacuation events, and the fire snapshots beside it.

    With a ``boundary`` (vertices, see ``cover``) only hotspots inside it count, and their totals per day
    are written beside the fact. ``station_ranks`` orders the weather stations of a city.
    """
    days = store.read("analytics", "dim_date").select("date_id")
    hotspots = staged(store, "cwfis_hotspots").withColumn(
        "date", F.col("rep_date").cast("date")
    )
    if boundary is not None:
        hotspots = cover.inside_polygon(hotspots, boundary)
        write_table(exposure.province_daily_totals(hotspots), store.path("analytics", "province_daily_totals"))
    fact = city_daily.assemble(
        dimensions.city_day_grid(days),
        aqhi.city_daily(
            aqhi.station_daily(staged(store, "aqhi_aqo_historical")), aqhi_rule
        ),
        exposure.city_exposure(hotspots),
        weather.daily_weather(staged(store, "eccc_hourly_weather"), ranks=station_ranks),
        fire_days,
    )
    write_table(
        fact.withColumn("month", F.date_format("date_id", "yyyy-MM")),
        store.path("analytics", "fact_city_daily"),
        ["month"],
        measures={**_rows(), **rules.breaks(rules.fact_row_rules(fact.columns))},
    )
    write_table(
        evacuation.evacuation_facts(
            staged(store, "evacuation_log"), store.read("analytics", "dim_city")
        ),
        store.path("analytics", "fact_evacuation_events"),
        measures=_rows(),
    )
    write_table(
        fires.clean_fires(staged(store, "ontario_active_fires").drop("month")),
        store.path("analytics", "ref_active_fires_snapshot"),
        ["snapshot_downloaded_at_utc"],
        measures=_rows(),
    )


def check_facts(store: Store) -> DataFrame:
    """Broken rules of the loaded fact; written to the quality layer even when there are none. Row rules
    that held for every row when the fact was written take no scan."""
    report = rules.fact_rules(
        store.read("analytics", "fact_city_daily"),
        store.read("analytics", "dim_city"),
        store.read("analytics", "dim_date"),
        read_measures(store.spark, store.path("analytics", "fact_city_daily")),
    )
    write_table(report, store.path("quality", "fact_rules"))
    return store.read("quality", "fact_rules")


def row_counts(store: Store) -> DataFrame:
    """Rows per loaded table, staging to fact. Tables that are written whole say what their write counted;
    of staging tables the rows that count are counted now."""
    written = [
        "dim_city", "dim_date", "dim_station", "fact_city_daily", "fact_evacuation_events", "ref_active_fires_snapshot",
    ]
    known = [("analytics", n, read_measures(store.spark, store.path("analytics", n))["row_count"]) for n in written]
    parts = [store.spark.createDataFrame(known, "layer string, table_name string, row_count bigint")]
    for name in STAGING:
        counted = staged(store, name).agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(counted.select(F.lit("staging").alias("layer"), F.lit(name).alias("table_name"), "row_count"))
    return rules.union_all(parts)
