"""Named queries over the given tables: one per operator of the library."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.config import GEOMET_LOCATIONS, PROVINCE_SKETCH, SENTINEL_FIELDS, SOURCE_FIELDS
from airshed.functions import geo, moments, text
from airshed.operators import aqhi, asof, evacuation, exposure, fires, grouping, profiles, quality, rules, weather
from airshed.plans import city_daily, dimensions, model_prep, staging
from airshed.session import settle, shared_dir
from airshed.sources import files, geojson, html, manifest
from airshed.sources.schemas import struct
from airshed.streaming import polls
from airshed.workload import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STATION = ["station_id", "value_type", "requested_year"]
BLOCK = 20  # features or table rows per built page


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text and doubles at six decimals, the form both engines print alike."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            out.append(f"cast(`{f.name}` as string) as `{f.name}`")
        elif isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            out.append(f"round(cast(`{f.name}` as double), 6) + 0D as `{f.name}`")
        else:
            out.append(f"`{f.name}`")
    return df.selectExpr(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return plain(fn(spark, sf))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# --- sources ------------------------------------------------------------------------------------


def _feature_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Hotspots as GeoJSON page texts of at most BLOCK features; uid is unique, so is bounded."""
    point = F.when(
        F.col("uid") % 13 != 0,
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")),
    )
    feature = F.struct(
        F.concat(F.lit("hot."), F.col("uid").cast("string")).alias("id"),
        F.struct("uid", "sensor", "agency").alias("properties"),
        point.alias("geometry"),
    )
    return (
        inputs.hotspots(spark, sf)
        .groupBy(F.floor(F.col("uid") / F.lit(BLOCK)).alias("page"))
        .agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("body"))
    )


HOT_PROPERTIES = struct("uid bigint, sensor string, agency string")


@query
def geojson_flatten(spark, sf):
    pages = geojson.parse_pages(_feature_pages(spark, sf), "body", HOT_PROPERTIES)
    return geojson.flatten_features(pages.drop("page"), drop_empty=True)


def _open_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose features have properties that no schema names: one comes only from the second page on,
    and one is a number here and a text there."""
    feature = F.concat(
        F.lit('{"properties":'),
        F.regexp_replace(F.to_json(F.struct("uid", "sensor", "agency", F.when(F.col("uid") >= BLOCK, F.col("uid") % 4 / 4).alias("frp"))), "[}]$", ""),
        F.lit(',"code":'),
        F.when(F.col("uid") % 2 == 0, (F.col("uid") % 7).cast("string")).otherwise(F.concat(F.lit('"x'), F.col("uid") % 7, F.lit('"'))),
        F.lit('},"geometry":{"type":"Point","coordinates":['), "lon", F.lit(","), "lat", F.lit("]}}"),
    )
    return (
        inputs.hotspots(spark, sf)
        .groupBy(F.floor(F.col("uid") / F.lit(BLOCK)).alias("page"))
        .agg(F.concat(F.lit('{"features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("body"))
    )


@query
def geojson_open_flatten(spark, sf):
    """All properties of all pages, none declared."""
    return geojson.flatten_open(_open_pages(spark, sf), "body").drop("page", "source_feature_id")


@query
def geojson_properties(spark, sf):
    return geojson.property_report(geojson.open_features(_open_pages(spark, sf), "body"))


@query
def snapshot_lineage(spark, sf):
    pages = geojson.parse_pages(_feature_pages(spark, sf), "body", HOT_PROPERTIES)
    stamped = {
        "snapshot_downloaded_at_utc": F.lit("2026-07-31 04:59:31").cast("timestamp_ntz"),
        "source_url": F.lit("https://example.org/fires"),
    }
    return geojson.flatten_features(
        pages.drop("page"), "geometry_longitude", "geometry_latitude", lineage=stamped
    ).select(
        "uid", "source_feature_id", "geometry_type", "snapshot_downloaded_at_utc", "source_url"
    )


@query
def paged_union_dedup(spark, sf):
    """Two overlapping pages of the fire list make the list again, every fire once."""
    fires_raw = inputs.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("objectid"), F.col("o_totalprice").alias("size"), "o_orderdate"
    )
    pages = [fires_raw.where("size <= 300000"), fires_raw.where("size >= 200000")]
    return geojson.union_pages(pages, "objectid", "o_orderdate")


def _result_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Historical readings as HTML pages: a legend table, then at most BLOCK result rows."""
    raw = inputs.aqhi_raw(spark, sf)

    def cell(c: str):
        return F.concat(F.lit("<td>"), F.coalesce(F.col(c), F.lit("")), F.lit("</td>"))

    row = F.concat(F.lit("<tr>"), *[cell(c) for c in ("date", "time", "aqhi", "category")], F.lit("</tr>"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("row_id"), row.alias("tr"))))
    body = F.array_join(F.transform(ordered, lambda s: s["tr"]), "\n")
    legend = "<table class='key'><tr><th>AQHI</th><th>Meaning</th></tr><tr><td>1</td><td>low</td></tr></table>"
    head = "<table><tr><th>Date</th><th>Time</th><th><b>AQHI</b></th><th>Category</th></tr>"
    return (
        raw.groupBy(F.floor(F.col("row_id") / F.lit(BLOCK)).alias("page_no"))
        .agg(body.alias("rows"))
        .select(
            "page_no",
            F.concat(F.lit(f"<html>{legend}{head}"), F.col("rows"), F.lit("</table></html>")).alias("html"),
        )
    )


@query
def html_table_rows(spark, sf):
    rows = html.table_rows(_result_pages(spark, sf))
    return rows.select("page_no", "table_index", "row_index", "date", "time", "aqhi", "category", "row_text")


@query
def html_rows_on_dates(spark, sf):
    rows = html.table_rows(_result_pages(spark, sf))
    found = html.rows_on_dates(rows, ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"])
    return found.select("page_no", "row_index", "row_text")


@query
def html_links(spark, sf):
    return html.links(inputs.table(spark, sf, "pages").select("page_id", "html"))


@query
def payload_validity(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    # The landed payloads end in a header line for two thirds of the documents.
    payload = F.when(F.col("doc_id") % 3 != 0, F.concat(F.col("text"), F.lit("\nDate/Time"))).otherwise(F.col("text"))
    return docs.select("doc_id", files.payload_is_valid(payload).alias("is_valid"))


@query
def union_by_name_context(spark, sf):
    """Two sources with differing columns under one set of names, counted per source and column."""
    hot = inputs.hotspots(spark, sf).select("uid", "date", "sensor", "lat")
    wx = inputs.weather(spark, sf).select(
        F.col("row_id").alias("uid"), F.col("date_time_lst").cast("date").alias("date"), "temp", "city"
    )
    both = files.union_by_name(
        [(hot, {"source": F.lit("hotspots")}), (wx, {"source": F.lit("weather")})]
    )
    return both.groupBy("source", "date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("sensor").alias("with_sensor"),
        F.count("temp").alias("with_temp"),
        F.count("city").alias("with_city"),
    )


def _station_months(spark: SparkSession, sf: str) -> DataFrame:
    """Months each weather station should have: from its first month to a year after its last."""
    return (
        inputs.weather(spark, sf)
        .groupBy("city", "station_id")
        .agg(F.min("date_time_lst").alias("lo"), F.max("date_time_lst").alias("hi"))
        .select(
            "city",
            "station_id",
            F.col("lo").cast("date").alias("first_month"),
            F.add_months(F.col("hi").cast("date"), 12).alias("last_month"),
        )
    )


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    wx = inputs.weather(spark, sf)
    month = F.trunc(F.col("date_time_lst").cast("date"), "month")
    per_file = wx.groupBy("city", "station_id", month.alias("m")).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.select(
        text.file_label(F.col("city"), F.col("station_id"), F.col("m")).alias("file_name"),
        F.when(F.col("station_id") == 30682, "skipped").when(F.col("station_id") == 31688, "failed").otherwise("new").alias("outcome"),
        "rows",
    )


@query
def manifest_grid(spark, sf):
    return manifest.month_manifest(_station_months(spark, sf))


@query
def manifest_years(spark, sf):
    per_station = inputs.aqhi(spark, sf).groupBy("station_id", "station_name").agg(
        F.min("requested_year").alias("y0"), (F.max("requested_year") + 1).alias("y1")
    )
    return manifest.year_manifest(per_station, "y0", "y1")


@query
def manifest_outstanding(spark, sf):
    return manifest.outstanding(manifest.month_manifest(_station_months(spark, sf)), _landed(spark, sf))


@query
def extraction_summary(spark, sf):
    return manifest.extraction_summary(
        manifest.month_manifest(_station_months(spark, sf)), _landed(spark, sf)
    )


# --- projections and filters --------------------------------------------------------------------


@query
def name_normalise(spark, sf):
    p = inputs.table(spark, sf, "part")
    label = F.concat(F.lit(" "), F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))
    return p.select("p_partkey", text.snake(label).alias("column_name"))


@query
def drop_all_null_column(spark, sf):
    """The column without any value goes, a partly filled one stays."""
    rows = inputs.aqhi_raw(spark, sf).select(
        "row_id", "aqhi", F.nullif(F.lit("x"), F.when(F.col("row_id") >= 0, "x")).alias("aqhi_1")
    )
    for column in ("aqhi_1", "aqhi"):
        rows = quality.drop_empty_column(rows, column)
    return rows


@query
def bbox_time_filter(spark, sf):
    return exposure.bbox_time_filter(inputs.hotspots(spark, sf), "2024-01-05", "2024-01-20").select(
        "uid", "rep_date", "lat", "lon"
    )


@query
def allowlist_city_map(spark, sf):
    rows = inputs.current(spark, sf).select("row_id", "location_id", "observation_datetime", "aqhi")
    return aqhi.allowed_locations(rows)


@query
def current_feed_capped(spark, sf):
    rows = inputs.current(spark, sf).select("row_id", "aqhi")
    return aqhi.capped_like_history(rows)


@query
def station_mode_filter(spark, sf):
    rows = aqhi.station_mode(inputs.aqhi(spark, sf), 63200, "Thunder Bay", "daily_4pm", [2024, 2025])
    return rows.select("row_id", "requested_year", "date", "time", "aqhi_raw")


@query
def year_mismatch(spark, sf):
    return quality.year_mismatches(inputs.aqhi(spark, sf)).select(
        "row_id", "station_name", "requested_year", "value_type", "date", "time", "actual_year"
    )


@query
def censored_aqhi(spark, sf):
    return inputs.aqhi(spark, sf).select("row_id", "aqhi_raw", "aqhi_is_10_plus", "aqhi_numeric")


@query
def missing_and_capped_rows(spark, sf):
    return aqhi.missing_and_capped(inputs.aqhi(spark, sf)).select(
        "row_id", "date", "time", "aqhi_raw", "category", "station_name", "value_type", "reason"
    )


@query
def clock_text_utc(spark, sf):
    rows = inputs.aqhi(spark, sf)
    return rows.select("row_id", moments.clock_to_utc(F.col("date"), F.col("time")).alias("observed_utc"))


@query
def fires_cleaned(spark, sf):
    return fires.clean_fires(inputs.fires_raw(spark, sf)).select(
        "OBJECTID",
        "fire_id",
        "agency_code",
        "stage_of_control_code",
        "agency_fire_cause_code",
        "system_fire_cause_code",
        "response_type_code",
        "fire_size_hectares",
        "latitude",
        "longitude",
        "situation_report_datetime_utc",
        "status_datetime_utc",
        "refreshed_datetime_utc",
    )


@query
def stage_labels(spark, sf):
    return fires.clean_fires(inputs.fires_raw(spark, sf)).select(
        "OBJECTID",
        "stage_of_control_label",
        "stage_of_control_label_provisional",
        "stage_of_control_mapping_status",
        "stage_of_control_display_label",
    )


@query
def active_fires(spark, sf):
    cleaned = fires.clean_fires(inputs.fires_raw(spark, sf))
    return fires.active_only(cleaned).select("OBJECTID", "stage_of_control_code", "fire_size_hectares")


@query
def response_labels(spark, sf):
    return fires.clean_fires(inputs.fires_raw(spark, sf)).select(
        "OBJECTID", "response_type_code", "response_type_label"
    )


@query
def cause_interpretation(spark, sf):
    return fires.clean_fires(inputs.fires_raw(spark, sf)).select(
        "OBJECTID", "cause_interpretation_provisional", "cause_mapping_status"
    )


@query
def sentinel_flags(spark, sf):
    cleaned = fires.clean_fires(inputs.fires_raw(spark, sf))
    return cleaned.select("OBJECTID", *[f"{c}_is_minus_one" for c in SENTINEL_FIELDS])


@query
def wind_missing_class(spark, sf):
    return weather.with_classes(inputs.weather(spark, sf)).select("row_id", "wind_class")


@query
def precip_class(spark, sf):
    return weather.with_classes(inputs.weather(spark, sf)).select("row_id", "precip_class")


@query
def lst_to_utc(spark, sf):
    """By the offset that the station dimension gives; one city's station is planted an hour behind."""
    behind = F.when(F.col("city_id") == 3, -6).otherwise(F.col("utc_offset_hours"))
    stations = dimensions.station_register(spark).withColumn("utc_offset_hours", behind)
    rows = dimensions.with_station_city(inputs.weather(spark, sf), stations, "eccc_weather", F.col("station_id"))
    return weather.with_utc(rows, F.col("utc_offset_hours")).select("row_id", "date_time_lst", "date_time_utc", "civil_date")


@query
def station_coordinates(spark, sf):
    c = inputs.station_candidates(spark, sf)
    return c.select(
        "station_id",
        geo.degrees_minutes(F.col("lat_deg"), F.col("lat_min")).alias("latitude"),
        geo.degrees_minutes(F.col("lon_deg"), F.col("lon_min")).alias("longitude"),
    )


# --- joins --------------------------------------------------------------------------------------


@query
def duplicate_date_rows(spark, sf):
    return quality.duplicate_date_rows(inputs.aqhi(spark, sf), STATION).select(
        "row_id", *STATION, "date", "time", "record_count", "distinct_times", "distinct_aqhi_values"
    )


@query
def largest_with_ties(spark, sf):
    cleaned = fires.clean_fires(inputs.fires_raw(spark, sf))
    return quality.largest_with_ties(cleaned, "fire_size_hectares").select(
        "fire_id", "fire_size_hectares", "stage_of_control_code", "latitude", "longitude"
    )


@query
def expected_vs_returned(spark, sf):
    expected = grouping.literal_rows(spark, ["location_id"], [(k,) for k, _ in GEOMET_LOCATIONS])
    return quality.expected_against_returned(expected, inputs.current(spark, sf), "location_id")


@query
def station_city_lookup(spark, sf):
    rows = inputs.weather(spark, sf).withColumnRenamed("station_id", "eccc_id")
    joined = dimensions.with_station_city(
        rows, dimensions.station_register(spark), "eccc_weather", F.col("eccc_id")
    )
    return joined.groupBy("source_station_id", "warehouse_station_id", "city_id").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _days(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.calendar(inputs.grid_bounds(spark, sf), "first_day", "last_day")


@query
def dim_date(spark, sf):
    return dimensions.dim_date(_days(spark, sf))


@query
def city_day_grid(spark, sf):
    return dimensions.city_day_grid(_days(spark, sf))


def _city_fact(spark: SparkSession, sf: str) -> DataFrame:
    air = aqhi.city_daily(aqhi.station_daily(inputs.aqhi(spark, sf)))
    return city_daily.assemble(
        dimensions.city_day_grid(_days(spark, sf)),
        air,
        exposure.city_exposure(inputs.hotspots(spark, sf)),
        weather.daily_weather(inputs.weather_network(spark, sf)),
        inputs.fire_days(spark, sf),
    )


@query
def fact_city_daily(spark, sf):
    return _city_fact(spark, sf)


@query
def hotspot_city_exposure(spark, sf):
    return exposure.city_exposure(inputs.hotspots(spark, sf))


@query
def hotspot_site_exposure(spark, sf):
    """Exposure of every registered station by the cell join."""
    sites = inputs.stations(spark, sf).where(
        F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    ).groupBy("station_id").agg(F.min("latitude").alias("site_lat"), F.min("longitude").alias("site_lon"))
    return exposure.site_exposure(
        inputs.hotspots(spark, sf), sites.withColumnRenamed("station_id", "city_id")
    ).withColumnRenamed("city_id", "station_id")


@query
def point_in_polygon(spark, sf):
    return exposure.inside_outline(inputs.hotspots(spark, sf), PROVINCE_SKETCH).select("uid", "lat", "lon")


@query
def province_daily_totals(spark, sf):
    return exposure.province_daily_totals(exposure.inside_outline(inputs.hotspots(spark, sf), PROVINCE_SKETCH))


@query
def earliest_province_hotspot(spark, sf):
    return exposure.earliest_hotspot(exposure.inside_outline(inputs.hotspots(spark, sf), PROVINCE_SKETCH))


@query
def fk_orphans(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select((F.col("l_orderkey") + F.col("l_linenumber") * 100).alias("fire_id"))
    orders = inputs.table(spark, sf, "orders")
    return quality.orphans(lines, orders, "fire_id", "o_orderkey")


@query
def latest_state(spark, sf):
    history = inputs.fire_history(spark, sf)
    return fires.latest_state(
        history.select("fire_id", "snapshot_no", "status_date", "part", "stage", "size_hectares"),
        "fire_id",
        ["snapshot_no", "status_date", "part"],
    )


@query
def state_as_of(spark, sf):
    """What was known of each fire some days after it was reported."""
    asked = inputs.table(spark, sf, "orders").selectExpr(
        "o_orderkey as fire_id", "date_add(cast(o_orderdate as date), int(o_orderkey % 120)) as asked_on"
    )
    history = inputs.fire_history(spark, sf).select("fire_id", "status_date", "stage", "size_hectares")
    return asof.state_as_of(asked, history, ["fire_id"], "asked_on", "status_date", ["stage", "size_hectares"], 50_000)


@query
def snapshot_diff(spark, sf):
    return fires.snapshot_diff(
        inputs.fire_snapshots(spark, sf), "fire_id", "snapshot_no", ["stage", "response", "size_hectares"]
    )


@query
def unknown_codes(spark, sf):
    return fires.unknown_codes(inputs.fires_raw(spark, sf))


@query
def provisional_codes_seen(spark, sf):
    return fires.provisional_codes_seen(inputs.fires_raw(spark, sf))


def _start_days(log: DataFrame) -> DataFrame:
    """The calendar from the first to the last day on which an event began."""
    return dimensions.calendar(log.agg(F.min("start_date").alias("a"), F.max("start_date").alias("b")), "a", "b")


def _open_days(log: DataFrame) -> DataFrame:
    """The calendar from the first day on which an event began to the last on which one is known to last."""
    lasting = log.select("start_date", evacuation.known_end().alias("last_day")).where("last_day >= start_date")
    return dimensions.calendar(lasting.agg(F.min("start_date").alias("a"), F.max("last_day").alias("b")), "a", "b")


@query
def evac_overlap_days(spark, sf):
    log = inputs.evacuation_log(spark, sf)
    return evacuation.open_per_day(log, _open_days(log), "nearby_project_city")


@query
def evac_annotations(spark, sf):
    log = inputs.evacuation_log(spark, sf)
    return evacuation.annotations(log, _start_days(log), "nearby_project_city")


@query
def evac_episodes(spark, sf):
    log = inputs.evacuation_log(spark, sf)
    return evacuation.episodes(log.where(F.col("start_date").isNotNull()))


@query
def evac_fact(spark, sf):
    return evacuation.evacuation_facts(
        inputs.evacuation_log(spark, sf), dimensions.dim_city(spark), "row_id"
    )


@query
def fallback_station(spark, sf):
    wx = inputs.weather(spark, sf)
    return weather.fallback_reading(wx, ["city", "date_time_lst"], ["temp", "precip"], enabled=True)


# --- aggregates ---------------------------------------------------------------------------------


@query
def records_by_location(spark, sf):
    return quality.group_sizes(
        inputs.current(spark, sf), ["location_id", "location_name_en"], "record_count", keep_null_keys=False
    )


@query
def rows_by_station_year_type(spark, sf):
    keys = ["city", "station_name", "station_id", "requested_year", "value_type"]
    return quality.group_sizes(inputs.aqhi(spark, sf), keys, "row_count")


@query
def unique_dates(spark, sf):
    keys = ["station_name", "requested_year", "value_type"]
    return quality.distinct_values(inputs.aqhi(spark, sf), keys, "date", "unique_date_count")


@query
def year_summary(spark, sf):
    return quality.year_summary(inputs.aqhi(spark, sf), STATION)


@query
def duplicate_dates(spark, sf):
    return quality.duplicate_dates(inputs.aqhi(spark, sf), STATION)


@query
def time_summary(spark, sf):
    return quality.time_summary(inputs.aqhi(spark, sf), STATION)


@query
def exact_duplicate_rows(spark, sf):
    rows = inputs.aqhi(spark, sf)
    return quality.exact_duplicates(rows, SOURCE_FIELDS).select("row_id", *SOURCE_FIELDS, "copies")


@query
def datetime_conflicts(spark, sf):
    return quality.datetime_conflicts(inputs.aqhi(spark, sf), STATION)


@query
def conflict_values(spark, sf):
    return quality.conflict_values(inputs.aqhi(spark, sf), STATION)


@query
def redundant_copies(spark, sf):
    rows = inputs.aqhi(spark, sf)
    parts = [
        ("station/date/type", ["station_id", "value_type", "date"]),
        ("all source fields", SOURCE_FIELDS),
        ("row_id", ["row_id"]),
    ]
    return rules.union_all(
        [quality.redundant_copies(rows, keys).withColumn("key", F.lit(name)) for name, keys in parts]
    )


@query
def null_profile(spark, sf):
    return quality.null_profile(inputs.aqhi(spark, sf))


@query
def coverage(spark, sf):
    return quality.coverage(
        inputs.hotspots(spark, sf), ["rep_date", "lat", "lon"], ["uid", "date", "agency"]
    )


@query
def merged_profile(spark, sf):
    """The hotspots' profile from the states of eight loads, held against the exact one."""
    columns = ["uid", "date", "agency", "lat"]
    rows = inputs.hotspots(spark, sf)
    states = settle(profiles.states(rows.withColumn("load", F.col("uid") % 8), columns, ["load"]), "profile-states")
    exact = profiles.exact(rows, columns)
    near = F.abs(F.col("distinct_count") - F.col("exact_count")) <= 0.03 * F.col("exact_count")
    return (
        profiles.merged(states)
        .join(exact.select("column_name", F.col("distinct_count").alias("exact_count")), "column_name")
        .select("column_name", "row_count", "null_count", "low", "high", "exact_count", near.alias("distinct_within_3_pct"))
    )


@query
def code_frequency(spark, sf):
    return fires.fire_code_frequency(inputs.fires_raw(spark, sf))


@query
def flag_frequency(spark, sf):
    return quality.code_frequency(
        inputs.weather(spark, sf), ["precip_flag", "wind_flag"], by=["city"], value_col="flag_value"
    )


@query
def validation_report(spark, sf):
    return fires.validation_report(fires.clean_fires(inputs.fires_raw(spark, sf)))


@query
def rows_per_city_month(spark, sf):
    return weather.rows_per_month(inputs.weather(spark, sf))


@query
def distinct_locations(spark, sf):
    columns = ["location_id", "location_name_en", "longitude", "latitude"]
    return quality.distinct_locations(inputs.current(spark, sf), columns)


@query
def weather_daily(spark, sf):
    return weather.daily_weather(inputs.weather_network(spark, sf)).drop(
        "wind_u_mean", "wind_v_mean", "wind_dir_mean_deg"
    )


@query
def wind_vector_daily(spark, sf):
    return weather.daily_weather(inputs.weather(spark, sf), ["station_id"]).select(
        "station_id", "date", "wind_u_mean", "wind_v_mean", "wind_dir_mean_deg"
    )


@query
def snapshot_append(spark, sf):
    """The historical readings in two loads: the second one delivers a part of the days of some stations again."""
    path = f"{shared_dir(spark)}/staging-{uuid.uuid4().hex}"
    rows = inputs.aqhi(spark, sf)
    again = rows.where("row_id % 3 = 0 and dayofyear(date) between 100 and 160 and station_id % 2 = 1")
    source = staging.STAGING["aqhi_aqo_historical"]
    staging.stage(rows, path, source, 1)
    staging.stage(again, path, source, 2)
    return staging.staged(spark, path, source).select("row_id", "date", "load")


@query
def expected_hours(spark, sf):
    return weather.expected_hours(inputs.weather(spark, sf))


@query
def missing_pct(spark, sf):
    rows = inputs.weather(spark, sf).withColumn("year", F.year("date_time_lst"))
    return weather.missing_percent(rows, ["city", "year"])


@query
def city_aqhi_daily(spark, sf):
    return aqhi.city_daily(aqhi.station_daily(inputs.aqhi(spark, sf)))


@query
def city_aqhi_daily_max_rule(spark, sf):
    return aqhi.city_daily(aqhi.station_daily(inputs.aqhi(spark, sf)), rule="max")


@query
def station_spread(spark, sf):
    return aqhi.station_spread(aqhi.station_daily(inputs.aqhi(spark, sf)))


@query
def aqhi_mode_comparison(spark, sf):
    return aqhi.mode_comparison(aqhi.station_daily(inputs.aqhi(spark, sf)))


@query
def aqhi_daily_from_hourly(spark, sf):
    return aqhi.daily_from_hourly(
        inputs.current(spark, sf), ["location_name_en"], "observation_datetime", "aqhi"
    )


@query
def distribution(spark, sf):
    return aqhi.value_distribution(inputs.aqhi(spark, sf), ["station_id", "value_type"], "aqhi_numeric")


@query
def completeness(spark, sf):
    return aqhi.completeness(inputs.aqhi(spark, sf))


@query
def source_freshness(spark, sf):
    sources = [
        ("hotspots", inputs.hotspots(spark, sf), "rep_date"),
        ("weather", inputs.weather(spark, sf), "date_time_lst"),
        ("fires", inputs.table(spark, sf, "orders"), "o_orderdate"),
    ]
    return quality.freshness(sources, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


# --- windows ------------------------------------------------------------------------------------


@query
def daily_max_date_anomalies(spark, sf):
    return aqhi.daily_max_date_anomalies(inputs.aqhi(spark, sf, sparse=True))


@query
def date_anomaly_flags(spark, sf):
    return aqhi.date_anomaly_flags(inputs.aqhi(spark, sf, sparse=True))


@query
def hour_gaps(spark, sf):
    return weather.hour_gaps(inputs.weather(spark, sf))


@query
def station_coverage(spark, sf):
    return weather.station_coverage(inputs.weather(spark, sf))


@query
def hour_runs(spark, sf):
    return weather.hour_runs(inputs.weather(spark, sf))


@query
def duplicate_timestamps(spark, sf):
    return weather.duplicate_timestamps(inputs.weather(spark, sf))


@query
def dedup_exact(spark, sf):
    return aqhi.dedup_exact(inputs.aqhi(spark, sf), SOURCE_FIELDS).select(
        "row_id", *SOURCE_FIELDS, "removed_copies"
    )


@query
def conflict_quarantine(spark, sf):
    return aqhi.conflict_quarantine(inputs.aqhi(spark, sf)).select(
        "row_id", "source_value_conflict", "series_value", "series_category"
    )


@query
def primary_station(spark, sf):
    return weather.primary_station(
        inputs.station_candidates(spark, sf), "2024-01-01", "2026-07-31", ["has_wind", "has_precip"]
    )


def _panel(spark: SparkSession, sf: str, target: str = "aqhi_daily_4pm") -> DataFrame:
    """The fact settled first: every step below joins or windows it more than once."""
    return model_prep.series(settle(_city_fact(spark, sf), "fact_city_daily"), target)


@query
def training_rows(spark, sf):
    return model_prep.training_rows(_city_fact(spark, sf), "aqhi_daily_max")


@query
def next_day_target(spark, sf):
    return model_prep.next_day_target(_panel(spark, sf)).select("city_id", "date_id", "y", "y_next")


@query
def persistence_forecast(spark, sf):
    return model_prep.persistence(_panel(spark, sf))


@query
def moving_average_forecast(spark, sf):
    return model_prep.moving_average(_panel(spark, sf))


@query
def lookback_windows(spark, sf):
    windows = model_prep.lookback_windows(_panel(spark, sf), "y", 7)
    parts = F.transform("lookback", lambda x: F.round(x, 4).cast("decimal(12,4)").cast("string"))
    return windows.select("city_id", "date_id", F.array_join(parts, ",").alias("lookback"))


@query
def lag_correlation(spark, sf):
    return model_prep.lag_correlation(
        _panel(spark, sf, "aqhi_daily_max"), ["hotspots_within_500km", "temp_mean"], [0, 1, 2]
    )


@query
def time_split(spark, sf):
    cutoff = F.lit("2024-10-31").cast("date")
    return model_prep.time_split(_panel(spark, sf).select("city_id", "date_id", "y"), cutoff)


@query
def train_scaled(spark, sf):
    split = model_prep.time_split(_panel(spark, sf), F.lit("2024-01-20").cast("date"))
    return model_prep.scale(split, ["y", "temp_mean"]).select(
        "city_id", "date_id", "part", "y_scaled", "temp_mean_scaled"
    )


@query
def train_scaled_minmax(spark, sf):
    split = model_prep.time_split(_panel(spark, sf), F.lit("2024-01-20").cast("date"))
    return model_prep.scale(split, ["y", "temp_mean"], method="minmax").select(
        "city_id", "date_id", "part", "y_scaled", "temp_mean_scaled"
    )


@query
def forecast_metrics(spark, sf):
    return model_prep.score(model_prep.baselines(_panel(spark, sf)))


@query
def metrics_by_band(spark, sf):
    rows = model_prep.baselines(_panel(spark, sf)).withColumn("band", model_prep.band(F.col("y")))
    return model_prep.score(rows, ["city_id", "model", "band"])


@query
def preview_top_n(spark, sf):
    rows = inputs.current(spark, sf).select("row_id", "location_id", "observation_datetime", "aqhi")
    return quality.preview(rows, ["observation_datetime", "location_id", "row_id"], 20)


# --- rules --------------------------------------------------------------------------------------


@query
def clock_change_days(spark, sf):
    """Stamps a third of a year apart, so that both clock changes are among them."""
    wx = inputs.weather(spark, sf).withColumn(
        "date_time_lst", F.expr("date_time_lst + make_dt_interval(int(row_id % 24) * 14, 0, 0, 0)")
    )
    return plain(weather.clock_change_days(wx))


@query
def dq_dim(spark, sf):
    return rules.dimension_rules(inputs.stations(spark, sf), dimensions.dim_city(spark))


@query
def dq_city_date(spark, sf):
    return rules.city_rules(inputs.places(spark, sf)).unionByName(rules.date_rules(inputs.calendar_days(spark, sf)))


@query
def dq_weather(spark, sf):
    return rules.weather_rules(inputs.weather(spark, sf), F.col("row_id"))


@query
def dq_evac(spark, sf):
    return rules.evacuation_rules(
        inputs.evacuation_log(spark, sf), cutoff="2000-12-31", start="1996-01-01"
    )


@query
def dq_fact(spark, sf):
    """The fact with planted breaks: a repeated city-day, a stray city, counts without a source,
    a city without its first days, readings that a flag promises."""
    fact = settle(_city_fact(spark, sf), "fact_city_daily").where("city_id <> 2 or dayofyear(date_id) > 5")
    broken = fact.withColumns(
        {
            "hotspots_within_100km": F.when(
                F.dayofmonth("date_id") == 17, F.lit(None)
            ).when(F.dayofmonth("date_id") == 24, F.lit(5)).otherwise(F.col("hotspots_within_100km")),
            **{
                c: F.when(F.dayofmonth("date_id") != 11, F.col(c)) for c in ("aqhi_daily_4pm", "aqhi_daily_max")
            },
            "city_id": F.when(F.dayofyear("date_id") == 40, F.col("city_id") + 1).otherwise(F.col("city_id")),
        }
    )
    return rules.fact_rules(broken, dimensions.dim_city(spark), _days(spark, sf))


# --- increments ---------------------------------------------------------------------------------


@query
def poll_upsert(spark, sf):
    rows = inputs.current(spark, sf).select("id", "snapshot_ts", "row_id", "aqhi")
    return polls.upsert_polls(rows)


@query
def poll_stream_ids(spark, sf):
    """Ids left after the streaming de-duplication of one catch-up run, late ones included."""
    schema = inputs.table(spark, sf, "events").schema
    stream = polls.stream_folder(spark, f"{sf}/events.parquet", schema).select(
        F.concat_ws("-", (F.col("user_id") % 8).cast("string"), F.col("ts").cast("date").cast("string"), F.hour("ts").cast("string")).alias("id"),
        F.col("ts").cast("timestamp").alias("observation_datetime"),
    )
    run = f"{shared_dir(spark)}/poll-{uuid.uuid4().hex}"
    polls.ingest_first_seen(stream, f"{run}/ids", f"{run}/progress").awaitTermination()
    return polls.read_first_seen(spark, f"{run}/ids").select("id")


@query
def poll_stream_upsert(spark, sf):
    """The streaming upsert of one catch-up run; the same result as the batch form."""
    schema = inputs.table(spark, sf, "events").schema
    stream = polls.stream_folder(spark, f"{sf}/events.parquet", schema)
    rows = inputs.current_rows(stream).select("id", "snapshot_ts", "row_id", "aqhi")
    run = f"{shared_dir(spark)}/upsert-{uuid.uuid4().hex}"
    polls.ingest_upserts(rows, f"{run}/rows", f"{run}/progress").awaitTermination()
    return polls.upserts(spark, f"{run}/rows", rows.schema).read()
