import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from airshed.operators.aqhi import clean_history
from airshed.operators.evacuation import evacuation_facts
from airshed.operators.weather import daily_weather
from airshed.plans import staging
from airshed.plans.dimensions import dim_city
from airshed.operators.exposure import outline_vertices
from airshed.operators.rules import fact_rules
from airshed.plans.pipeline import Store, check_facts, load_dimensions, load_facts, load_landed, load_staging, row_counts, staged
from airshed.sources import landed
from airshed.sources.files import read_csv, read_measures, read_table, replace_load, write_table
from airshed.sources.schemas import ACTIVE_FIRES, AQHI_CURRENT, conform
from airshed.streaming.polls import stamp_rows

DAYS = 40


def sources(spark):
    hot = spark.sql("select * from values ('h1', timestamp_ntz'2024-01-02 05:00:00', 44.4D, -79.7D), ('h2', timestamp_ntz'2024-01-03 05:00:00', 44.4D, -79.7D) as t(uid, rep_date, lat, lon)")
    air = clean_history(
        spark.sql(
            f"select id as row_id, cast(date_add(date'2024-01-01', int(id)) as string) as date, '4:00 pm EST' as time, if(id = 5, '10+', '3') as aqhi,"
            f" 'low risk' as category, 'Barrie' as city, 'Barrie' as station_name, 47045 as station_id, 2024 as requested_year,"
            f" 'daily_4pm' as value_type, 0 as show_day_code from range({DAYS}) where id <> 7"
        )
    )
    fires = stamp_rows(
        conform(spark.sql("select 1 as OBJECTID, 'OC' as FIELD_STAGE_OF_CONTROL_STATUS, '48' as FIELD_LATITUDE, '-89' as FIELD_LONGITUDE"), ACTIVE_FIRES, ["OBJECTID"]),
        "2026-07-31 04:59:31", "https://example.org/fires",
    )
    wx = spark.sql(
        "select 1 as station_id, 'Barrie' as city, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id), 0, 0) as date_time_lst, 1D as temp,"
        " 50D as rh, 0D as precip, 27D as wind_dir_10s_deg, 5D as wind_speed from range(30)"
    )
    evac = spark.sql(
        "select 'EVAC-001' as event_id, 'Armstrong' as community, 'Thunder Bay' as nearby_project_city, date'2026-07-13' as start_date,"
        " cast(null as date) as end_date, 'Ongoing' as status, date'2026-08-04' as status_as_of_date, 'https://www.cbc.ca/1' as source_url"
    )
    current = conform(spark.sql("select 'x' as id"), AQHI_CURRENT).where("false").withColumn("observation_datetime", F.lit(None).cast("timestamp_ntz"))
    return {
        "cwfis_hotspots": hot, "aqhi_geomet_current": current, "aqhi_aqo_historical": air, "ontario_active_fires": fires,
        "eccc_hourly_weather": wx, "evacuation_log": evac,
    }


def test_landing_to_facts_twice(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    fire_days = spark.sql("select * from values (date'2024-01-02', true), (date'2024-01-03', false), (date'2024-01-04', true) as t(date, ok)")
    for again in (False, True):  # a second run replaces, it does not add
        load_staging(store, sources(spark), 0, replace=again)
        load_dimensions(store, "2024-01-01", str(dt.date(2024, 1, 1) + dt.timedelta(DAYS - 1)))
        load_facts(store, fire_days)
    counts = {r["table_name"]: r["row_count"] for r in row_counts(store).collect()}
    assert counts == {
        "cwfis_hotspots": 2, "aqhi_geomet_current": 0, "aqhi_aqo_historical": DAYS - 1, "ontario_active_fires": 1, "eccc_hourly_weather": 30,
        "evacuation_log": 1, "dim_city": 4, "dim_date": DAYS, "dim_station": 19, "fact_city_daily": 4 * DAYS,
        "fact_evacuation_events": 1, "ref_active_fires_snapshot": 1,
    }
    fact = store.read("analytics", "fact_city_daily").where("city_id = 1")
    got = {
        (r["date_id"].day): (r["hotspots_within_100km"], r["nearest_hotspot_distance_km"] is None, r["fire_data_available"], r["weather_data_available"])
        for r in fact.where("date_id <= date'2024-01-04'").collect()
    }
    # 1: no extract, 2: extract with a hotspot, 3: hotspot but no extract, 4: extract without hotspots
    assert got == {1: (None, True, False, True), 2: (1, False, True, False), 3: (None, True, False, False), 4: (0, True, True, False)}
    assert as_set(fact.where("aqhi_any_10_plus").select("date_id", "aqhi_daily_4pm")) == [(dt.date(2024, 1, 6), 10.0)]
    assert fact.where("not aqhi_data_available").count() == 1
    warned = {r["rule_id"] for r in check_facts(store).collect()}
    assert warned == {f"Q17_{c}_incomplete" for c in ("temp_mean", "temp_min", "temp_max", "precip_total", "wind_speed_mean", "wind_dir_mean_deg")}
    # The write has measured what the rules find, so unbroken ones need no scan.
    seen = read_measures(spark, store.path("analytics", "fact_city_daily"))
    assert seen["row_count"] == 4 * DAYS and {n for n, v in seen.items() if v and n != "row_count"} == warned
    assert as_set(fact_rules(store.read("analytics", "fact_city_daily"), store.read("analytics", "dim_city"), store.read("analytics", "dim_date"))) == as_set(
        store.read("quality", "fact_rules")
    )
    snapshot = store.read("analytics", "ref_active_fires_snapshot").first()
    assert snapshot["is_active_fire"] and snapshot["stage_of_control_label"] == "Out of Control"


def test_later_loads_keep_what_was_landed(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    poll = "select * from values {} as t(uid, rep_date, lat, lon)"
    one = spark.sql(poll.format("('a', timestamp_ntz'2024-07-01 05:00:00', 44D, -79D), ('b', timestamp_ntz'2024-07-02 05:00:00', 44D, -79D)"))
    two = spark.sql(poll.format("('c', timestamp_ntz'2024-07-20 05:00:00', 44D, -79D), ('b', timestamp_ntz'2024-08-02 05:00:00', 45D, -79D)"))
    fires = [
        stamp_rows(conform(spark.sql("select 1 as OBJECTID"), ACTIVE_FIRES, ["OBJECTID"]), f"2026-07-{d} 04:59:31", "https://example.org/fires")
        for d in (30, 31)
    ]
    for load, (hot, snapshot) in enumerate(zip((one, two), fires)):
        load_staging(store, {"cwfis_hotspots": hot, "ontario_active_fires": snapshot}, load)
    load_staging(store, {"cwfis_hotspots": two}, 1, replace=True)  # the same load again
    got = as_set(staged(store, "cwfis_hotspots").select("uid", "lat", F.month("rep_date")))
    assert got == [("a", 44.0, 7), ("b", 45.0, 8), ("c", 44.0, 7)]
    assert staged(store, "ontario_active_fires").count() == 2


def readings(spark, first, n, value="3"):
    return clean_history(
        spark.sql(
            f"select id as row_id, cast(date_add(date'{first}', int(id)) as string) as date, '4:00 pm EST' as time, '{value}' as aqhi, 'low risk' as category,"
            f" 'Barrie' as city, 'Barrie' as station_name, 47045 as station_id, 2024 as requested_year, 'daily_4pm' as value_type, 0 as show_day_code from range({n})"
        )
    )


def test_a_load_replaces_the_span_it_covers(spark, tmp_path):
    store, name = Store(spark, str(tmp_path)), "aqhi_aqo_historical"
    load_staging(store, {name: readings(spark, "2024-01-01", 10)}, 0)
    load_staging(store, {name: readings(spark, "2024-01-11", 1)}, 1)  # one later day
    assert staged(store, name).count() == 11
    known = {r["column_name"]: r for r in staging.profile(spark, store.path("staging", name)).collect()}
    assert (known["date"]["row_count"], known["date"]["distinct_count"], known["date"]["low"]) == (11, 11, 19723 * 86400.0)
    load_staging(store, {name: readings(spark, "2024-01-03", 2, "7")}, 2)  # two days corrected
    got = {r["date"].day: r["aqhi_numeric"] for r in staged(store, name).collect()}
    assert got == {d: 7.0 if d in (3, 4) else 3.0 for d in range(1, 12)}
    with pytest.raises(ValueError, match="load 2"):
        load_staging(store, {name: readings(spark, "2024-05-01", 2)}, 2)
    # Days 8 to 11 are taken back, by declaration; the other station's and the undated rows stay.
    taken = spark.sql("select 47045 as station_id, 'daily_4pm' as value_type, 2024 as requested_year, date'2024-01-08' as first, date'2024-01-11' as last")
    other = readings(spark, "2024-01-08", 2).withColumn("station_id", F.lit(1))
    load_staging(store, {name: other.withColumn("date", F.when(F.col("row_id") > 0, F.col("date")))}, 3, spans={name: taken})
    got = as_set(staged(store, name).select("station_id", F.dayofmonth("date")))
    assert sorted(got, key=repr) == sorted([(47045, d) for d in range(1, 8)] + [(1, 9), (1, None)], key=repr)
    load_staging(store, {name: other.withColumn("date", F.lit(None).cast("date"))}, 4)  # undated rows replace undated rows
    assert staged(store, name).where("station_id = 1").groupBy("date").count().count() == 2
    assert staged(store, name).where("date is null").count() == 2


def test_a_load_that_broke_off_does_not_count(spark, tmp_path):
    store, name = Store(spark, str(tmp_path)), "aqhi_aqo_historical"
    load_staging(store, {name: readings(spark, "2024-01-01", 10)}, 0)
    rows = readings(spark, "2024-01-01", 3, "7").withColumn("month", F.lit("2024-01"))
    replace_load(rows, store.path("staging", name), 1, ["month"])  # rows without their record
    assert staged(store, name).count() == 10 and staged(store, name).where("aqhi_numeric = 7").count() == 0
    load_staging(store, {name: readings(spark, "2024-01-01", 3, "7")}, 1)
    assert staged(store, name).where("aqhi_numeric = 7").count() == 3


def test_landed_files_and_a_boundary_to_facts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (tmp_path / "hot.csv").write_text("uid,rep_date,lat,lon\na,2024-01-02 05:00:00,44.4,-79.7\nb,2024-01-02 05:00:00,44.4,-74.5\n")
    (tmp_path / "wx.csv").write_text(
        "Date/Time (LST),Temp (°C),Precip. Amount (mm),Wind Dir (10s deg),Wind Spd (km/h),project_city,project_station_id,project_station_name\n"
        + "".join(f"2024-01-02 {h:02d}:00,1.5,1.0,27,5,Barrie,{s},X\n" for h in range(24) for s in (42183, 942183))
    )
    (tmp_path / "air.csv").write_text(
        "row_id,date,time,aqhi,category,city,station_name,station_id,requested_year,value_type,show_day_code\n"
        "1,2024-01-02,4:00 pm EST,10+,very high risk,Barrie,Barrie,47045,2024,daily_4pm,0\n"
    )
    (tmp_path / "evac.csv").write_text(
        "event_id,community,nearby_project_city,evacuation_start_date,evacuation_end_date,event_status,status_as_of_date,source_name,source_url\n"
        "EVAC-001,Armstrong,Thunder Bay,2026-07-13,,Ongoing,2026-08-04,CBC News,https://www.cbc.ca/1\n"
    )
    (tmp_path / "fires.csv").write_text("OBJECTID\n1\n")
    names = {"cwfis_hotspots": "hot", "eccc_hourly_weather": "wx", "aqhi_aqo_historical": "air", "evacuation_log": "evac", "ontario_active_fires": "fires"}
    load_landed(store, {n: str(tmp_path / f"{f}.csv") for n, f in names.items()}, 1, "2026-07-31 04:59:31", "https://example.org/fires")
    load_dimensions(store, "2024-01-01", "2024-01-03")
    box = outline_vertices(spark, [[(44.0, -80.0), (44.0, -79.0), (45.0, -79.0), (45.0, -80.0)]])
    load_facts(store, spark.sql("select date'2024-01-02' as date, true as ok"), boundary=box)
    fact = store.read("analytics", "fact_city_daily").where("city_id = 1 and date_id = date'2024-01-02'").first()
    assert (fact["precip_total"], fact["aqhi_daily_4pm"], fact["hotspots_within_500km"], fact["weather_fallback_stations"]) == (24.0, 10.0, 1, "")
    assert store.read("analytics", "province_daily_totals").first()["total_hotspots"] == 1


def test_measures_of_empty_and_rewritten_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    measures = {"n": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)}
    assert read_measures(spark, path) == {}
    write_table(spark.range(0), path, measures=measures)
    assert read_measures(spark, path) == {"n": 0, "odd": 0}
    write_table(spark.range(7).withColumn("p", F.col("id") % 2), path, ["p"], measures=measures)
    assert read_measures(spark, path) == {"n": 7, "odd": 3} and read_table(spark, path).count() == 7


def test_a_load_with_fewer_columns_hides_none(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    full = spark.sql("select 'a' as uid, timestamp_ntz'2024-07-01 05:00:00' as rep_date, 1D as frp")
    load_staging(store, {"cwfis_hotspots": full}, 0)
    load_staging(store, {"cwfis_hotspots": full.drop("frp").withColumn("uid", F.lit("b"))}, 1)
    assert as_set(staged(store, "cwfis_hotspots").select("uid", "frp")) == [("a", 1.0), ("b", None)]


def test_landed_files_reach_the_operators(spark, tmp_path):
    """From CSV files as they are landed to the daily weather, the evacuation fact and the readings."""
    (tmp_path / "wx.csv").write_text(
        "Date/Time (LST),Temp (°C),Rel Hum (%),Precip. Amount (mm),Precip. Amount Flag,Wind Dir (10s deg),Wind Spd (km/h),project_city,project_station_id,project_station_name\n"
        + "".join(f"2024-01-01 {h:02d}:00,1.5,50,{'1.0' if h else ''},,27,5,Barrie,42183,BARRIE\n" for h in range(24))
    )
    wx = landed.weather(read_csv(spark, str(tmp_path / "wx.csv"), normalise=True))
    day = daily_weather(wx).first()
    assert (day["city"], day["precip_total"], day["valid_hours"], day["wind_speed_mean"]) == ("Barrie", 23.0, 24, 5.0)
    (tmp_path / "evac.csv").write_text(
        "event_id,community,nearby_project_city,evacuation_start_date,evacuation_end_date,event_status,status_as_of_date,source_name,source_url\n"
        "EVAC-001,Armstrong,Thunder Bay,2026-07-13,,Ongoing,2026-08-04,CBC News,https://www.cbc.ca/1\n"
        "EVAC-001,Armstrong,Thunder Bay,2026-07-13,2026-08-06,Lifted,2026-08-07,CBC News,https://www.cbc.ca/2\n"
        "EVAC-002,Place,Not applicable,13 July,,Ongoing,2026-08-04,CBC News,https://www.cbc.ca/3\n"
    )
    log = landed.evacuations(read_csv(spark, str(tmp_path / "evac.csv")))
    facts = as_set(evacuation_facts(log, dim_city(spark)).select("event_id", "city_id", "start_date", "status"))
    assert facts == [("EVAC-001", 3, dt.date(2026, 7, 13), "Lifted"), ("EVAC-002", None, None, "Ongoing")]
    (tmp_path / "air.csv").write_text(
        "row_id,date,time,aqhi,category,city,station_name,station_id,requested_year,value_type,show_day_code\n"
        "1,2024-01-05,4:00 pm EST,10+,very high risk,Barrie,Barrie,47045,2024,daily_4pm,0\n2,2024-01-06,4:00 pm EST,NaN,,Barrie,Barrie,47045,2024,daily_4pm,0\n"
    )
    air = landed.history(read_csv(spark, str(tmp_path / "air.csv")))
    assert as_set(air.select("date", "aqhi_numeric", "aqhi_is_10_plus")) == [(dt.date(2024, 1, 5), 10.0, True), (dt.date(2024, 1, 6), None, False)]
    hot = landed.hotspots(spark.sql("select 'a' as uid, '2024-07-01 05:00:00' as rep_date, '44.1' as lat, 'x' as lon"))
    assert as_set(hot.select("date", "lat", "lon")) == [(dt.date(2024, 7, 1), 44.1, None)]
    now = landed.current(spark.sql("select 'x' as id, '2024-07-01T05:00:00Z' as observation_datetime"))
    assert now.first()["observation_datetime"] == dt.datetime(2024, 7, 1, 5)
    assert landed.fires(spark.sql("select '1' as OBJECTID")).first()["OBJECTID"] == 1
