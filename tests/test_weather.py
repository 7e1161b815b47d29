import datetime as dt

import pytest
from conftest import as_set, dicts
from pyspark.sql import functions as F

from airshed.operators import weather

DDL = (
    "row_id int, station_id int, station_name string, city string, date_time_lst timestamp_ntz, temp double, rh double, precip double, "
    "precip_flag string, wind_dir_10s_deg double, wind_speed double, wind_flag string"
)


def hours(n, start=dt.datetime(2024, 1, 1), **fields):
    base = {"temp": 1.0, "rh": 50.0, "precip": 0.0, "precip_flag": None, "wind_dir_10s_deg": 27.0, "wind_speed": 5.0, "wind_flag": None}
    out = []
    for i in range(n):
        v = {k: (f(i) if callable(f) else f) for k, f in {**base, **fields}.items()}
        out.append((i, 1, "S", "Kingston", start + dt.timedelta(hours=i), *v.values()))
    return out


def test_missing_classes(spark):
    wind = spark.sql(
        "select * from values (27D, 5D, null), (null, 0D, null), (null, 3D, null), (null, null, null), (9D, 1D, 'M') as t(d, s, f)"
    ).select(weather.wind_missing_class(F.col("d"), F.col("s"), F.col("f")).alias("c"))
    assert [r[0] for r in wind.collect()] == ["observed", "calm", "missing", "unknown", "flagged"]
    rain = spark.sql("select * from values (0D, null), (1D, null), (null, null), (-1D, null), (0D, 'M') as t(a, f)").select(
        weather.precip_class(F.col("a"), F.col("f")).alias("c")
    )
    assert [r[0] for r in rain.collect()] == ["zero", "positive", "blank", "invalid_negative", "flagged"]


def test_wind_is_averaged_as_a_vector(spark):
    df = spark.createDataFrame(hours(2, wind_dir_10s_deg=lambda i: (35.0, 1.0)[i]), DDL)
    r = weather.daily_weather(df).first()
    assert min(r["wind_dir_mean_deg"], 360 - r["wind_dir_mean_deg"]) == pytest.approx(0, abs=1e-6)
    opposed = spark.createDataFrame(hours(2, wind_dir_10s_deg=lambda i: (9.0, 27.0)[i]), DDL)
    assert weather.daily_weather(opposed).first()["wind_dir_mean_deg"] is None


def test_daily_features_keep_unknown_apart_from_zero(spark):
    df = spark.createDataFrame(hours(24, precip=None, temp=lambda i: None if i < 8 else float(i)), DDL)
    r = weather.daily_weather(df).first()
    assert r["precip_total"] is None and r["valid_hours"] == 16 and not r["weather_data_available"]
    assert (r["temp_min"], r["temp_max"], r["hourly_rows"]) == (8.0, 23.0, 24)
    assert r["temp_missing_pct"] == pytest.approx(100 / 3)
    dry = weather.daily_weather(spark.createDataFrame(hours(24), DDL)).first()
    assert dry["precip_total"] == 0.0 and dry["weather_data_available"]


def test_published_sample_month(spark):
    """744 hours, 30 without wind direction, 19 without wind speed."""
    df = spark.createDataFrame(
        hours(744, wind_dir_10s_deg=lambda i: None if i < 30 else 1.0, wind_speed=lambda i: None if i < 19 else 1.0), DDL
    ).withColumn("year", F.year("date_time_lst"))
    got = {r["field_name"]: round(r["missing_pct"], 2) for r in weather.missing_percent(df, ["city", "year"]).collect()}
    assert got == {"temp": 0.0, "rh": 0.0, "precip": 0.0, "wind_dir_10s_deg": 4.03, "wind_speed": 2.55}
    r = weather.expected_hours(df).first()
    assert (r["observed_hours"], r["expected_hours"], r["missing_hours"]) == (744, 744, 0)


def test_gaps_runs_and_repeats(spark):
    data = [r for r in hours(48) if r[0] not in (5, 6, 7, 30)] + hours(2)
    df = spark.createDataFrame(data, DDL)
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    assert as_set(weather.hour_gaps(df)) == [(1, t(4), t(8), 4), (1, t(29), t(31), 2)]
    assert as_set(weather.hour_gaps(df, threshold=2)) == [(1, t(4), t(8), 4)]
    assert as_set(weather.hour_runs(df)) == [(1, t(0), t(4), 5), (1, t(8), t(29), 22), (1, t(31), t(47), 17)]
    assert as_set(weather.duplicate_timestamps(df)) == [(1, t(0), 2), (1, t(1), 2)]


def test_fallback_and_primary_station(spark):
    df = spark.sql(
        "select * from values ('a', 1, 10, 1, cast(null as double)), ('a', 2, 20, 2, 5D), ('a', 3, 30, 3, 6D), ('b', 1, 10, 4, null)"
        " as t(city, priority, station_id, row_id, temp)"
    )
    assert as_set(weather.fallback_reading(df, ["city"], ["temp"], enabled=True)) == [("a", 5.0, 20), ("b", None, None)]
    assert as_set(weather.fallback_reading(df, ["city"], ["temp"], enabled=False)) == [("a", None, None), ("b", None, None)]
    cand = spark.sql(
        "select * from values (1, 'K', 'hourly', 'NAVCAN', 1D, true), (2, 'K', 'hourly', 'ECCC-MSC', 9D, true),"
        " (3, 'K', 'daily', 'ECCC-MSC', 0D, true), (4, 'K', 'hourly', 'ECCC-MSC', 2D, false), (5, 'K', 'hourly', 'ECCC-MSC', 9D, true)"
        " as t(station_id, city, interval, operator, distance_km, has_wind)"
    ).selectExpr("*", "date'2020-01-01' as first_date", "date'2027-01-01' as last_date")
    r = dicts(weather.primary_station(cand, "2024-01-01", "2026-07-31", ["has_wind"]))
    assert r == [{"city": "K", "station_id": 2, "operator": "ECCC-MSC", "distance_km": 9.0, "fit_candidates": 3}]


def test_clock_changes_leave_standard_time_alone(spark):
    """2024-03-10 has 23 civil hours and 2024-11-03 has 25; standard time always has 24."""
    data = hours(48, dt.datetime(2024, 3, 10)) + [r for r in hours(24, dt.datetime(2024, 11, 3)) if r[0] != 2]
    df = spark.createDataFrame(data, DDL)
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "America/Toronto"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = sorted(as_set(weather.clock_change_days(df)))
        spark.conf.set("spark.sql.session.timeZone", before)
        assert got == [(1, dt.date(2024, 3, 10), 24, 23, True), (1, dt.date(2024, 11, 3), 23, 25, False)]
    cover = weather.station_coverage(df).first()
    assert (cover["row_count"], cover["days_with_rows"]) == (71, 3)


def test_repeated_hours_and_impossible_amounts_add_nothing(spark):
    clean = spark.createDataFrame(hours(24, precip=1.0), DDL)
    twice = clean.union(clean).unionByName(
        spark.createDataFrame(hours(1, precip=-9.0), DDL)).unionByName(spark.createDataFrame(hours(1, precip=99.0, precip_flag="M"), DDL))
    a, b = (weather.daily_weather(x).first().asDict() for x in (clean, twice))
    assert (a.pop("repeated_rows"), b.pop("repeated_rows")) == (0, 26)
    assert a == b and a["precip_total"] == 24.0


def test_one_station_of_a_city_at_a_time(spark):
    """The primary's 24 mm, not the sum of two stations; a fallback fills what the primary lacks and is named."""
    primary = [(*r[:1], 47267, *r[2:]) for r in hours(24, precip=1.0, temp=lambda i: None if i < 3 else 20.0)]
    second = [(*r[:1], 947267, *r[2:]) for r in hours(24, precip=1.0, temp=10.0)]
    third = [(*r[:1], 5, *r[2:]) for r in hours(30, precip=7.0, temp=-5.0)]
    df = spark.createDataFrame(primary + second + third, DDL)
    got = weather.daily_weather(df).orderBy("date").collect()
    assert got[0]["precip_total"] == 24.0 and got[0]["temp_min"] == 10.0 and got[0]["temp_mean"] == pytest.approx((3 * 10 + 21 * 20) / 24)
    assert (got[0]["fallback_stations"], got[0]["fallback_hours"], got[0]["unranked_rows"], got[0]["repeated_rows"]) == ("947267", 3, 24, 0)
    assert (got[1]["precip_total"], got[1]["fallback_stations"], got[1]["hourly_rows"]) == (42.0, "5", 6)
    strict = weather.daily_weather(df, fallback=False).collect()
    assert len(strict) == 1 and strict[0]["valid_hours"] == 21 and strict[0]["fallback_stations"] == ""
    other = spark.createDataFrame([(5, 1), (947267, 2)], "station_id int, rank int")
    assert weather.daily_weather(df, ranks=other).orderBy("date").first()["precip_total"] == 7.0 * 24
    two = spark.createDataFrame([(*r[:1], s, *r[2:]) for r in hours(24, precip=1.0) for s in (8, 9)], DDL)
    assert weather.daily_weather(two).first()["precip_total"] == 24.0 and weather.daily_weather(two).first()["unranked_rows"] == 48
