import datetime as dt
import random
from collections import Counter

from conftest import as_set
from pyspark.sql import functions as F

from airshed.operators import evacuation, rules, spans
from airshed.plans.dimensions import dim_city

D = dt.date
DDL = "community string, city string, start_date date, end_date date, status string, status_as_of_date date"


def last_day(r):
    if r[3]:
        return r[3]
    return max(r[5], r[2]) if r[4] == "Ongoing" else r[2]


def events(n=400, seed=2):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        place = "hot" if rnd.random() < 0.34 else f"c{rnd.randrange(8)}"
        start = D(2026, 1, 1) + dt.timedelta(rnd.randrange(200))
        end = start + dt.timedelta(rnd.randrange(-1, 6)) if rnd.random() < 0.6 else None
        out.append((place, f"city{rnd.randrange(3)}", start, end, rnd.choice(["Ongoing", "Lifted", "Unknown"]), start + dt.timedelta(rnd.randrange(-2, 9))))
    return out


def test_open_events_per_day(spark):
    data = events()
    want = Counter()
    for r in data:
        for k in range((last_day(r) - r[2]).days + 1):
            want[(r[1], r[2] + dt.timedelta(k))] += 1
    days = spark.sql("select explode(sequence(date'2025-12-01', date'2026-12-31')) as date_id")
    got = evacuation.open_per_day(spark.createDataFrame(data, DDL), days)
    assert {(r["city"], r["date"]): r["open_events"] for r in got.collect()} == dict(want)
    few = days.where("dayofyear(date_id) % 7 = 0")
    got = evacuation.open_per_day(spark.createDataFrame(data, DDL), few)
    assert {(r["city"], r["date"]): r["open_events"] for r in got.collect()} == {k: n for k, n in want.items() if k[1].timetuple().tm_yday % 7 == 0}


def test_an_end_far_away_gives_no_more_rows_than_the_calendar(spark):
    """And a long event is a handful of spans."""
    df = spark.sql(
        "select 'e' as event_id, 'x' as community, 'c' as city, date'2026-01-05' as start_date, date'9999-12-31' as end_date, 'Lifted' as status,"
        " date'2026-01-06' as status_as_of_date union all select 'f', 'x', 'c', date'1960-03-01', date'2026-01-07', 'Lifted', null"
    )
    days = spark.sql("select explode(sequence(date'2026-01-01', date'2026-01-31')) as date_id")
    got = [(r["event_id"], r["date"].day) for r in evacuation.annotations(df, days).collect()]
    assert sorted(got) == [("e", d) for d in range(5, 32)] + [("f", d) for d in range(1, 8)]
    assert evacuation.open_per_day(df, days).agg(F.sum("open_events")).first()[0] == 27 + 7
    assert spans.cover(df, "start_date", "end_date").count() < 2 * 2 * spans.LEVELS
    assert {r["event_id"] for r in spans.on_days(df.where("event_id = 'e'"), "start_date", "start_date", days, "date_id").collect()} == {"e"}


def test_episodes_cover_exactly_the_event_days(spark):
    data = events()
    days, count = {}, Counter()
    for r in data:
        if last_day(r) >= r[2]:
            count[r[0]] += 1
            days.setdefault(r[0], set()).update(r[2] + dt.timedelta(k) for k in range((last_day(r) - r[2]).days + 1))
    got = evacuation.episodes(spark.createDataFrame(data, DDL)).collect()
    seen, total = {}, Counter()
    for r in got:
        span = {r["episode_start"] + dt.timedelta(k) for k in range((r["episode_end"] - r["episode_start"]).days + 1)}
        mine = seen.setdefault(r["community"], set())
        # no overlap, and not even next to another episode
        assert not mine & (span | {min(span) - dt.timedelta(1), max(span) + dt.timedelta(1)})
        mine |= span
        total[r["community"]] += r["event_count"]
    assert seen == days and total == count


def log(spark, planted):
    base = {
        "event_id": "EVAC-001", "community": "Armstrong", "nearby_project_city": "Thunder Bay", "evacuation_start_date": "2026-07-13",
        "evacuation_end_date": None, "status": "Ongoing", "status_as_of_date": "2026-08-04", "source_name": "CBC News",
        "source_url": "https://www.cbc.ca/news/1",
    }
    data = []
    for i, change in enumerate([{}] * 6 + planted):
        data.append({**base, "event_id": f"EVAC-{i + 1:03d}", "community": f"Place {i}", **change})
    ddl = ", ".join(f"{k} string" for k in base)
    return spark.createDataFrame([tuple(r.values()) for r in data], ddl).withColumns(
        {
            "start_date": F.try_to_date("evacuation_start_date", "yyyy-MM-dd"),
            "end_date": F.try_to_date("evacuation_end_date", "yyyy-MM-dd"),
        }
    )


def test_planted_violations_are_reported_once_each(spark):
    planted = [
        {"event_id": "EVAC-1"}, {"event_id": "EVAC-002"}, {"evacuation_start_date": "13 July"}, {"evacuation_end_date": "Ongoing"},
        {"status": "Ended"}, {"nearby_project_city": "Ottawa"}, {"nearby_project_city": None}, {"source_url": None},
        {"source_url": "https://news.yahoo.com/x"}, {"source_url": "see CBC"}, {"community": "Place 0"},
        {"evacuation_end_date": "2026-07-12", "status": "Lifted"}, {"status": "Lifted"}, {"evacuation_end_date": "2026-07-20"},
        {"evacuation_start_date": "2025-12-31"}, {"evacuation_start_date": "2026-08-05"}, {"event_id": None}, {"status": None}, {"community": "place 3", "evacuation_start_date": "2026-07-14"},
    ]
    report = rules.evacuation_rules(log(spark, planted), "2026-08-04")
    assert Counter(r["rule_id"] for r in report.collect()) == Counter(
        {
            "Q8_id_format": 2, "Q8_id_unique": 1, "Q9_start_date": 1, "Q9_end_date": 1, "Q10_status": 2, "Q11_city": 2, "Q12_url_missing": 1,
            "Q12_url_host": 2, "Q13_community_start": 1, "Q14_end_before_start": 1, "Q14_lifted_without_end": 1,
            "Q14_ongoing_with_end": 2, "Q15_outside_window": 2, "Q15_spelling": 1,
        }
    )
    assert rules.evacuation_rules(log(spark, []), "2026-08-04").isEmpty()


def test_facts_link_a_city_where_one_is_named(spark):
    df = log(spark, [{"nearby_project_city": "Not applicable"}])
    facts = evacuation.evacuation_facts(df, dim_city(spark))
    assert as_set(facts.groupBy("city_id").count()) == sorted([(3, 6), (None, 1)], key=repr)
    assert facts.columns == ["event_id", "city_id", "location_name", "start_date", "end_date", "status", "source", "last_verified_date"]


def test_dimension_and_weather_rules(spark):
    stations = spark.sql(
        "select * from values (1, 'a', 'n', 'aqo', 1, 45D, -80D), (1, 'b', 'n', 'aqo', 9, 45D, -80D), (2, 'b', null, 'aqo', 2, 91D, -181D),"
        " (3, 'b', 'n', 'other', null, null, -80D) as t(station_id, source_station_id, station_name, source_system, city_id, latitude, longitude)"
    )
    got = Counter(r["rule_id"] for r in rules.dimension_rules(stations, dim_city(spark)).collect())
    assert got == Counter(
        ["Q1_station_id", "Q1_source_station", "Q2_station_name", "Q2_city_id", "Q2_latitude", "Q3_latitude", "Q3_longitude", "Q4_source_system", "Q5_city"]
    )
    wx = spark.sql(
        "select * from values (1, 10, 'a', 99D, 50D, 1D, 36D, 0D), (2, 10, 'b', 1D, -1D, -1D, 37D, -0.1D), (3, 11, 'c', null, null, null, null, null)"
        " as t(row_id, station_id, station_name, temp, rh, wind_speed, wind_dir_10s_deg, precip)"
    )
    got = Counter(r["rule_id"] for r in rules.weather_rules(wx, F.col("row_id")).collect())
    assert got == Counter(["Q6_temp", "Q6_rh", "Q6_wind_speed", "Q6_wind_dir_10s_deg", "Q6_precip_negative", "Q7_station_identity"])


def test_one_row_per_event_with_its_latest_state(spark):
    df = log(spark, [{"event_id": "EVAC-001", "status": "Lifted", "status_as_of_date": "2026-08-09"}, {"event_id": None}])
    facts = evacuation.evacuation_facts(df, dim_city(spark))
    assert facts.count() == 6
    assert as_set(facts.where("event_id = 'EVAC-001'").select("status", "last_verified_date")) == [("Lifted", "2026-08-09")]


def test_city_and_calendar_rules(spark):
    cities = spark.sql("select * from values (1, 'a', 45D, -80D), (1, 'b', 95D, -80D), (null, 'a', null, 190D) as t(city_id, city_name, latitude, longitude)")
    assert Counter(r["rule_id"] for r in rules.city_rules(cities).collect()) == Counter(
        ["Q1_city_id", "Q1_city_name", "Q2_city_city_id", "Q2_city_latitude", "Q3_city_latitude", "Q3_city_longitude"]
    )
    days = spark.sql("select * from values (date'2024-01-01'), (date'2024-01-01'), (null) as t(date_id)")
    assert Counter(r["rule_id"] for r in rules.date_rules(days).collect()) == Counter(["Q1_date_id", "Q2_date_date_id"])


def test_an_incomplete_fact_is_reported(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-20')) as date_id")
    fact = days.where("day(date_id) > 15").selectExpr(
        "1 as city_id", "date_id", "cast(null as double) as aqhi_daily_4pm", "cast(null as double) as aqhi_daily_max", "true as aqhi_data_available",
        "0 as hotspots_within_100km", "1D as nearest_hotspot_distance_km", "true as fire_data_available", "cast(null as double) as temp_mean",
        "1D as precip_total", "true as weather_data_available",
    )
    got = Counter(r["rule_id"] for r in rules.fact_rules(fact, dim_city(spark), days).collect())
    assert got == Counter({"Q17_aqhi_unknown": 5, "Q17_weather_unknown": 5, "Q18_date_coverage": 4})
