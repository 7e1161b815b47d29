import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import as_set, dicts
from pyspark.sql import functions as F

from airshed.operators import aqhi

DDL = (
    "row_id bigint, station_id int, station_name string, city string, requested_year int, value_type string, "
    "date date, time string, aqhi string, category string"
)


def row(i, date, aqhi_text="3", time="4:00 pm EST", value_type="daily_max", year=2024, station=47045, category="low risk"):
    return (i, station, f"S{station}", "Barrie", year, value_type, date, time, aqhi_text, category)


def frame(spark, data):
    return aqhi.censored(spark.createDataFrame(data, DDL))


def test_censored_values(spark):
    d = dt.date(2024, 1, 1)
    data = [row(i, d, v) for i, v in enumerate(["10+", " 10+ ", "3", "2.0", "n/a", None, "+"])]
    got = {r["row_id"]: (r["aqhi_raw"], r["aqhi_is_10_plus"], r["aqhi_numeric"]) for r in dicts(frame(spark, data))}
    assert got == {
        0: ("10+", True, 10.0), 1: ("10+", True, 10.0), 2: ("3", False, 3.0), 3: ("2.0", False, 2.0),
        4: ("n/a", False, None), 5: (None, None, None), 6: ("+", False, None),
    }
    assert sorted((r["row_id"], r["reason"]) for r in aqhi.missing_and_capped(frame(spark, data)).collect()) == [
        (0, "10+"), (1, "10+"), (5, "missing"),
    ]


def planted(first=dt.date(2024, 1, 1), days=366, gaps=(10, 50, 200), extra=1):
    """A clean daily series in which the day before each planted date moves onto that date."""
    data, i = [], 0
    for k in range(days):
        date = first + dt.timedelta(k)
        if k + 1 in gaps:
            continue
        copies = 1 + extra if k in gaps else 1
        for _ in range(copies):
            data.append(row(i, date, str(i % 9 + 1), f"{i % 12 + 1}:00 am EST"))
            i += 1
    return data


def test_planted_boundary_anomalies_are_found_exactly(spark):
    data = planted()
    # Year boundary: Jan 1 doubled, but the day before lies in another year. Also doubled with the
    # day before present, and a missing day without a doubled one.
    data += [row(9000, dt.date(2024, 1, 1)), row(9001, dt.date(2024, 6, 30)), row(9002, None), row(9003, None)]
    data = [r for r in data if r[6] != dt.date(2024, 9, 9)]
    report = aqhi.daily_max_date_anomalies(frame(spark, data))
    got = {(r["missing_previous_date"], r["duplicated_reported_date"], r["records_on_duplicated_date"]) for r in report.collect()}
    first = dt.date(2024, 1, 1)
    assert got == {(first + dt.timedelta(k - 1), first + dt.timedelta(k), 2) for k in (10, 50, 200)}
    again = aqhi.daily_max_date_anomalies(frame(spark, data).orderBy(F.rand(1)).repartition(5))
    assert as_set(report) == as_set(again)
    assert aqhi.date_anomaly_flags(frame(spark, data)).count() == 6


@pytest.mark.parametrize("extra", [3, 1001])
def test_a_date_lists_every_record(spark, extra):
    data = [(5000 * r[0], *r[1:]) for r in planted(days=30, gaps=(10, 20), extra=extra)]
    report = dicts(aqhi.daily_max_date_anomalies(frame(spark, data)))
    assert {r["duplicated_reported_date"].day for r in report} == {11, 21} and len(report) == (2 if extra < 1000 else len(report))
    short = dicts(aqhi.daily_max_date_anomalies(frame(spark, data), line_records=100))
    for lines in (report, short):
        for day in (11, 21):
            mine = sorted((r for r in lines if r["duplicated_reported_date"].day == day), key=lambda r: r["line_no"])
            assert {r["records_on_duplicated_date"] for r in mine} == {extra + 1}
            own = [(x[7] or "<NA>", x[8] or "<NA>") for x in sorted(data) if x[6] == mine[0]["duplicated_reported_date"]]
            parts = [list(zip(r["reported_times"].split(" | "), r["reported_aqhi_values"].split(" | "))) for r in mine]
            assert sum(parts, []) == own
            assert lines is report or max(map(len, parts)) <= 200


def test_equal_records_are_listed_each(spark):
    data = [row(k, dt.date(2024, 1, 5), "3") for k in range(3)]
    r = aqhi.daily_max_date_anomalies(frame(spark, data)).first()
    assert (r["records_on_duplicated_date"], r["reported_aqhi_values"], r["line_no"]) == (3, "3 | 3 | 3", 1)


def test_missing_readings_print_a_mark(spark):
    data = [row(0, dt.date(2024, 1, 5), None, None), row(1, dt.date(2024, 1, 5), "4")]
    r = aqhi.daily_max_date_anomalies(frame(spark, data)).first()
    assert (r["reported_times"], r["reported_aqhi_values"]) == ("<NA> | 4:00 pm EST", "<NA> | 4")


def test_dedup_keeps_the_first_and_counts_the_rest(spark):
    d = dt.date(2024, 1, 1)
    data = [row(3, d), row(1, d), row(2, d), row(4, d, None), row(5, d, None), row(6, d, "4")]
    got = aqhi.dedup_exact(frame(spark, data), ["date", "time", "aqhi_raw", "station_id", "value_type"])
    assert sorted((r["row_id"], r["removed_copies"]) for r in got.collect()) == [(1, 2), (4, 1), (6, 0)]


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_conflicts_leave_the_numeric_series_only(spark, hot_rows):
    d = dt.date(2025, 3, 25)
    e = dt.date(2025, 3, 26)
    data = [
        row(1, d, "3", "4:00 pm EDT"), row(2, d, "2", "4:00 pm EDT"), row(3, e, "2"), row(4, e, "2"), row(5, e, "7", "5:00 pm EST"),
        row(6, e, "8", "5:00 pm EST", category="high risk"), row(7, None, "1", None), row(8, None, "2", None),
    ]
    got = aqhi.conflict_quarantine(frame(spark, data), hot_rows=hot_rows)
    assert sorted((r["row_id"], r["source_value_conflict"], r["series_value"], r["series_category"]) for r in got.collect()) == [
        (1, True, None, "low risk"), (2, True, None, "low risk"), (3, False, 2.0, "low risk"), (4, False, 2.0, "low risk"),
        (5, True, None, None), (6, True, None, None), (7, True, None, "low risk"), (8, True, None, "low risk"),
    ]


def test_station_and_city_days(spark):
    d = dt.date(2024, 7, 1)
    data = [
        row(1, d, "3", "1:00 am EDT"), row(2, d, "10+", "2:00 pm EDT"), row(3, d, "9", "3:00 pm EDT"), row(4, d, "8", "3:00 pm EDT"),
        row(5, d, "4", value_type="daily_4pm"), row(6, d, "4", "4:00 pm EDT", value_type="daily_4pm"),
        row(7, d, "5", value_type="daily_4pm", station=2), row(8, d, "6", "4:00 pm EDT", value_type="daily_4pm", station=2),
        row(9, d, "6", value_type="daily_max", station=2),
    ]
    days = aqhi.station_daily(frame(spark, data))
    got = {(r["station_id"], r["value_type"]): (r["value"], r["is_10_plus"], r["conflicting_times"]) for r in days.collect()}
    assert got == {
        (47045, "daily_max"): (10.0, True, 1), (47045, "daily_4pm"): (4.0, False, 0), (2, "daily_4pm"): (None, None, 0),
        (2, "daily_max"): (6.0, False, 0),
    }
    mean = {r["value_type"]: (r["aqhi"], r["any_10_plus"], r["station_count"]) for r in aqhi.city_daily(days).collect()}
    assert mean == {"daily_max": (8.0, True, 2), "daily_4pm": (4.0, False, 1)}
    top = {r["value_type"]: r["aqhi"] for r in aqhi.city_daily(days, "max").collect()}
    assert top["daily_max"] == 10.0
    spread = aqhi.station_spread(days).first()
    assert (spread["days"], spread["max_spread"]) == (1, 4.0)


def test_distribution_matches_sorted_values(spark):
    rnd = random.Random(3)
    values = [rnd.randrange(1, 11) for _ in range(501)]
    data = [row(i, dt.date(2024, 1, 1), str(v)) for i, v in enumerate(values)]
    r = aqhi.value_distribution(frame(spark, data), ["station_id"], "aqhi_numeric").first()
    values.sort()
    assert [r["values"], r["lowest"], r["lower_quartile"], r["median"], r["upper_quartile"], r["highest"]] == [
        501, values[0], values[125], values[250], values[375], values[-1],
    ]


def test_hourly_rebuild_uses_the_civil_day(spark):
    df = spark.sql(
        "select * from values ('a', timestamp_ntz'2024-07-01 20:00:00', 5D), ('a', timestamp_ntz'2024-07-02 03:00:00', 9D), "
        "('a', timestamp_ntz'2024-07-02 20:00:00', null) as t(loc, at, v)"
    )
    got = as_set(aqhi.daily_from_hourly(df, ["loc"], "at", "v"))
    assert got == [("a", dt.date(2024, 7, 1), 9.0, 5.0, 2), ("a", dt.date(2024, 7, 2), None, None, 0)]
    capped = aqhi.capped_like_history(spark.sql("select * from values (11D), (10D), (cast(null as double)) as t(aqhi)"))
    assert as_set(capped) == sorted([(11.0, True, 10.0), (10.0, False, 10.0), (None, None, None)], key=repr)
