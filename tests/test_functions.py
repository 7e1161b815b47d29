from datetime import date, datetime

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from airshed.functions import geo, moments, text


def test_column_names():
    headers = [("Date", "Date"), ("Unnamed: 1_level_0", "AQHI"), "AQHI", "", "  Wind Dir (10s deg) "]
    assert text.snake_names(headers, number_repeats=True) == [
        "date", "aqhi", "aqhi_2", "unnamed_column", "wind_dir_10s_deg",
    ]
    assert text.snake_names(["Date/Time (LST)", "A", "A"]) == ["date_time_lst", "a", "a"]
    assert text.columns_with(["date_time_lst", "wind_dir", "date"], "date", "time") == ["date_time_lst"]


def test_strict_date():
    assert moments.strict_date("2026-07-20") == date(2026, 7, 20)
    with pytest.raises(ValueError):
        moments.strict_date("20-07-2026")


def test_instants_do_not_depend_on_the_session_zone(spark):
    df = spark.sql(
        "select * from values ('2024-07-01', '4:00 pm EST', '1785449040123'), ('2024-07-01', '12:05 am EDT', 'bad'), "
        "('x', '4:00 pm EDT', null), ('2024-01-31', 'noon', ' 0 ') as t(d, t, ms)"
    )
    picked = df.select(
        moments.clock_to_utc(moments.parse_date(F.col("d")), F.col("t")).alias("a"),
        moments.epoch_ms_to_utc(F.col("ms")).alias("b"),
        moments.parse_utc(F.lit("2026-07-01T05:00:00Z")).alias("c"),
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    results = []
    for zone in ("UTC", "America/Toronto", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        results.append(as_set(picked))
    spark.conf.set("spark.sql.session.timeZone", before)
    assert results[0] == results[1] == results[2]
    assert (datetime(2024, 7, 1, 21), datetime(2026, 7, 30, 22, 4, 0, 123000), datetime(2026, 7, 1, 5)) in results[0]
    assert (datetime(2024, 7, 1, 4, 5), None, datetime(2026, 7, 1, 5)) in results[0]
    assert (None, datetime(1970, 1, 1), datetime(2026, 7, 1, 5)) in results[0]


def test_local_standard_time_and_civil_days(spark):
    df = spark.sql("select timestamp_ntz'2024-07-10 23:30:00' as t, timestamp_ntz'2024-01-10 23:30:00' as w")
    utc = df.select(
        moments.lst_to_utc(F.col("t"), F.lit(-5)).alias("t"), moments.lst_to_utc(F.col("w"), F.lit(-5)).alias("w")
    )
    row = utc.select("t", moments.civil_date(F.col("t")), moments.civil_date(F.col("w"))).first()
    assert tuple(row) == (datetime(2024, 7, 11, 4, 30), date(2024, 7, 11), date(2024, 1, 10))


def test_scalars(spark):
    row = spark.range(1).select(
        moments.iso_weekday(F.lit(date(2024, 1, 7))),
        moments.hour_index(F.expr("timestamp_ntz'1970-01-02 03:59:59'")),
        F.expr(text.number_sql("'12.5'")),
        F.expr(text.number_sql("'10+'")),
        text.file_label(F.lit("Thunder Bay"), F.lit(30682), F.lit(date(2024, 3, 1))),
        text.url_host(F.lit("https://www.CBC.ca/news?x=1")),
        text.url_host(F.lit("cbc.ca/news")),
        text.thousands(F.lit(313930.0)),
        moments.stamp_label(F.expr("timestamp_ntz'2026-07-31 04:59:31'")),
        F.round(geo.degrees_minutes(F.lit(-79), F.lit(33)), 4),
    ).first()
    assert list(row) == [
        7, 27, 12.5, None, "thunder_bay_30682_2024_03.csv", "www.cbc.ca", None, "313,930.0", "20260731T045931Z", -79.55,
    ]


def test_distance(spark):
    km = spark.range(1).select(
        geo.haversine_km(44.3894, -79.6903, 43.6532, -79.3832), geo.haversine_km(0, 0, 0, 180), geo.haversine_km(10, 10, 10, 10)
    ).first()
    assert km[0] == pytest.approx(85.4, abs=0.3)
    assert km[1] == pytest.approx(20015.1, abs=0.1)
    assert km[2] == 0


def test_shared_folder_is_the_one_the_cluster_names(spark):
    from types import SimpleNamespace as Fake

    from airshed.session import settle, shared_dir

    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    five = settle(spark.range(5), "five")
    assert five.count() == 5 and shared_dir(spark) in five.inputFiles()[0]

    def unset(master):
        return Fake(conf=Fake(get=lambda key, default: default), sparkContext=Fake(master=master, applicationId=master))

    assert shared_dir(unset("local[2]")) == shared_dir(unset("local[2]"))
    with pytest.raises(RuntimeError):
        shared_dir(unset("yarn"))


def test_only_decimal_digits_are_numbers(spark):
    rows = spark.sql("select * from values ('1'), ('-1.5e3'), ('.5'), ('5.'), ('NaN'), ('1d'), ('7f'), ('Infinity'), ('0x1'), (''), (null) as t(x)")
    got = [r[0] for r in rows.select(F.expr(text.number_sql("x"))).collect()]
    assert got == [1.0, -1500.0, 0.5, 5.0] + [None] * 7
