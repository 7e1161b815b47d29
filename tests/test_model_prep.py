import datetime as dt
import math

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from airshed.plans import model_prep

START = dt.date(2024, 1, 1)


def panel(spark, values, city=1):
    """One row per value; the value "-" leaves the whole day out."""
    data = [(city, START + dt.timedelta(i), v) for i, v in enumerate(values) if v != "-"]
    return spark.createDataFrame(data, "city_id int, date_id date, y double")


def by_day(df, column):
    return {(r["date_id"] - START).days: r[column] for r in df.collect()}


def test_lags_follow_the_calendar(spark):
    p = panel(spark, [1.0, 2.0, "-", 4.0, None, 6.0])
    assert by_day(model_prep.next_day_target(p), "y_next") == {0: 2.0, 1: None, 3: None, 4: 6.0, 5: None}
    assert by_day(model_prep.persistence(p), "y_hat") == {0: None, 1: 1.0, 3: None, 4: 4.0, 5: None}


def test_moving_average_needs_enough_days(spark):
    p = panel(spark, [1.0, 2.0, 3.0, "-", 5.0, None, 7.0])
    got = by_day(model_prep.moving_average(p, days=3, minimum=2), "y_hat")
    assert got == {0: None, 1: None, 2: 1.5, 4: 2.5, 5: 4.0, 6: None}


def test_lookback_windows_are_full_and_in_order(spark):
    p = panel(spark, [1.0, 2.0, 3.0, 4.0, None, 6.0, 7.0, 8.0, "-", 10.0]).orderBy(F.rand(1)).repartition(3)
    got = by_day(model_prep.lookback_windows(p, "y", 3), "lookback")
    assert got == {2: [1.0, 2.0, 3.0], 3: [2.0, 3.0, 4.0], 7: [6.0, 7.0, 8.0]}


def test_scores_and_bands(spark):
    f = spark.sql("select * from values (1, 'm', 2D, 1D), (1, 'm', 8D, 11D), (1, 'm', null, 3D), (1, 'm', 3D, null) as t(city_id, model, y, y_hat)")
    r = model_prep.score(f).first()
    assert (r["mae"], r["days"]) == (2.0, 2) and r["rmse"] == pytest.approx(math.sqrt(5))
    bands = [r[0] for r in spark.sql("select * from values (1D), (3.9D), (4D), (7D), (10D), (10.5D), (null) as t(v)").select(model_prep.band(F.col("v"))).collect()]
    assert bands == ["low risk", "low risk", "moderate risk", "high risk", "high risk", "very high risk", None]


@pytest.mark.parametrize("method", ["zscore", "minmax"])
def test_scaling_sees_training_rows_only(spark, method):
    p = panel(spark, [1.0, 2.0, 3.0, 100.0])
    split = model_prep.time_split(p, F.lit(START + dt.timedelta(2)))
    got = by_day(model_prep.scale(split, ["y"], method=method), "y_scaled")
    want = {"zscore": [-1.0, 0.0, 1.0, 98.0], "minmax": [0.0, 0.5, 1.0, 49.5]}[method]
    assert [got[i] for i in range(4)] == pytest.approx(want)
    flat = model_prep.time_split(panel(spark, [5.0, 5.0]), F.lit(START + dt.timedelta(9)))
    assert set(by_day(model_prep.scale(flat, ["y"], method=method), "y_scaled").values()) == {None}


def test_lag_correlation(spark):
    p = panel(spark, [float(i * i % 7) for i in range(40)])
    x = p.select("city_id", F.date_sub("date_id", 2).alias("date_id"), F.col("y").alias("x"))
    got = model_prep.lag_correlation(p.join(x, ["city_id", "date_id"], "left"), ["x"], [0, 2])
    r = {row["lag_days"]: (row["correlation"], row["pairs"]) for row in got.collect()}
    assert r[2][0] == pytest.approx(1.0) and r[2][1] == 38 and abs(r[0][0]) < 0.9


def test_model_input_is_an_allow_list(spark):
    cols = [
        *model_prep.KEYS, *model_prep.FEATURES, *model_prep.TARGETS, "aqhi_data_available", "fire_data_available", "weather_data_available",
        "evac_open_events", "ref_active_fires",
    ]
    fact = spark.createDataFrame([], ", ".join(f"{c} {'boolean' if c.endswith('available') else 'double'}" for c in cols))
    for df in (model_prep.series(fact), model_prep.training_rows(fact, "aqhi_daily_max")):
        assert not [c for c in df.columns if c.startswith(("evac_", "ref_"))] and "y" in df.columns
        assert not set(model_prep.TARGETS) & set(df.columns)
    with pytest.raises(ValueError):
        model_prep.series(fact, "temp_mean")
    assert as_set(model_prep.training_rows(fact)) == []
