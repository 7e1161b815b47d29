"""From the fact to model input: targets, baselines, windows, scaling, scores.

Works on one row per city and day. Every window is per city over that city's calendar, and every
lag is a join on date arithmetic, so a missing day never shifts a value to the wrong date.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TARGETS = ("aqhi_daily_4pm", "aqhi_daily_max")
FEATURES = [
    "hotspots_within_100km",
    "hotspots_within_250km",
    "hotspots_within_500km",
    "nearest_hotspot_distance_km",
    "temp_mean",
    "temp_min",
    "temp_max",
    "precip_total",
    "wind_speed_mean",
    "wind_dir_mean_deg",
]
KEYS = ["city_id", "date_id"]


def series(fact: DataFrame, target: str = "aqhi_daily_4pm") -> DataFrame:
    """Keys, allow-listed features and the configured target as ``y``."""
    if target not in TARGETS:
        raise ValueError(f"target must be one of {TARGETS}")
    return fact.select(*KEYS, *FEATURES, F.col(target).alias("y"))


def training_rows(fact: DataFrame, target: str = "aqhi_daily_4pm") -> DataFrame:
    """Rows with all three sources available and a target."""
    eligible = fact.where(
        F.col("aqhi_data_available")
        & F.col("fire_data_available")
        & F.col("weather_data_available")
    )
    return series(eligible, target).where(F.col("y").isNotNull())


def shifted(panel: DataFrame, columns: dict[str, str], days: int) -> DataFrame:
    """Join each row with the row ``days`` later (earlier when negative); absent days give null."""
    other = panel.select(
        "city_id",
        F.date_sub("date_id", days).alias("date_id"),
        *[F.col(old).alias(new) for old, new in columns.items()],
    )
    return panel.join(other, KEYS, "left")


def next_day_target(panel: DataFrame) -> DataFrame:
    return shifted(panel, {"y": "y_next"}, 1)


def persistence(panel: DataFrame) -> DataFrame:
    """Forecast for a day: the value of the day before."""
    return shifted(panel, {"y": "y_hat"}, -1).select(*KEYS, "y", "y_hat")


def day_number(d: str = "date_id") -> Column:
    return F.datediff(F.col(d), F.lit(date(1970, 1, 1)))


def moving_average(panel: DataFrame, days: int = 7, minimum: int = 4) -> DataFrame:
    """Mean of the ``days`` days before, where at least ``minimum`` of them have a value."""
    span = W.partitionBy("city_id").orderBy(day_number()).rangeBetween(-days, -1)
    return panel.select(
        *KEYS,
        "y",
        F.when(F.count("y").over(span) >= minimum, F.avg("y").over(span)).alias("y_hat"),
    )


def lookback_windows(panel: DataFrame, column: str = "y", length: int = 7) -> DataFrame:
    """Arrays of the last ``length`` days, oldest first; only full windows without a gap."""
    span = W.partitionBy("city_id").orderBy(day_number()).rangeBetween(1 - length, 0)
    items = F.collect_list(
        F.when(F.col(column).isNotNull(), F.struct(day_number().alias("k"), F.col(column).alias("x")))
    ).over(span)
    return (
        panel.select(*KEYS, items.alias("__w"))
        .where(F.size("__w") == length)
        .select(
            *KEYS,
            F.transform(F.array_sort("__w"), lambda s: s["x"]).alias("lookback"),
        )
    )


def lag_correlation(
    panel: DataFrame, features: Sequence[str], lags: Sequence[int] = (0, 1, 2, 3)
) -> DataFrame:
    """Correlation of the target with each feature some days earlier, per city. No causal claim."""
    later = panel.select(
        "city_id",
        "date_id",
        *features,
        F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag_days"),
    ).select(
        "city_id",
        F.date_add("date_id", F.col("lag_days")).alias("date_id"),
        "lag_days",
        *features,
    )
    paired = panel.select(*KEYS, "y").join(later, KEYS).where(F.col("y").isNotNull())
    wide = paired.groupBy("city_id", "lag_days").agg(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.corr("y", F.col(f).cast("double")).alias("correlation"),
                F.count(f).alias("pairs"),
            ).alias(f)
            for f in features
        ]
    )
    return wide.select("city_id", "lag_days", F.inline(F.array(*[F.col(f) for f in features])))


def time_split(panel: DataFrame, cutoff: Column, name: str = "part") -> DataFrame:
    """Chronological split: dates up to the cutoff train, later ones test."""
    return panel.withColumn(name, F.when(F.col("date_id") <= cutoff, "train").otherwise("test"))


def scale(
    split: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = ("city_id",),
    method: str = "zscore",
    part: str = "part",
) -> DataFrame:
    """Scale features with parameters fitted on the training rows only.

    Constant or absent features scale to null rather than to a division by zero.
    """
    if method not in ("zscore", "minmax"):
        raise ValueError("method must be zscore or minmax")
    low, width = {
        "zscore": (F.avg, F.stddev_samp),
        "minmax": (F.min, lambda c: F.max(c) - F.min(c)),
    }[method]
    fitted = (
        split.where(F.col(part) == "train")
        .groupBy(*by)
        .agg(
            *[low(f).alias(f"__lo_{f}") for f in features],
            *[width(f).alias(f"__w_{f}") for f in features],
        )
    )
    joined = split.join(fitted, list(by), "left")
    scaled = {
        f"{f}_scaled": F.when(
            F.col(f"__w_{f}") > 0, (F.col(f) - F.col(f"__lo_{f}")) / F.col(f"__w_{f}")
        )
        for f in features
    }
    return joined.withColumns(scaled).drop(
        *[f"__lo_{f}" for f in features], *[f"__w_{f}" for f in features]
    )


def score(forecasts: DataFrame, by: Sequence[str] = ("city_id", "model")) -> DataFrame:
    """MAE and RMSE over days that have both a value and a forecast."""
    error = F.col("y") - F.col("y_hat")
    return (
        forecasts.where(F.col("y").isNotNull() & F.col("y_hat").isNotNull())
        .groupBy(*by)
        .agg(
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.count(F.lit(1)).alias("days"),
        )
    )


def band(c: Column) -> Column:
    """Public risk bands of the index."""
    return (
        F.when(c < 4, "low risk")
        .when(c < 7, "moderate risk")
        .when(c <= 10, "high risk")
        .when(c > 10, "very high risk")
    )


def baselines(panel: DataFrame, days: int = 7, minimum: int = 4) -> DataFrame:
    """Both baseline forecasts in long form."""
    naive = persistence(panel).withColumn("model", F.lit("persistence"))
    mean = moving_average(panel, days, minimum).withColumn("model", F.lit("moving_average"))
    return naive.unionByName(mean)
