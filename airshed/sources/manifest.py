"""What should have been landed, what has been, and what is still missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.config import VALUE_TYPES
from airshed.functions.text import file_label


def month_manifest(stations: DataFrame, first: str = "first_month", last: str = "last_month") -> DataFrame:
    """Every station and month, both ends included, with the name of the file it is landed as.

    ``stations`` carries city, station_id and its first and last month.
    """
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    grid = stations.select("city", "station_id", F.explode(months).alias("month_start"))
    return grid.withColumn(
        "file_name", file_label(F.col("city"), F.col("station_id"), F.col("month_start"))
    )


def year_manifest(stations: DataFrame, first_year: str, last_year: str) -> DataFrame:
    """Every station, year and mode of the historical search page."""
    years = stations.select(
        *[c for c in stations.columns if c not in (first_year, last_year)],
        F.explode(F.sequence(F.col(first_year), F.col(last_year))).alias("requested_year"),
    )
    modes = F.array(
        *[F.struct(F.lit(k).alias("show_day_code"), F.lit(v).alias("value_type")) for k, v in VALUE_TYPES]
    )
    return years.select("*", F.inline(modes))


def outstanding(manifest: DataFrame, landed: DataFrame, key: str = "file_name") -> DataFrame:
    return manifest.join(landed.select(key).distinct(), key, "left_anti")


def extraction_summary(manifest: DataFrame, outcomes: DataFrame, key: str = "file_name") -> DataFrame:
    """Expected, new, skipped, failed and total rows.

    ``outcomes`` has one row per attempt: key, outcome (new, skipped, failed) and row count.
    """
    joined = manifest.select(key).join(outcomes, key, "left")
    return joined.agg(
        F.count_distinct(key).alias("expected_files"),
        F.count_if(F.col("outcome") == "new").alias("new_files"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_files"),
        F.count_if(F.col("outcome") == "failed").alias("failed_files"),
        F.count_if(F.col("outcome").isNull()).alias("untried_files"),
        F.coalesce(
            F.sum(F.when(F.col("outcome") != "failed", F.col("rows"))), F.lit(0)
        ).alias("total_rows"),
    )
