"""Staged loads: what each delivery replaces, and which rows count.

A load is numbered by its caller. Beside its rows it records what it replaces of earlier loads: for
sources with a time, a span per unit (a station and mode, say); for the others, the keys that it holds.
The record is written last and is what makes a load count, so a load that broke off is as if it had not
been. Reading compares each row with the spans of later loads of its unit: one row per unit, with its
spans as a short list, meets the rows, so a unit of any size stays spread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators import profiles
from airshed.sources.files import read_table, replace_load

# Columns of these types get a profile of each load.
PROFILED = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Source:
    """What one delivery replaces: rows with equal ``unit``, and of these, with a ``time``, those in its span."""

    unit: tuple[str, ...]
    partition: str  # the column a row's month is taken from
    time: str | None = None


STAGING = {
    "cwfis_hotspots": Source(("uid",), "rep_date"),
    "aqhi_geomet_current": Source(("id",), "observation_datetime"),
    "aqhi_aqo_historical": Source(("station_id", "value_type", "requested_year"), "date", "date"),
    "ontario_active_fires": Source(("snapshot_downloaded_at_utc",), "snapshot_downloaded_at_utc"),
    "eccc_hourly_weather": Source(("station_id",), "date_time_lst", "date_time_lst"),
    "evacuation_log": Source(("event_id", "status_as_of_date"), "start_date"),
}


def spans_of(rows: DataFrame, source: Source) -> DataFrame:
    """unit columns, first, last, undated: the span that the rows themselves cover."""
    t = F.col(source.time)
    return rows.groupBy(*source.unit).agg(
        F.min(t).alias("first"), F.max(t).alias("last"), F.count_if(t.isNull()).cast("boolean").alias("undated")
    )


def stage(
    rows: DataFrame, path: str, source: Source, load: int, spans: DataFrame | None = None, replace: bool = False
) -> None:
    """Rows of one load at source grain, by load and month, and then the record of what it replaces.

    ``spans`` (unit columns, first, last) declares more than the rows show, as when a day was taken back
    or a unit has no rows any more. A number that is taken is refused unless ``replace`` says that the
    same load is run again.
    """
    if not replace and load in loads(rows.sparkSession, path):
        raise ValueError(f"{path}: load {load} is there already; run it again with replace, or take another number")
    month = F.date_format(F.col(source.partition).cast("date"), "yyyy-MM")
    replace_load(rows.withColumn("month", F.coalesce(month, F.lit("undated"))), path, load, ["month"])
    record = rows.limit(0).select(*source.unit)
    if source.time:
        own = spans_of(rows, source)
        record = own
        if spans is not None:
            given = spans.select(*source.unit, "first", "last", F.lit(False).alias("undated"))
            record = own.unionByName(given).groupBy(*source.unit).agg(
                F.min("first").alias("first"), F.max("last").alias("last"), F.max("undated").alias("undated")
            )
    # A load without units is a load too.
    marker = rows.sparkSession.range(1).select(F.lit(True).alias("marker")).select("marker")
    columns = [f.name for f in rows.schema if isinstance(f.dataType, PROFILED)]
    if columns:
        replace_load(profiles.states(rows, columns).coalesce(1), f"{path}_profiles", load)
    record = record.withColumn("marker", F.lit(False)).unionByName(marker, allowMissingColumns=True)
    replace_load(record.coalesce(1), f"{path}_loads", load)


def _record(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        table = read_table(spark, f"{path}_loads")
        return table if table.columns else None
    except AnalysisException:
        return None


def loads(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the loads that count."""
    record = _record(spark, path)
    return [] if record is None else sorted(r["load"] for r in record.where("marker").select("load").distinct().collect())


def profile(spark: SparkSession, path: str) -> DataFrame:
    """The merged profile (``profiles.merged``) of all rows that any load delivered; reads no raw row."""
    counted = _record(spark, path).where("marker").select(F.col("load").alias("__load"))
    some = read_table(spark, f"{path}_profiles")
    return profiles.merged(some.join(counted, F.col("load") == F.col("__load"), "left_semi").drop("load"))


def staged(spark: SparkSession, path: str, source: Source) -> DataFrame:
    """The rows that count, with their ``load``. Rows of one load are all kept, repeats too.

    With a time: a row is replaced by a later load whose span of its unit holds its time; a row without
    a time, by a later load of its unit with such rows. Otherwise by a later load with a row of equal
    unit. A unit with a null in its columns is a unit as well.
    """
    rows = read_table(spark, path)
    record = _record(spark, path)
    if record is None:
        return rows.where("false")
    counted = record.where("marker").select(F.col("load").alias("__load"))
    rows = rows.join(counted, F.col("load") == F.col("__load"), "left_semi")
    same = F.lit(True)
    for c in source.unit:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    named = [F.col(c).alias(f"__{c}") for c in source.unit]
    if not source.time:
        last = rows.groupBy(*source.unit).agg(F.max("load").alias("__last")).select(*named, "__last")
        return rows.join(last, same & (F.col("load") == F.col("__last")), "left_semi")
    later = record.where("not marker").groupBy(*source.unit).agg(F.collect_list(F.struct("load", "first", "last", "undated")).alias("__spans"))
    t = F.col(source.time)

    def replaces(s):
        within = F.when(t.isNull(), s["undated"]).otherwise(t.between(s["first"], s["last"]))
        return (s["load"] > F.col("load")) & F.coalesce(within, F.lit(False))

    met = rows.join(later.select(*named, "__spans"), same, "left")
    return met.where(~F.coalesce(F.exists("__spans", replaces), F.lit(False))).select(*rows.columns)
