"""Evacuation events: episodes, and how many are open per city and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airshed.operators import spans
from airshed.operators.grouping import latest


def known_end(end: str = "end_date", status: str = "status", as_of: str = "status_as_of_date", start: str = "start_date") -> Column:
    """Last day an event is known to last.

    The status decides, not the blank end date: an ongoing event lasts to the day it was last
    checked; one of unknown status is only known for the day it began.
    """
    return F.coalesce(
        F.col(end), F.when(F.col(status) == "Ongoing", F.greatest(F.col(as_of), F.col(start))), F.col(start)
    )


def episodes(events: DataFrame, community: str = "community") -> DataFrame:
    """One row per community and continuous period; touching or overlapping events merge.

    Events shrink to one row per community and start date before the window, so a community with
    very many records still gives the window no more rows than there are days.
    """
    valid = events.withColumn("__end", known_end()).where(F.col("__end") >= F.col("start_date"))
    starts = valid.groupBy(community, "start_date").agg(
        F.max("__end").alias("__end"), F.count(F.lit(1)).alias("__n")
    )
    earlier = W.partitionBy(community).orderBy("start_date").rowsBetween(
        W.unboundedPreceding, -1
    )
    so_far = W.partitionBy(community).orderBy("start_date")
    reached = F.max("__end").over(earlier)
    numbered = starts.withColumn(
        "__new", (reached.isNull() | (F.col("start_date") > F.date_add(reached, 1))).cast("int")
    ).withColumn("episode_no", F.sum("__new").over(so_far))
    return numbered.groupBy(community, "episode_no").agg(
        F.min("start_date").alias("episode_start"),
        F.max("__end").alias("episode_end"),
        F.sum("__n").alias("event_count"),
    )


def open_per_day(events: DataFrame, days: DataFrame, city: str = "city", day: str = "date_id") -> DataFrame:
    """Events open per city and day of the calendar ``days``, for display only; days without one have no row.

    An event is a few aligned spans (``spans``), counted per city before they meet the calendar: an end
    date far in the future costs no more than another.
    """
    counted = spans.open_on_days(events.withColumn("__end", known_end()), "start_date", "__end", days.distinct(), day, [city])
    return counted.select(city, F.col(day).alias("date"), F.col("n").alias("open_events"))


def annotations(events: DataFrame, days: DataFrame, city: str = "city", day: str = "date_id") -> DataFrame:
    """Which events overlap a city-day, one row per event and day of the calendar, for display beside the fact."""
    met = spans.on_days(events.withColumn("__end", known_end()), "start_date", "__end", days.distinct(), day)
    return met.select(city, F.col(day).alias("date"), "event_id", "community", "status")


def evacuation_facts(log: DataFrame, cities: DataFrame, row_id: str | None = None) -> DataFrame:
    """fact_evacuation_events: latest known state per event, linked to a city where one is named.

    The latest state is the one checked last; of those checked on one day the last row
    (``row_id``). Rows without an event id name no event and are left to the rules.
    """
    order = ["status_as_of_date", *([row_id] if row_id else [])]
    columns = ["event_id", "community", "nearby_project_city", "start_date", "end_date", "status", "source_url", *order]
    states = latest(log.where(F.col("event_id").isNotNull()).select(*columns), ["event_id"], order)
    return states.join(
        cities.select("city_id", F.col("city_name").alias("nearby_project_city")),
        "nearby_project_city",
        "left",
    ).select(
        "event_id",
        "city_id",
        F.col("community").alias("location_name"),
        "start_date",
        "end_date",
        "status",
        F.col("source_url").alias("source"),
        F.col("status_as_of_date").alias("last_verified_date"),
    )
