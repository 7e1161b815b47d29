"""Intervals of days as aligned spans: which days of a calendar an interval holds, without listing its days.

A span of level k is 2^k days long and begins at a multiple of that. An interval is the union of at most
two spans of each level, however long it is; a day lies in one span of each level. So an interval and a
day meet in exactly one equal (level, span), which is an ordinary join, and only days of the calendar
come out of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = 24  # 2^23 days are more than the dates there are
SHIFT = 1 << 22  # makes the numbers of all dates positive


def cover(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows once for each span of their days ``first`` to ``last``: ``__level`` and ``__span``. Rows without
    a day, an end included, have none."""
    begin = f"(unix_date(`{first}`) + {SHIFT})"
    end = f"(unix_date(`{last}`) + {SHIFT + 1})"
    # At a level, what is left of the interval begins and ends at multiples of its length; an odd one is taken.
    return (
        df.where(F.col(first) <= F.col(last))
        .withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
        .withColumn("__l", F.expr(f"shiftright({begin} + shiftleft(1, __level) - 1, __level)"))
        .withColumn("__r", F.expr(f"shiftright({end}, __level)"))
        .where("__l < __r and (__l % 2 = 1 or __r % 2 = 1)")
        .withColumn("__span", F.expr("explode(filter(array(if(__l % 2 = 1, __l, null), if(__r % 2 = 1, __r - 1, null)), x -> x is not null))"))
        .drop("__l", "__r")
    )


def of_days(days: DataFrame, day: str) -> DataFrame:
    """The days (distinct, one row each), once for each span that they lie in."""
    levels = days.select(day).withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
    return levels.withColumn("__span", F.expr(f"shiftright(unix_date(`{day}`) + {SHIFT}, __level)"))


def on_days(df: DataFrame, first: str, last: str, days: DataFrame, day: str) -> DataFrame:
    """A row for each row of ``df`` and each of the ``days`` within its interval."""
    return cover(df, first, last).join(of_days(days, day), ["__level", "__span"]).drop("__level", "__span")


def open_on_days(df: DataFrame, first: str, last: str, days: DataFrame, day: str, by: list[str]) -> DataFrame:
    """(by, day, n): rows open on each of the ``days``. Equal spans are counted before they meet the days."""
    counted = cover(df, first, last).groupBy(*by, "__level", "__span").agg(F.count(F.lit(1)).alias("n"))
    met = counted.join(of_days(days, day), ["__level", "__span"])
    return met.groupBy(*by, day).agg(F.sum("n").alias("n"))
