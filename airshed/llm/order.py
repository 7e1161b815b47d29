"""Running sums and positions in one global order, without a task that sees more than one range of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airshed.llm.common import keyed
from airshed.session import settle

ROWS = 500_000  # rows of a range, on average


def ranges(df: DataFrame, order: Sequence[str], name: str, rows: int = ROWS) -> DataFrame:
    """``df`` as a written table in ranges of ``order``: columns ``__row`` and ``__range`` (ascending) are added.

    Rows that are equal in ``order`` are told apart by ``__row``, a number that is written before the
    ranges are drawn. So a key of any weight is spread, and a lost executor finds the same ranges again.
    """
    fixed = keyed(df, name, "__row")
    parts = -(-max(fixed.count(), 1) // rows)
    return settle(fixed.repartitionByRange(parts, *order, "__row").withColumn("__range", F.spark_partition_id()), name)


def running(
    table: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    fold=F.sum,
    whole: dict[str, str] | None = None,
) -> DataFrame:
    """``table`` of ``ranges`` with, for each name of ``sums``, the fold over its group up to and with the row.

    Each range and group is folded first (on the map side), the totals of a group's ranges are folded
    along the ranges, and only then the rows within. A group's window holds one row a range. ``whole``
    names further columns for the fold over the whole group.
    """
    at = ["__range", *group]
    totals = table.groupBy(*at).agg(*[fold(x).alias(n) for n, x in sums.items()])
    along = W.partitionBy(*group).orderBy("__range")
    before, every = along.rowsBetween(W.unboundedPreceding, -1), along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    names = {n: f"__before_{n}" for n in sums}
    offsets = totals.select(
        *at,
        *[F.coalesce(fold(n).over(before), F.lit(0)).alias(b) for n, b in names.items()],
        *[fold(n).over(every).alias(w) for n, w in (whole or {}).items()],
    )
    inside = W.partitionBy(*at).orderBy(*order, "__row").rowsBetween(W.unboundedPreceding, 0)
    local = table.select("*", *[fold(x).over(inside).alias(n) for n, x in sums.items()])
    both = (lambda a, b: a.bitwiseXOR(b)) if fold is F.bit_xor else (lambda a, b: a + b)
    return local.join(offsets, at).select(
        *table.columns, *[both(F.col(n), F.col(b)).alias(n) for n, b in names.items()], *(whole or {}).values()
    )


def attached(table: DataFrame, group: Sequence[str], facts: DataFrame) -> DataFrame:
    """``table`` of ``ranges`` with the columns of ``facts`` (one row a group; groups without one are left out).

    The facts go to a group's ranges first, so that the rows of a heavy group do not meet in one task.
    """
    at = ["__range", *group]
    return table.join(table.select(*at).distinct().join(facts, list(group)), at)
