"""The state of a key as of a moment: for each row of one table, the last row of another at or before it.

Both tables are put in one order by key and time and cut into ranges of it, so a key of any weight is cut
at moments in between. Within a range each row takes the last state before it; what the range before
handed over fills the rest, and one row per range and key carries that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airshed.session import settle

ROWS = 500_000  # rows of a range, on average


def state_as_of(
    rows: DataFrame, states: DataFrame, keys: Sequence[str], moment: str, since: str, values: Sequence[str], range_rows: int = ROWS
) -> DataFrame:
    """``rows`` with ``values`` of the last state whose ``since`` is not after the row's ``moment``.

    Of states of one key and moment the greatest by ``values`` counts. Rows without an earlier state, or
    without a moment, have nulls; states without a moment are never in force. Null keys are a key.
    """
    state = F.struct(*[F.col(v).alias(v) for v in values])
    names = [f"__k{i}" for i in range(len(keys))]
    left = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(moment).alias("__t"), F.lit(1).alias("__side"), F.struct("*").alias("__row"))
    right = states.where(F.col(since).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(since).alias("__t"), F.lit(0).alias("__side"), state.alias("__state")
    )
    both = settle(left.unionByName(right, allowMissingColumns=True).withColumn("__no", F.monotonically_increasing_id()), "asof")
    order = ["__t", "__side", "__state", "__no"]
    parts = -(-max(both.count(), 1) // range_rows)
    ranged = both.repartitionByRange(parts, *names, *order).withColumn("__range", F.spark_partition_id())
    ranged = settle(ranged, "asof-ranges")

    at = ["__range", *names]
    upto = W.partitionBy(*at).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    inside = ranged.withColumn("__last", F.last("__state", ignorenulls=True).over(upto)).where("__side = 1")
    latest = F.max(F.when(F.col("__side") == 0, F.struct("__t", "__state")))
    handed = ranged.groupBy(*at).agg(latest["__state"].alias("__state"))
    along = W.partitionBy(*names).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    before = handed.select("__range", *[F.col(n).alias(f"_{n}") for n in names], F.last("__state", ignorenulls=True).over(along).alias("__before"))
    same = inside["__range"] == before["__range"]
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_{n}"))
    chosen = F.when(F.col("__t").isNotNull(), F.coalesce("__last", "__before"))
    met = inside.join(before, same).select("__row", chosen.alias("__s"))
    return met.select("__row.*", *[F.col(f"__s.{v}").alias(v) for v in values])
