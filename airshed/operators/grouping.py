"""Group facts brought back to rows without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks when rows meet their group facts.
HOT_ROWS = 2_000_000


def attach_facts(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    count_col: str,
    spread_by: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join every row with the facts of its group, null keys matching null keys.

    ``facts`` has one row per key, with the group's size in ``count_col``. A window over the key
    would bring a whole group to one task, and so would a plain join for a hot key. Here a key
    above ``hot_rows`` rows gets one copy of its facts per ``hot_rows`` rows, and its rows choose a
    copy by the hash of ``spread_by``. There are at most total/hot_rows hot keys, which is what
    bounds the broadcast list of them. Nothing is dropped and the result does not depend on
    ``hot_rows``.
    """
    copies = f"int(ceil({count_col} / {hot_rows}D))"
    hot = facts.where(f"{count_col} > {hot_rows}").selectExpr(
        *[f"`{k}` as `__h_{k}`" for k in keys], f"{copies} as __copies"
    )
    on_hot = " and ".join(f"`{k}` <=> `__h_{k}`" for k in keys)
    dealt = rows.join(F.broadcast(hot), F.expr(on_hot), "left").selectExpr(
        *[f"`{c}`" for c in rows.columns],
        f"if(__copies is null, 0, int(pmod(xxhash64(`{spread_by}`), __copies))) as __slot",
    )
    copied = facts.selectExpr(
        *[f"`{k}` as `__k_{k}`" for k in keys],
        *[f"`{c}`" for c in facts.columns if c not in keys],
        f"explode(sequence(0, {copies} - 1)) as __k_slot",
    )
    on = " and ".join([*[f"`{k}` <=> `__k_{k}`" for k in keys], "__slot = __k_slot"])
    joined = dealt.join(copied, F.expr(on), how)
    return joined.drop("__slot", "__k_slot", *[f"__k_{k}" for k in keys])


def keep_one(rows: DataFrame, keys: list[str], order_by: str, copies_col: str = "copies") -> DataFrame:
    """First row per key by ``order_by`` and the number of rows it stands for.

    An aggregate with a map-side step, not a row_number window, so copies shrink before the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys]
    grouped = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.col(order_by)).alias("__first"),
        F.count(F.lit(1)).alias(copies_col),
    )
    return grouped.select(*keys, *[F.col("__first")[c].alias(c) for c in rest], copies_col)


def latest(rows: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Row with the greatest ``order_by`` per key, the whole rest of the row breaking ties."""
    rest = [c for c in rows.columns if c not in keys and c not in order_by]
    grouped = rows.groupBy(*keys).agg(F.max(F.struct(*order_by, *rest)).alias("__last"))
    return grouped.select(*keys, *[F.col("__last")[c].alias(c) for c in [*order_by, *rest]])


def literal_rows(spark, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A configuration table as SQL VALUES, so the optimizer knows its exact size."""

    def text(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, int):
            return str(value)
        if isinstance(value, float):
            return f"{value!r}D"
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {body} as t({', '.join(columns)})")
