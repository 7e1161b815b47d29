"""Profiles and defect reports that work on any table.

Every report aggregates before it shuffles; row listings come back through ``attach_facts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions.moments import hour_index
from airshed.operators.grouping import HOT_ROWS, attach_facts

def n_rows() -> Column:
    return F.count(F.lit(1))



def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def group_sizes(df: DataFrame, keys: Sequence[str], name: str, keep_null_keys: bool = True) -> DataFrame:
    """Rows per key. Without ``keep_null_keys`` a row with any null key is left out."""
    kept = df if keep_null_keys else df.dropna(subset=list(keys))
    return kept.groupBy(*keys).agg(n_rows().alias(name))


def distinct_values(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count_distinct(column).alias(name))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column as (column_name, null_count), all columns in one pass."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counted.unpivot([], names, "column_name", "null_count")


def drop_empty_column(df: DataFrame, column: str) -> DataFrame:
    """The table without ``column`` when that holds no value at all; one narrow pass decides."""
    if column not in df.columns:
        return df
    if df.select(column).where(F.col(column).isNotNull()).isEmpty():
        return df.drop(column)
    return df


def redundant_copies(df: DataFrame, keys: Sequence[str], name: str = "redundant_copies") -> DataFrame:
    """Rows beyond the first of every key, null keys counted as equal."""
    sizes = df.groupBy(*keys).agg(n_rows().alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))


def coverage(df: DataFrame, lows_and_highs: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """Row count, extremes and distinct counts in one row."""
    parts: list[Column] = [n_rows().alias("row_count")]
    for c in lows_and_highs:
        parts += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    parts += [F.count_distinct(c).alias(f"distinct_{c}") for c in distinct]
    return df.agg(*parts)


def year_mismatches(df: DataFrame, date_col: str = "date", year_col: str = "requested_year") -> DataFrame:
    """Rows whose date lies outside the requested year; undated rows are not judged."""
    return df.withColumn("actual_year", F.year(date_col)).where(
        F.col(date_col).isNotNull() & (F.col("actual_year") != F.col(year_col))
    )


def reading_counts(df: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Rows per key and reading. The few distinct readings of a key are what later steps count, so
    no distinct count has to copy every input row once per counted column."""
    return df.groupBy(*keys, *parts).agg(n_rows().alias("__n"))


def year_summary(df: DataFrame, by: Sequence[str] = ("requested_year",)) -> DataFrame:
    """Rows against distinct dates per year."""
    summary = (
        reading_counts(df.dropna(subset=list(by)), by, ["date", "time"])
        .groupBy(*by)
        .agg(
            F.sum("__n").alias("row_count"),
            F.count_distinct("date").alias("unique_date_count"),
            F.count_distinct("time").alias("unique_time_count"),
            F.min("date").alias("earliest_date"),
            F.max("date").alias("latest_date"),
        )
    )
    return summary.withColumn("extra_rows", F.col("row_count") - F.col("unique_date_count"))


def duplicate_dates(df: DataFrame, by: Sequence[str] = ("requested_year",)) -> DataFrame:
    """Dates with more than one record, and how many distinct readings they carry."""
    keys = [*by, "date"]
    return (
        reading_counts(df.dropna(subset=keys), keys, ["time", "aqhi_raw", "category"])
        .groupBy(*keys)
        .agg(
            F.sum("__n").alias("record_count"),
            F.count_distinct("time").alias("distinct_times"),
            F.count_distinct("aqhi_raw").alias("distinct_aqhi_values"),
            F.count_distinct("category").alias("distinct_categories"),
        )
        .where(F.col("record_count") > 1)
    )


def duplicate_date_rows(
    df: DataFrame,
    by: Sequence[str] = ("requested_year",),
    row_id: str = "row_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The single records behind ``duplicate_dates``."""
    facts = duplicate_dates(df, by).drop("distinct_categories")
    return attach_facts(df, facts, [*by, "date"], "record_count", row_id, hot_rows=hot_rows)


def time_summary(df: DataFrame, by: Sequence[str] = ("requested_year",)) -> DataFrame:
    """Rows per time text, rows without a time included."""
    return group_sizes(df, [*by, "time"], "row_count")


def exact_duplicates(
    df: DataFrame, fields: Sequence[str], row_id: str = "row_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every member of every group of rows equal in all ``fields``, null equal to null."""
    facts = df.groupBy(*fields).agg(n_rows().alias("copies")).where(F.col("copies") > 1)
    return attach_facts(df, facts, list(fields), "copies", row_id, hot_rows=hot_rows)


def datetime_conflicts(df: DataFrame, by: Sequence[str] = ("requested_year",)) -> DataFrame:
    """Same date and time, several records, several values; rows without a time form a group too."""
    keys = [*by, "date", "time"]
    return (
        reading_counts(df, keys, ["aqhi_raw", "category"])
        .groupBy(*keys)
        .agg(
            F.sum("__n").alias("record_count"),
            F.count_distinct("aqhi_raw").alias("distinct_aqhi_values"),
            F.count_distinct("category").alias("distinct_categories"),
        )
        .where((F.col("record_count") > 1) & (F.col("distinct_aqhi_values") > 1))
    )


def conflict_values(df: DataFrame, by: Sequence[str] = ("requested_year",)) -> DataFrame:
    """The readings found at each conflicting date and time, one row per value."""
    keys = [*by, "date", "time"]
    per_value = df.groupBy(*keys, "aqhi_raw").agg(n_rows().alias("record_count"))
    conflicting = (
        per_value.groupBy(*keys)
        .agg(F.min("aqhi_raw").alias("lo"), F.max("aqhi_raw").alias("hi"))
        .where(F.col("lo") < F.col("hi"))
        .select(*[F.col(k).alias(f"__{k}") for k in keys])
    )
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return per_value.join(conflicting, on, "left_semi")


def code_frequency(
    df: DataFrame,
    fields: Sequence[str],
    by: Sequence[str] = (),
    name_col: str = "field_name",
    value_col: str = "code_value",
) -> DataFrame:
    """Counts of every value of several coded columns, one scan for all of them.

    Missing is named before blanks are trimmed, so a blank code stays a code.
    """
    present = [f for f in fields if f in df.columns]
    texts = df.select(
        *by, *[F.trim(F.coalesce(F.col(f).cast("string"), F.lit("<MISSING>"))).alias(f) for f in present]
    )
    long = texts.unpivot(list(by), present, name_col, value_col)
    return long.groupBy(*by, name_col, value_col).agg(n_rows().alias("record_count"))


def order_frequency(report: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Reading order of the frequency report: field order kept, common codes first."""
    position = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field_name"))
    return report.orderBy(position, F.col("record_count").desc(), F.col("code_value").asc_nulls_last())


def distinct_locations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def sorted_nulls_last(df: DataFrame, *columns: str) -> DataFrame:
    """Sorted with nulls at the end, which is not Spark's default; "-name" sorts descending."""
    return df.orderBy(
        *[
            F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
            for c in columns
        ]
    )


def preview(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """First n rows by a total order (a top-k, no full sort)."""
    return sorted_nulls_last(df, *order_by).limit(n)


def largest_with_ties(df: DataFrame, column: str) -> DataFrame:
    """Every row that holds the greatest value of ``column``."""
    top = df.agg(F.max(column).alias("__top"))
    return df.join(F.broadcast(top), F.col(column) == F.col("__top"), "left_semi")


def expected_against_returned(
    expected: DataFrame, returned: DataFrame, key: str, side: str = "side"
) -> DataFrame:
    """Keys expected but not returned, and returned but not expected."""
    want = expected.select(key).where(F.col(key).isNotNull()).distinct()
    got = returned.select(key).where(F.col(key).isNotNull()).distinct()
    missing = want.join(got, key, "left_anti").withColumn(side, F.lit("missing"))
    extra = got.join(want, key, "left_anti").withColumn(side, F.lit("unexpected"))
    return missing.unionByName(extra)


def orphans(facts: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign-key values without a parent and the rows that carry them.

    Facts shrink to one row per key before the anti join, so a hot key is one row.
    """
    keys = facts.where(F.col(fk).isNotNull()).groupBy(fk).agg(n_rows().alias("row_count"))
    return keys.join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")


def freshness(
    sources: Sequence[tuple[str, DataFrame, str]], as_of: Column, name_col: str = "source"
) -> DataFrame:
    """Newest instant per source and whole hours from it to ``as_of``."""
    parts = [
        df.agg(F.max(ts).cast("timestamp_ntz").alias("newest"), F.count(ts).alias("stamped_rows"))
        .withColumn(name_col, F.lit(name))
        for name, df, ts in sources
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.withColumn("hours_old", hour_index(as_of) - hour_index(F.col("newest")))
