"""CSV and text files in, tables out."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.text import snake_names
from airshed.sources.schemas import conform


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    required: Sequence[str] = (),
    normalise: bool = False,
) -> DataFrame:
    """CSV with a header: text columns matched by name, then typed by ``schema``."""
    df = (
        spark.read.option("header", True).option("multiLine", False).option("escape", '"').csv(path)
    )
    if normalise:
        df = df.toDF(*snake_names(df.columns, number_repeats=True))
    if schema is None:
        return conform(df, T.StructType([]), required)
    return conform(df, schema, required)


def with_file_parts(df: DataFrame, pattern: str, names: Sequence[str]) -> DataFrame:
    """Context columns read off the file name, e.g. city, station, year and month."""
    name = F.col("_metadata.file_name")
    return df.select(
        "*", *[F.regexp_extract(name, pattern, i).alias(n) for i, n in enumerate(names, start=1)]
    )


def union_by_name(frames: Sequence[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Tables with differing columns as one, each with its own constant context columns."""
    marked = [df.withColumns(context) if context else df for df, context in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def payload_is_valid(text: Column, marker: str = "Date/Time") -> Column:
    """A landed payload names the marker column and has more than one line break."""
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return F.contains(text, F.lit(marker)) & (breaks > 1)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Whole text of every file, with its path."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


# --- sinks --------------------------------------------------------------------------------------


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    measures: dict[str, Column] | None = None,
) -> None:
    """Parquet table with its schema beside it, so that an empty one can be read too.

    Rows are first rebalanced by the partition columns: few files per partition, and a partition
    far larger than the others is split over several tasks. Only the partitions present in ``df``
    are replaced, so writing the same snapshot again leaves one copy. ``measures`` (aggregates by name,
    whole numbers) are observed in the write itself, behind the last shuffle, where a task that runs
    again is counted once; ``read_measures`` gives what the last write saw.
    """
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    observed = Observation() if measures else None
    if observed:
        out = out.observe(observed, F.count(F.lit(1)).alias("__rows"), *[c.alias(n) for n, c in measures.items()])
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _describe(df, path)
    if observed:
        found = observed.get
        values = [(n, int(found.get(n) or 0)) for n in measures]
        df.sparkSession.createDataFrame(values, "name string, value bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/_measures")


def read_measures(spark: SparkSession, path: str) -> dict[str, int]:
    """What the last write of a table measured; nothing for a table written without measures."""
    try:
        return {r["name"]: r["value"] for r in spark.read.schema("name string, value bigint").parquet(f"{path}/_measures").collect()}
    except AnalysisException:
        return {}


def replace_load(df: DataFrame, path: str, load: int, partition_by: Sequence[str] = ()) -> None:
    """The rows of one load of a table, in place of what that load wrote before, and of nothing else."""
    rows = df.withColumn("load", F.lit(load).cast("int"))
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/load={load}")
    _describe(rows, path)


def _describe(df: DataFrame, path: str) -> None:
    """Writes the table's schema: the columns known before, and new ones behind them.

    A column keeps its type for good; a load that brings another one is refused.
    """
    spark = df.sparkSession
    known = {f.name: f for f in _schema(spark, path).fields}
    for f in df.schema.fields:
        before = known.setdefault(f.name, T.StructField(f.name, f.dataType))
        if before.dataType != f.dataType:
            raise ValueError(f"{path}: {f.name} was {before.dataType.simpleString()}, now {f.dataType.simpleString()}")
    described = spark.sql("select :schema as value", {"schema": T.StructType(list(known.values())).json()})
    described.write.mode("overwrite").text(f"{path}/_schema")


def _schema(spark: SparkSession, path: str) -> T.StructType:
    try:
        described = spark.read.text(f"{path}/_schema").first()["value"]
    except AnalysisException:
        return T.StructType([])
    return T.StructType.fromJson(json.loads(described))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_schema(spark, path)).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV copy for readers outside Spark; the header is written even without rows."""
    df.write.mode("overwrite").option("header", True).csv(path)
