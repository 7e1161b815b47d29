"""Repeated polls with overlapping windows: each observation once, the newest copy winning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airshed.operators.grouping import keep_one, latest
from airshed.session import settle
from airshed.sources.files import read_table, write_table
from airshed.streaming.keyed import KeyedTable


def upsert_polls(polls: DataFrame, key: str = "id", taken_at: str = "snapshot_ts") -> DataFrame:
    """Newest copy of every observation over all polls landed so far."""
    return latest(polls, [key], [taken_at])


def stream_folder(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet landed under ``path``. The path is given as a pattern that matches only itself,
    which lets it be a folder of part files or one file."""
    pattern = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(pattern)


def first_seen(
    stream: DataFrame, keys: Sequence[str] = ("id",), event_time: str = "observation_datetime", retention: str = "4 days"
) -> DataFrame:
    """Each key once, as soon as it arrives. State is kept only for the retention of the overlap:
    polls look back three days, so a copy cannot arrive after four. Rows behind the watermark are dropped:
    for a backlog whose files are not in time order use ``ingest_first_seen``."""
    return stream.withWatermark(event_time, retention).dropDuplicatesWithinWatermark(list(keys))


def ingest_available(
    rows: DataFrame, out: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Process what has landed since the last run, then stop. Progress and state live in
    ``checkpoint``, so a lost executor or a restart neither repeats nor loses a row."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", out)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_upserts(
    rows: DataFrame, out: str, checkpoint: str, key: str = "id", taken_at: str = "snapshot_ts", buckets: int = 16
) -> StreamingQuery:
    """Exact upsert, however late a copy comes: every batch leaves its newest copy per key in the delta
    of a keyed table, which is folded into its base when it has outgrown it. A batch that is run again
    after a failure changes nothing."""
    table = upserts(rows.sparkSession, out, rows.schema, key, taken_at, buckets)

    def keep(batch: DataFrame, _: int) -> None:
        table.append(batch)
        table.fold()

    return (
        rows.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upserts(
    spark: SparkSession, out: str, schema: T.StructType, key: str = "id", taken_at: str = "snapshot_ts", buckets: int = 16
) -> KeyedTable:
    """The table that ``ingest_upserts`` keeps; its ``read`` has the newest copy of each key."""
    return KeyedTable(spark, out, schema, key, (taken_at,), buckets=buckets)


def ingest_first_seen(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    key: str = "id",
    event_time: str = "observation_datetime",
    retention: str = "4 days",
    buckets: int = 16,
) -> StreamingQuery:
    """Each key once, as soon as it arrives, for files in any order and any number of batches.

    A batch's keys are held against the table of all keys seen in earlier batches. New rows go to
    ``out/on_time``, or to ``out/late`` if they are more than ``retention`` behind the latest event of
    earlier batches, where a watermark would have dropped them. A batch that is run again after a failure
    replaces its own rows and is not held against itself.
    """
    spark = rows.sparkSession
    moment = rows.schema[event_time].dataType
    seen_schema = T.StructType([rows.schema[key], T.StructField("batch_id", T.LongType()), T.StructField("latest", moment)])
    seen = KeyedTable(spark, f"{out}/seen", seen_schema, key, ("batch_id",), first=True, buckets=buckets)

    def keep(batch: DataFrame, batch_id: int) -> None:
        earlier = seen.read().where(F.col("batch_id") < batch_id)
        horizon = earlier.agg(F.max("latest") - F.expr(f"interval {retention}")).first()[0]
        first = keep_one(batch, [key], event_time, copies_col="__copies").drop("__copies")
        new = settle(first.join(earlier.select(key), key, "left_anti").withColumn("batch_id", F.lit(batch_id).cast("long")), "first-seen")
        late = F.coalesce(F.col(event_time) < F.lit(horizon), F.lit(False)) if horizon is not None else F.lit(False)
        write_table(new.where(~late), f"{out}/on_time", ["batch_id"])
        write_table(new.where(late), f"{out}/late", ["batch_id"])
        # The latest event of the batch goes with each of its keys; copies of known keys count for it too.
        latest_event = batch.agg(F.max(event_time).alias("latest"))
        seen.append(new.select(key, "batch_id").join(F.broadcast(latest_event), F.lit(True)))
        seen.fold()

    return (
        rows.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_first_seen(spark: SparkSession, out: str) -> DataFrame:
    """All rows of ``ingest_first_seen``, those behind the horizon marked ``late``."""
    parts = [read_table(spark, f"{out}/{p}").withColumn("late", F.lit(p == "late")) for p in ("on_time", "late")]
    return parts[0].unionByName(parts[1])


def append_snapshot(cleaned: DataFrame, path: str, stamp: str = "snapshot_ts") -> None:
    """ref_active_fires_snapshot: a partition per snapshot; writing one again replaces it."""
    write_table(cleaned, path, [stamp])


def stamp_rows(df: DataFrame, snapshot_ts: str, source_url: str) -> DataFrame:
    """One snapshot time and source for all rows, given by the caller rather than by the clock."""
    return df.withColumns(
        {
            "snapshot_downloaded_at_utc": F.lit(snapshot_ts).cast("timestamp_ntz"),
            "source_url": F.lit(source_url),
        }
    )
