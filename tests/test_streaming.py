import datetime as dt

from conftest import as_set
from pyspark.sql import functions as F

from airshed.sources.schemas import struct
from airshed.streaming import polls

SCHEMA = struct("id string, observation_datetime timestamp_ntz, snapshot_ts timestamp_ntz, aqhi double")


def land(spark, path, name, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def poll(day, ids, value):
    at = dt.datetime(2026, 7, day, 6)
    return [(f"o{i}", dt.datetime(2026, 7, 1) + dt.timedelta(hours=6 * i), at, float(value)) for i in ids]


def test_overlapping_polls_give_each_observation_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run():
        stream = polls.stream_folder(spark, src, SCHEMA).withColumn(
            "observation_datetime", F.col("observation_datetime").cast("timestamp")
        )
        polls.ingest_available(polls.first_seen(stream), out, mark).awaitTermination()

    land(spark, src, "a", poll(3, range(0, 12), 1))
    run()
    land(spark, src, "b", poll(4, range(6, 16), 2))
    run()
    run()  # nothing new
    got = spark.read.parquet(out)
    assert as_set(got.groupBy("id").count().where("count > 1")) == []
    assert got.count() == 16


def test_upsert_takes_the_newest_copy_however_late(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run():
        stream = polls.stream_folder(spark, src, SCHEMA, files_per_batch=1)
        polls.ingest_upserts(stream, out, mark).awaitTermination()

    batches = [poll(20, range(0, 30), 3), poll(3, range(0, 12), 1), poll(21, range(5, 40), 4), poll(4, range(0, 50), 2)]
    for n, b in enumerate(batches):
        land(spark, src, str(n), b)
        if n % 2:
            run()
    run()
    everything = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    got = polls.upserts(spark, out, SCHEMA).read().select("id", "snapshot_ts", "aqhi")
    assert as_set(got) == as_set(polls.upsert_polls(everything).select("id", "snapshot_ts", "aqhi"))
    assert got.count() == 50


def test_first_seen_in_any_order(spark, tmp_path):
    """Files in reverse time order, one a batch, a restart in between, and copies of old keys at the end."""
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run():
        stream = polls.stream_folder(spark, src, SCHEMA, files_per_batch=1)
        polls.ingest_first_seen(stream, out, mark).awaitTermination()

    land(spark, src, "a", poll(20, range(40, 60), 1))
    land(spark, src, "b", poll(20, range(20, 45), 2))
    run()
    land(spark, src, "c", poll(20, range(0, 25), 3))
    land(spark, src, "d", poll(21, [0, 59, 60, 61], 4) + [(None, None, None, 1.0)])
    run()
    run()  # nothing new
    got = polls.read_first_seen(spark, out)
    assert sorted(r["id"] or "" for r in got.collect()) == sorted(["", *(f"o{i}" for i in range(62))])
    late = {r["id"] for r in got.where("late").collect()}
    newest = 59  # the first batch's last observation; four days are sixteen steps of six hours
    assert late == {f"o{i}" for i in range(newest - 16)} - {f"o{i}" for i in range(40, 60)}


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    table = polls.upserts(spark, str(tmp_path / "t"), SCHEMA, buckets=4)
    first = spark.createDataFrame(poll(3, range(10), 1), SCHEMA)
    for _ in range(2):
        table.append(first)
    assert table.read().count() == 10 and table.delta().count() == 20


def test_base_and_deltas_after_many_runs(spark, tmp_path):
    table = polls.upserts(spark, str(tmp_path / "t"), SCHEMA, buckets=4)
    assert table.read().count() == 0 and not table.fold()
    rows = []
    for n in range(12):
        batch = poll(1 + (n * 7) % 20, range(n * 3, n * 3 + 20), n)
        rows += batch
        table.append(spark.createDataFrame(batch, SCHEMA))
        if n in (0, 5):
            assert table.fold(0.5)
    assert table.generation() == 2 and not table.fold(10.0)
    want = polls.upsert_polls(spark.createDataFrame(rows, SCHEMA))
    assert as_set(table.read().select(*want.columns)) == as_set(want)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("_base_2") == 1, plan
    # Another session finds the same table by its folder.
    again = polls.upserts(spark.newSession(), str(tmp_path / "t"), SCHEMA, buckets=4)
    assert as_set(again.read().select(*want.columns)) == as_set(want)


def test_a_fold_that_broke_off_leaves_the_base_before(spark, tmp_path):
    table = polls.upserts(spark, str(tmp_path / "t"), SCHEMA, buckets=4)
    table.append(spark.createDataFrame(poll(3, range(10), 1), SCHEMA))
    table.read().limit(3).write.insertInto(table._table("base", 1))  # written in part, without a marker
    assert table.generation() == 0 and table.read().count() == 10
    assert table.fold() and table.base().count() == 10 and table.delta().count() == 0
