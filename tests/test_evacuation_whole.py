"""evac_overlap_days counts every day that an event is open, whenever events begin."""

import datetime as dt

from parity import compare, duck
from pyspark.sql import functions as F

from airshed.workload import registry


def orders(spark, path, rows):
    df = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, day date")
    df.select("o_orderkey", "o_custkey", F.col("day").cast("timestamp_ntz").alias("o_orderdate")).coalesce(1).write.parquet(f"{path}/orders.parquet")
    con = duck(f"{path}/none")
    con.execute(f"create view orders as select * from '{path}/orders.parquet/*.parquet'")
    return con


def test_days_behind_the_last_start_are_counted(spark, tmp_path):
    # Order 24 is Ongoing without an end and was checked 4 days on; all orders begin on that day or before.
    day = dt.date(2024, 5, 1)
    con = orders(spark, tmp_path, [(24, 1, day), (24, 1, day), (17, 2, day - dt.timedelta(3)), (16, 3, day), (71, 4, day), (36, 5, None)])
    got = {(r["nearby_project_city"], str(r["date"])): r["open_events"] for r in registry.QUERIES["evac_overlap_days"](spark, str(tmp_path)).collect()}
    assert [got.get(("Barrie", f"2024-05-0{k}")) for k in range(1, 7)] == [2, 2, 2, 2, 2, None]
    ok, note = compare(spark, con, "evac_overlap_days", str(tmp_path))
    assert ok, note


def test_events_without_a_valid_day_have_none(spark, tmp_path):
    con = orders(spark, tmp_path, [(71, 4, dt.date(2024, 5, 1)), (9, 5, dt.date(2024, 5, 1)), (36, 7, None)])
    ok, note = compare(spark, con, "evac_overlap_days", str(tmp_path))
    assert ok, note
