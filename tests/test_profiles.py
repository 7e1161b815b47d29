import random

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from airshed.operators import profiles


def table(spark, n=20_000):
    r = random.Random(5)
    data = [(i % 6, r.gauss(0, 1) if i % 10 else None, r.randrange(3000), r.choice(["a", "b", None]), float("nan") if i % 7 == 0 else 1.0) for i in range(n)]
    return spark.createDataFrame(data, "load int, x double, k int, t string, odd double")


def test_merged_states_agree_with_the_rows(spark):
    df = table(spark)
    columns = ["x", "k", "t", "odd"]
    states = profiles.states(df, columns, ["load"])
    assert states.count() == 6 * 4
    got = {r["column_name"]: r for r in profiles.merged(states).collect()}
    for r in profiles.exact(df, columns).collect():
        m = got[r["column_name"]]
        assert (m["row_count"], m["null_count"]) == (r["row_count"], r["null_count"])
        assert m["distinct_count"] == pytest.approx(r["distinct_count"], rel=0.02)
    low, high = df.agg(F.min("x"), F.max("x")).first()
    assert (got["x"]["low"], got["x"]["high"]) == (low, high) and got["t"]["quantiles"] is None and got["odd"]["high"] == 1.0
    for c in ("x", "k"):
        values = sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).collect())
        for q, v in zip(profiles.QUANTILES, got[c]["quantiles"]):
            low, high = (int(len(values) * max(0, min(1, q + d))) for d in (-0.015, 0.015))
            assert values[low] <= v <= values[min(high, len(values) - 1)]


def test_the_order_of_loads_does_not_matter_and_empty_loads_add_nothing(spark):
    df = table(spark, 500)
    one = profiles.merged(profiles.states(df, ["k", "t"]))
    many = profiles.merged(profiles.states(df, ["k", "t"], ["load"]).unionByName(profiles.states(df.limit(0), ["k", "t"]).withColumn("load", F.lit(9))))
    cols = ["column_name", "row_count", "null_count", "low", "high", "distinct_count"]
    assert as_set(one.select(*cols)) == as_set(many.select(*cols))
