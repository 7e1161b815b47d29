import random
from collections import Counter, defaultdict

import pytest
from conftest import as_set
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airshed.operators import quality
from airshed.operators.grouping import attach_facts, keep_one, latest

DDL = "row_id bigint, requested_year int, date date, time string, aqhi_raw string, category string"
COLS = ["requested_year", "date", "time", "aqhi_raw", "category"]


@pytest.fixture(scope="module")
def data():
    import datetime as dt

    rnd = random.Random(7)
    out = []
    for i in range(1500):
        hot = rnd.random() < 0.34  # one key holds a third of all rows
        day = dt.date(2024, 3, 3) if hot else dt.date(2024, 1, 1) + dt.timedelta(rnd.randrange(60))
        out.append(
            (
                i,
                2024 if hot or rnd.random() < 0.8 else 2025,
                None if not hot and rnd.random() < 0.05 else day,
                rnd.choice(["4:00 pm EST", "4:00 pm EDT", None]),
                None if rnd.random() < 0.1 else str(rnd.randrange(1, 4)),
                rnd.choice(["low risk", None]),
            )
        )
    return out


@pytest.fixture
def df(spark, data):
    return spark.createDataFrame(data, DDL)


def groups(data, key):
    out = defaultdict(list)
    for r in data:
        out[key(r)].append(r)
    return out


def test_duplicate_dates(df, data):
    want = []
    for (y, d), g in groups(data, lambda r: (r[1], r[2])).items():
        if d is not None and len(g) > 1:
            n = [len({r[i] for r in g} - {None}) for i in (3, 4, 5)]
            want.append((y, d, len(g), *n))
    assert as_set(quality.duplicate_dates(df)) == sorted(want, key=repr)


@pytest.mark.parametrize("hot_rows", [1, 7, 100, 10**9])
def test_duplicate_rows_do_not_depend_on_the_hot_limit(df, data, hot_rows):
    sizes = Counter((r[1], r[2]) for r in data)
    want = sorted(r[0] for r in data if r[2] is not None and sizes[(r[1], r[2])] > 1)
    got = quality.duplicate_date_rows(df, hot_rows=hot_rows)
    assert sorted(r["row_id"] for r in got.collect()) == want
    assert all(r["record_count"] == sizes[(r["requested_year"], r["date"])] for r in got.collect())


@pytest.mark.parametrize("hot_rows", [2, 10**9])
def test_exact_duplicates_keep_every_member_and_match_nulls(df, data, hot_rows):
    sizes = Counter(r[1:] for r in data)
    want = sorted((r[0], sizes[r[1:]]) for r in data if sizes[r[1:]] > 1)
    got = quality.exact_duplicates(df, COLS, hot_rows=hot_rows)
    assert sorted((r["row_id"], r["copies"]) for r in got.collect()) == want


def test_attach_facts_equals_a_window(df):
    facts = df.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    got = attach_facts(df, facts, ["date"], "n", "row_id", hot_rows=20).select("row_id", "n")
    want = df.select("row_id", F.count(F.lit(1)).over(W.partitionBy("date")).alias("n"))
    assert as_set(got) == as_set(want)


def test_conflicts(df, data):
    want, values = [], []
    for (y, d, t), g in groups(data, lambda r: (r[1], r[2], r[3])).items():
        seen = Counter(r[4] for r in g)
        if len(set(seen) - {None}) > 1:
            want.append((y, d, t, len(g), len(set(seen) - {None}), len({r[5] for r in g} - {None})))
            values += [(y, d, t, v, n) for v, n in seen.items()]
    assert as_set(quality.datetime_conflicts(df)) == sorted(want, key=repr)
    assert as_set(quality.conflict_values(df)) == sorted(values, key=repr)


def test_counts_with_and_without_null_keys(df, data):
    want = Counter(r[2] for r in data)
    assert dict(as_set(quality.group_sizes(df, ["date"], "n"))) == want
    del want[None]
    assert dict(as_set(quality.group_sizes(df, ["date"], "n", keep_null_keys=False))) == want


def test_reports_ignore_row_order_and_partitioning(df):
    shuffled = df.orderBy(F.rand(3)).repartition(7)
    for report in (quality.duplicate_dates, quality.year_summary, quality.time_summary, quality.datetime_conflicts):
        assert as_set(report(df)) == as_set(report(shuffled))


def test_year_summary_of_the_published_case(spark):
    """363 dates with 70 of them twice: 433 rows, 70 extra."""
    days = spark.sql(
        "select explode(sequence(0, 362)) as k"
    ).selectExpr("k", "date_add(date'2024-01-01', k) as date")
    rows = days.unionByName(days.where("k < 70")).selectExpr(
        "monotonically_increasing_id() as row_id", "2024 as requested_year", "date",
        "if(k < 200, '4:00 pm EST', '4:00 pm EDT') as time", "'2' as aqhi_raw", "'low risk' as category",
    )
    s = quality.year_summary(rows).first()
    assert (s["row_count"], s["unique_date_count"], s["unique_time_count"], s["extra_rows"]) == (433, 363, 2, 70)
    assert quality.duplicate_dates(rows).count() == 70
    assert quality.redundant_copies(rows, COLS).first()[0] == 70
    assert quality.exact_duplicates(rows, COLS).count() == 140


def test_profiles(df, data):
    got = dict(as_set(quality.null_profile(df)))
    assert got["date"] == sum(r[2] is None for r in data) and got["row_id"] == 0
    c = quality.coverage(df, ["date"], ["time"]).first()
    assert (c["row_count"], c["distinct_time"]) == (len(data), 2)
    assert quality.redundant_copies(df.limit(0), COLS).first()[0] == 0
    all_null = df.withColumn("aqhi_1", F.when(F.col("row_id") < 0, "x"))
    assert "aqhi_1" not in quality.drop_empty_column(all_null, "aqhi_1").columns
    assert "time" in quality.drop_empty_column(df, "time").columns


def test_code_frequency_names_missing_before_trimming(rows):
    df = rows([(" A ",), ("A",), (None,), ("  ",)], "code string")
    assert as_set(quality.code_frequency(df, ["code", "absent"])) == [
        ("code", "", 1), ("code", "<MISSING>", 1), ("code", "A", 2),
    ]


def test_largest_keeps_ties_and_preview_puts_nulls_last(rows):
    df = rows([(1, 5.0), (2, 7.0), (3, 7.0), (4, None)], "id int, v double")
    assert sorted(r["id"] for r in quality.largest_with_ties(df, "v").collect()) == [2, 3]
    assert [r["id"] for r in quality.preview(df, ["v", "id"], 10).collect()] == [1, 2, 3, 4]


def test_key_comparisons(rows):
    want, got = rows([("a",), ("b",)], "k string"), rows([("b",), ("c",), ("c",), (None,)], "k string")
    assert as_set(quality.expected_against_returned(want, got, "k")) == [("a", "missing"), ("c", "unexpected")]
    assert as_set(quality.orphans(got, want, "k", "k")) == [("c", 2)]


def test_keep_one_and_latest(rows):
    df = rows([(1, "x", 3), (1, "y", 2), (None, "z", 1), (None, "w", 5)], "k int, v string, o int")
    assert as_set(keep_one(df, ["k"], "o")) == sorted([(1, "y", 2, 2), (None, "z", 1, 2)], key=repr)
    assert as_set(latest(df, ["k"], ["o"])) == sorted([(1, 3, "x"), (None, 5, "w")], key=repr)


def test_missing_column_is_an_error(df):
    with pytest.raises(ValueError, match="nope"):
        quality.require_columns(df, ["date", "nope"])


def test_mixed_order_with_nulls_last(rows):
    df = rows([(2024, 1), (2024, None), (None, 5), (2024, 9), (2023, 2)], "y int, n int")
    got = [tuple(r) for r in quality.sorted_nulls_last(df, "y", "-n").collect()]
    assert got == [(2023, 2), (2024, 9), (2024, 1), (2024, None), (None, 5)]
