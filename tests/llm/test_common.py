"""Helpers of the corpus operators."""

import random

import pytest

pytest.importorskip("airshed.llm")

import brute  # noqa: E402
from airshed.llm import common  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


@pytest.mark.parametrize("few", [0, 10**6])
def test_components_at_either_size(spark, few):
    r = random.Random(2)
    pairs = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    got = {r.node: r.component for r in common.connected(spark.createDataFrame(pairs, "a long, b long"), "t", few).collect()}
    want = brute.components({x for p in pairs for x in p}, [p for p in pairs if p[0] != p[1]])
    assert got == {i: c for i, c in want.items() if any(i in p and p[0] != p[1] for p in pairs)}


@pytest.mark.parametrize("few", [0, 10**6])
def test_no_edges_no_components(spark, few):
    assert common.connected(spark.createDataFrame([], "a long, b long"), "t", few).count() == 0


def test_kth_largest(spark):
    r = random.Random(5)
    values = [r.gauss(0, 100) for _ in range(3000)] + [1.5] * 400 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 700, 1500, 1800, 3402):
        assert common.kth_largest(df, "x", k, few=50, bins=8) == sorted(values, reverse=True)[k - 1]
    assert common.kth_largest(df, "x", 0) == float("inf") and common.kth_largest(df, "x", 10**6) == -1e9
    assert common.kth_largest(df.limit(0), "x", 3) == float("inf")
    assert common.kth_largest(df.select(F.lit(2.0).alias("x")), "x", 5, few=50) == 2.0


def test_words_are_those_of_the_pattern():
    for text in (None, "", "A-b_c é９ ẞ x y", "don't STOP", "\x85 \xa0a"):
        assert [w.decode() for w in common.words(text)] == brute.words(text)


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2)], "Kept int, _kept int")
    assert common.free_name(df, "kept") == "__kept" and common.free_name(df, "x") == "x"
