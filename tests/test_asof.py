import bisect
import datetime as dt
import random

import pytest

from airshed.operators import asof

D0 = dt.date(2024, 1, 1)


@pytest.mark.parametrize("range_rows", [9, 10**6])
def test_last_state_at_or_before_the_moment(spark, range_rows):
    r = random.Random(4)
    key = lambda: None if r.random() < 0.05 else "hot" if r.random() < 0.5 else f"k{r.randrange(9)}"
    day = lambda: None if r.random() < 0.05 else D0 + dt.timedelta(r.randrange(60))
    states = [(key(), day(), r.choice(["OC", "BH", None]), r.randrange(5)) for _ in range(150)]
    rows = [(i, key(), day(), "kept") for i in range(200)] + [(999, "nobody", D0, "kept")] * 2
    got = asof.state_as_of(
        spark.createDataFrame(rows, "id int, fire string, at date, stage2 string").repartition(3),
        spark.createDataFrame(states, "fire string, since date, stage string, size int").repartition(2),
        ["fire"], "at", "since", ["stage", "size"], range_rows,
    )
    assert got.columns == ["id", "fire", "at", "stage2", "stage", "size"]
    rank = lambda v: tuple((x is not None, x) for x in v)
    want = []
    for i, k, at, kept in rows:
        known = sorted(((s[1], rank(s[2:]), s[2:]) for s in states if s[0] == k and s[1] is not None), key=lambda x: x[:2])
        n = bisect.bisect_right([s[0] for s in known], at) if at else 0
        want.append((i, k, at, kept, *(known[n - 1][2] if n else (None, None))))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    rows = spark.createDataFrame([("a", D0)], "fire string, at date")
    states = spark.createDataFrame([], "fire string, since date, stage string")
    assert [tuple(r) for r in asof.state_as_of(rows, states, ["fire"], "at", "since", ["stage"]).collect()] == [("a", D0, None)]
    assert asof.state_as_of(rows.limit(0), states, ["fire"], "at", "since", ["stage"]).count() == 0
