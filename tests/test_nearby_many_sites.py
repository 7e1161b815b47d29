import random

import pytest
from test_exposure import brute, check, points

from airshed.operators import exposure, nearby

BOX = (41.5, 57.0, -95.5, -74.0)


def exposed(spark, data, sites, **more):
    df = spark.createDataFrame(data, "uid int, date date, lat double, lon double")
    return exposure.site_exposure(df, spark.createDataFrame(sites, "city_id int, site_lat double, site_lon double"), **more)


def places(n, seed=3):
    rnd = random.Random(seed)
    return [(i, rnd.uniform(*BOX[:2]), rnd.uniform(*BOX[2:])) for i in range(n)]


def test_many_sites_are_not_sent_through_the_driver(spark, monkeypatch):
    sent, plain = [], nearby.F.broadcast
    monkeypatch.setattr(nearby.F, "broadcast", lambda df: sent.append(df.count()) or plain(df))
    data, sites = points(120), places(700)
    check(exposed(spark, data, sites), brute(data, sites))
    assert max(sent, default=0) <= 20_000


@pytest.mark.parametrize(("weight", "pairs", "crowded"), [(0, 50, 100_000), (10**9, 4_000_000, 7)])
def test_tables_of_any_size_meet_by_row_and_cell(spark, monkeypatch, weight, pairs, crowded):
    """Either table is repeated; crowded cells are shared out."""
    monkeypatch.setattr(nearby, "FEW", -1)
    monkeypatch.setattr(nearby, "ROW_AS_SITES", weight, raising=False)
    monkeypatch.setattr(nearby, "PAIRS", pairs, raising=False)
    data, sites = points(200), [*places(12), *[(99, -60.0, 179.9)] * (weight == 0)]
    check(exposed(spark, data, sites, crowded=crowded), brute(data, sites))
