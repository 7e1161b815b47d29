import datetime as dt
import random

import pytest
from test_exposure import brute, check, km, points
from test_nearby_many_sites import places

from airshed.operators import exposure, nearby, strips

HOT = "uid int, date date, lat double, lon double"
SITE = "city_id int, site_lat double, site_lon double"


def rows_made(df):
    """Runs the table; the rows that its joins and generators make."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("numOutputRows") if "Join" in name or "Generate" in name else None
        return (own.get().value() if own else 0) + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_work_grows_with_the_root_of_the_positions(spark, monkeypatch):
    """Sixteen times the hotspots: four times the work, not sixteen times."""
    made, plain = [], nearby.settle
    monkeypatch.setattr(nearby, "settle", lambda df, name: (made.append(rows_made(df)) if name == "exposure" else None) or plain(df, name))
    rnd, work = random.Random(7), []
    for n in (2_000, 32_000):
        data = [(i, dt.date(2024, 7, 1 + i % 2), rnd.uniform(41.5, 57.0), rnd.uniform(-95.5, -74.0)) for i in range(n)]
        made.clear()
        exposure.site_exposure(spark.createDataFrame(data, HOT), spark.createDataFrame(places(40), SITE)).count()
        work.append(sum(made))
    assert work[1] < 6 * work[0]


BOXES = {"plain": (41.5, 57.0, -95.5, -74.0), "seam": (-20.0, 20.0, 170.0, 179.99), "pole": (-90.0, -84.0, -180.0, 180.0)}


@pytest.mark.parametrize("few", [20_000, -1])
@pytest.mark.parametrize("box", BOXES)
def test_small_pieces_equal_brute_force(spark, monkeypatch, box, few):
    for name, value in (("PIECE", 8), ("PIECE_DAYS", 2), ("SECTOR", 40), ("WORK", 20), ("ODDS", 0.1), ("NEAR", 2)):
        monkeypatch.setattr(strips, name, value)
    monkeypatch.setattr(nearby, "FEW", few)
    (south, north, west, east), rnd = BOXES[box], random.Random(2)
    data = points(160, BOXES[box])
    data += [(1000 + i, d, south + 1, west) for i in range(9) for d in (dt.date(2024, 7, 2), None)]  # one position
    data += [(2000 + i, None, rnd.uniform(south, north), rnd.uniform(west, east)) for i in range(5)]
    data += [(3000 + i, dt.date(2024, 7, 1), north, lon) for i, lon in enumerate((-180.0, 180.0, 0.0))]
    sites = [(i, rnd.uniform(south, north), rnd.uniform(west, east)) for i in range(4)]
    sites += [(None, south, 180.0), (90, south, -180.0), (91, north, west), (92, 48.31, -89.19)]
    check(exposure.site_exposure(spark.createDataFrame(data, HOT), spark.createDataFrame(sites, SITE)), brute(data, sites))


def test_bands_of_any_width(spark):
    """Circles smaller than a strip, of no width, across both poles, and wider than half the globe."""
    bands, data = [0, 1, 5_000, 9_990, 12_000, 21_000], points(120, (-90.0, 90.0, -180.0, 180.0))
    sites = [(1, data[0][2], data[0][3]), (2, 89.0, 10.0), (3, -90.0, 0.0), (4, 0.0, 179.0), (5, 12.0, -100.0)]
    got = exposure.site_exposure(spark.createDataFrame(data, HOT), spark.createDataFrame(sites, SITE), bands=bands).collect()
    every = {(r["city_id"], r["date"]): tuple(r[f"hotspots_within_{b}km"] for b in bands) for r in got}
    for site, lat, lon in sites:
        for day in {r[1] for r in data}:
            far = [km(r[2], r[3], lat, lon) for r in data if r[1] == day]
            assert every[site, day] == tuple(sum(x <= b for x in far) for b in bands)
