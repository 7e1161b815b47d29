import datetime as dt
import json
import math
import random

import pytest
from conftest import as_set

from airshed.config import CITIES, PROVINCE_SKETCH, SKETCH_LAKE, SKETCH_OUTER
from airshed.operators import cover, exposure
from airshed.operators.grouping import literal_rows
from airshed.sources.geojson import read_polygon


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


def points(n=600, box=(41.5, 57.0, -95.5, -74.0), seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        hot = rnd.random() < 0.34  # a third of all rows in one small spot
        lat = 48.3 + rnd.random() / 50 if hot else rnd.uniform(*box[:2])
        lon = -89.2 + rnd.random() / 50 if hot else rnd.uniform(*box[2:])
        out.append((i, dt.date(2024, 7, 1 + i % 3), lat, lon))
    return out


def brute(data, sites):
    out = {}
    for sid, la, lo in sites:
        for day in {r[1] for r in data}:
            d = [km(r[2], r[3], la, lo) for r in data if r[1] == day]
            out[(sid, day)] = (*(sum(x <= b for x in d) for b in (100, 250, 500)), min(d))
    return out


def check(df, want):
    got = {(r["city_id"], r["date"]): r for r in df.collect()}
    assert set(got) == set(want)
    for k, (a, b, c, near) in want.items():
        r = got[k]
        assert (r["hotspots_within_100km"], r["hotspots_within_250km"], r["hotspots_within_500km"]) == (a, b, c)
        assert r["nearest_hotspot_distance_km"] == pytest.approx(near, abs=1e-6)


def test_city_exposure_equals_brute_force(spark):
    data = points()
    df = spark.createDataFrame(data, "uid int, date date, lat double, lon double")
    check(exposure.city_exposure(df), brute(data, [(c[0], c[3], c[4]) for c in CITIES]))


@pytest.mark.parametrize(("cell", "crowded"), [(0.1, 100_000), (0.25, 1), (2.0, 10)])
@pytest.mark.parametrize("box", [(41.5, 57.0, -95.5, -74.0), (-20.0, 20.0, 170.0, 179.9), (70.0, 88.0, -180.0, 180.0)])
def test_cell_join_equals_brute_force(spark, cell, crowded, box):
    if cell == 0.1 and box[1] > 80:
        pytest.skip("polar cells this small are many")
    data = points(300, box)
    rnd = random.Random(1)
    sites = [(i, rnd.uniform(*box[:2]), rnd.uniform(*box[2:])) for i in range(6)] + [(99, box[0], -179.9)]
    df = spark.createDataFrame(data, "uid int, date date, lat double, lon double")
    got = exposure.site_exposure(df, literal_rows(spark, ["city_id", "site_lat", "site_lon"], sites), cell_degrees=cell, crowded=crowded)
    check(got, brute(data, sites))


def test_cities_do_not_change_one_another(spark):
    data = points(200, (41.5, 57.0, -95.5, -74.0)) + [(900, dt.date(2024, 9, 9), 57.0, -95.0)]
    df = spark.createDataFrame(data, "uid int, date date, lat double, lon double")
    cities = [(i, f"c{i}", "r", 42.0 + i / 16, -74.0 - i / 16) for i in range(44)]
    check(exposure.city_exposure(df, cities), brute(data, [(c[0], c[3], c[4]) for c in cities]))
    alone = exposure.city_exposure(df, cities[:4])
    among = exposure.city_exposure(df, cities).where("city_id < 4")
    assert as_set(alone) == as_set(among) and alone.where("date = date'2024-09-09'").count() == 4


def inside(lat, lon, ring):
    odd = False
    for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]]):
        if (a > lat) != (c > lat) and lon < b + (lat - a) / (c - a) * (d - b):
            odd = not odd
    return odd


def test_point_in_polygon_equals_ray_casting(spark, tmp_path):
    data = points(800) + [(1000 + i, dt.date(2024, 7, 1), 46.6 + i / 40, -88.2 + i / 13) for i in range(40)]
    corners = [*SKETCH_OUTER, *SKETCH_LAKE]
    data += [(9000 + i, dt.date(2024, 7, 1), *p) for i, p in enumerate(corners)] + [(9999, dt.date(2024, 7, 1), None, -80.0)]
    df = spark.createDataFrame(data, "uid int, date date, lat double, lon double")
    held = [r for r in data if r[2] is not None and sum(inside(r[2], r[3], ring) for ring in PROVINCE_SKETCH) % 2]
    want = sorted(r[0] for r in held)
    assert 0 < len(want) < len(data) and any(inside(r[2], r[3], SKETCH_LAKE) for r in data if r[2])
    for band in (0.5, 7.0):
        got = exposure.inside_outline(df, PROVINCE_SKETCH, first_degrees=band)
        assert got.columns == df.columns and sorted(r["uid"] for r in got.collect()) == want
    total = sum(r["total_hotspots"] for r in exposure.province_daily_totals(exposure.inside_outline(df, PROVINCE_SKETCH)).collect())
    assert total == len(want)
    closed = [[[lon, lat] for lat, lon in [*ring, ring[0]]] for ring in PROVINCE_SKETCH]
    for shape in (
        {"type": "Polygon", "coordinates": closed},
        {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": closed}},
        {"type": "FeatureCollection", "features": [{"geometry": {"type": "MultiPolygon", "coordinates": [[closed[0]], [closed[1]]]}}]},
    ):
        (tmp_path / "p.geojson").write_text(json.dumps(shape, indent=1))
        vertices = read_polygon(spark, str(tmp_path / "p.geojson"))
        assert sorted(r["uid"] for r in cover.inside_polygon(df, vertices).collect()) == want


def wiggly(n, lat, lon, size, seed):
    """A ring of n corners around a place, with bays; it does not cross itself."""
    r = random.Random(seed)
    turns = [2 * math.pi * i / n for i in range(n)]
    return [(lat + size * math.sin(t) * (k := r.uniform(0.8, 1.0)), lon + size * math.cos(t) * k) for t in turns]


def test_cover_of_a_long_boundary(spark, monkeypatch):
    rings = [wiggly(4000, 48.0, -85.0, 4.0, 1), wiggly(500, 48.5, -85.5, 1.0, 2), [(50.0, -80.0), (50.0, -79.5), (50.5, -79.5), (50.5, -80.0)]]
    rnd = random.Random(3)
    data = [(i, rnd.uniform(43, 53), rnd.uniform(-91, -78.5)) for i in range(400)]
    data += [(1000 + i, *p) for i, p in enumerate(rings[0][:60])]  # corners
    data += [(2000 + i, 48.0 + 4 * rnd.uniform(0.8, 1.0) * math.sin(i), -85.0 + 4 * rnd.uniform(0.8, 1.0) * math.cos(i)) for i in range(200)]
    data += [(3000 + 10 * i + j, 50.0 + i / 4, -80.0 + j / 4) for i in range(4) for j in range(4)]  # on grid lines and sides
    df = spark.createDataFrame(data, "uid int, lat double, lon double")
    vertices = exposure.outline_vertices(spark, rings)
    want = sorted(i for i, la, lo in data if sum(inside(la, lo, ring) for ring in rings) % 2)
    assert sorted(r["uid"] for r in cover.inside_polygon(df, vertices).collect()) == want
    assert sorted(r["uid"] for r in cover.by_latitude(df, vertices).collect()) == want
    seen = cover.edges_seen(df, vertices).first()
    assert seen["points"] == len(data) > seen["in_cut_cells"] and 10 * seen["edges_by_cover"] < seen["edges_by_band"]
    assert len(cover.cover(vertices)) > 1
    monkeypatch.setattr(cover, "FEW_EDGES", 3)
    assert sorted(r["uid"] for r in cover.inside_polygon(df, vertices, 2.0, 3).collect()) == want


def test_empty_polygon_holds_nothing(spark):
    df = spark.createDataFrame([(1, 50.0, -80.0)], "uid int, lat double, lon double")
    none = spark.createDataFrame([], "ring int, seq int, lat double, lon double")
    assert cover.inside_polygon(df, none).count() == 0


def test_box_and_period(spark):
    df = spark.sql(
        "select * from values (1, timestamp_ntz'2026-07-01 00:00:00', 41.5D, -95.5D), (2, timestamp_ntz'2026-07-03 23:59:59', 57D, -74D),"
        " (3, timestamp_ntz'2026-07-04 00:00:00', 45D, -80D), (4, timestamp_ntz'2026-07-02 00:00:00', 41.4D, -80D),"
        " (5, null, 45D, -80D) as t(uid, rep_date, lat, lon)"
    )
    got = exposure.bbox_time_filter(df, "2026-07-01", "2026-07-03")
    assert as_set(got.select("uid")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        exposure.bbox_time_filter(df, "2026-07-03", "2026-07-01")
    with pytest.raises(ValueError):
        exposure.bbox_time_filter(df, "July 1", "2026-07-01")


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "hot")
    data = [(i, dt.datetime(2026, 7, 1), a, b, "x") for i, _, a, b in points(20)]
    spark.createDataFrame(data, "uid int, rep_date timestamp_ntz, lat double, lon double, agency string").write.parquet(path)
    df = spark.read.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    for picked in (exposure.bbox_time_filter(df, "2026-07-01", "2026-07-03"), exposure.inside_outline(df, PROVINCE_SKETCH)):
        plan = picked.select("uid")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(lat" in plan and "LessThanOrEqual(lon" in plan
        assert "agency" not in plan
