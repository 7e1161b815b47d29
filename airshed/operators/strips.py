"""Points within distances of sites, from running counts along strips of latitude.

A circle cuts a strip in two stretches of columns: one lies wholly inside, a wider one holds all that may be
inside. The inner one is counted for each day by two look-ups; only positions between the two are measured.
Strips are as high as makes look-ups and measurements cost alike, so the work of a site grows with the root
of the number of positions. A piece of a strip, with all its arrays, is one row; a site meets the pieces of a
slab of strips in one task, so its counts are added up there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.config import EARTH_RADIUS_KM
from airshed.functions.geo import haversine_km
from airshed.session import settle

KM_PER_DEGREE = 111.2  # a little more than a degree of latitude
LESS_PER_DEGREE = 111.19  # a little less
SLACK_KM = 0.001  # for rounding; what it takes in is measured exactly afterwards
PIECE = 20_000  # positions of a piece; it has twice as many at most
PIECE_DAYS = 32  # days of a piece; one more at most
SECTOR = 4096  # columns of a piece
SLABS = 8  # slabs of strips that a site meets; one more at most
WORK = 10_000_000  # sites of a slab, times its strips and days, that one task looks up
NEAR = 12  # hotspots a day within the distance first searched for the nearest, were they spread evenly
TIE = 1e-12  # products of vectors are exact to far less
ODDS = 3.0  # what a strip's look-ups for a day cost, in measured positions
HEMISPHERE_KM = 10_000  # a wider circle is measured as a whole


class Strips:
    """``rows`` strips a hemisphere; rows from the equator, columns (half as wide) from Greenwich."""

    def __init__(self, rows: int):
        self.rows, self.w, self.width = rows, 90 / rows, 8 * rows
        self.wc = 360 / self.width

    def row(self, lat: str) -> str:
        return f"least(int(floor({lat} / {self.w}D)), {self.rows - 1})"

    def col(self, lon: str) -> str:
        return f"pmod(int(floor({lon} / {self.wc}D)), {self.width})"


def _half(share: str) -> str:
    """SQL text of half the width, in degrees, of a circle at some latitude; negative where it doesn't reach."""
    return f"case when {share} < 0 then -1D when {share} >= 1 then 180D else degrees(2 * asin(sqrt({share}))) end"


def _spot(lat: str, lon: str) -> str:
    """SQL text of a place: latitude, longitude, and its vector on a sphere of radius 1."""
    cos_lat = f"cos(radians({lat}))"
    return f"array({lat}, {lon}, {cos_lat} * cos(radians({lon})), {cos_lat} * sin(radians({lon})), sin(radians({lat})))"


def _square(x: str) -> str:
    return f"({x}) * ({x})"


def plan(at: DataFrame, bands: Sequence[int], day: str) -> tuple[Strips, float, int]:
    """The strips for these positions, the distance first searched for the nearest, and the number of days."""
    n_days = at.select(F.struct(day).alias("d")).distinct().count()
    seen = at.groupBy(F.floor("lat").alias("a"), F.floor("lon").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    n, area = seen.selectExpr("sum(n)", f"sum(cos(radians(least(a + 0.5D, 89D)))) * {KM_PER_DEGREE**2}D").first()
    widest, around = max(*bands, 1), sum(max(b, 1) for b in bands)
    a_day = max(n or 0, 1) / max(n_days, 1) / max(area or 0, math.pi * widest**2)  # positions a square km
    high = math.sqrt(ODDS * 2 * widest / (5.3 * around * a_day))
    rows = min(max(round(90 * KM_PER_DEGREE / high), 18), 18_000)
    return Strips(rows), min(math.sqrt(NEAR / math.pi / a_day), widest), n_days


def _days(placed: DataFrame) -> DataFrame:
    """Per row, sector and day its number and piece, and the number of shares of a day with too many positions for one."""
    days = placed.groupBy("row", "sector", "day").agg(F.count(F.lit(1)).alias("n_at"))
    by_day = Window.partitionBy("row", "sector").orderBy("day")
    weight = F.sum(F.expr(f"greatest(n_at, {PIECE // PIECE_DAYS})"))
    days = days.withColumn("no", F.row_number().over(by_day))
    days = days.withColumn("before", weight.over(by_day.rowsBetween(Window.unboundedPreceding, -1)))
    return days.selectExpr(
        "row", "sector", "day", "no", f"int(coalesce(before, 0) / {PIECE}) as piece", f"int(ceil(n_at / {PIECE}D)) as shares"
    )


def _pieces(placed: DataFrame, days: DataFrame, few: int) -> DataFrame:
    """One row per piece: its days; its positions in order of their columns (five numbers each in spots, then ns,
    and dis, the place of the day); rank, the positions before each column from the first to behind the last; sums, for each
    column and day the points before it, but for a number that is the same for all columns of a day."""
    placed = placed.join(F.broadcast(days) if days.count() <= few else days, ["row", "sector", "day"])
    placed = placed.selectExpr("*", "int(pmod(xxhash64(lat, lon), shares)) as share", f"{_spot('lat', 'lon')} as spot")
    key = ["row", "sector", "piece", "share"]
    by_cell = Window.partitionBy(*key).orderBy("no", "col")
    placed = placed.withColumns(
        {
            "before": F.coalesce(F.sum("n").over(by_cell.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "place": F.row_number().over(by_cell),
        }
    )
    by_day = Window.partitionBy(*key).orderBy("no")
    placed = placed.withColumns({"d": F.dense_rank().over(by_day) - 1, "opens": F.rank().over(by_day) == F.col("place")})
    rows = placed.groupBy(*key).agg(
        F.collect_list(F.struct("place", "spot", "n", "d", "col", "before")).alias("p"),  # at most twice PIECE
        F.array_sort(F.collect_list(F.when(F.col("opens"), F.struct("d", "day")))).alias("days"),
        F.min("col").alias("first"),
        F.expr("max(col) - min(col) + 2").alias("stride"),
        F.expr("coalesce(sum(n), 0)").alias("total"),
    )
    # The rows mostly come in order. By column, numbers are sorted, which is much faster than structs.
    rows = rows.withColumn("p", F.expr("if(p.place = sequence(1, size(p)), p, array_sort(p))"))
    rows = rows.withColumn("by_col", F.expr("sort_array(transform(p, x -> bigint(x.col) * 4294967296 + x.place))"))
    rows = rows.selectExpr(
        *key, "days", "first", "stride", "total",
        "p.before as befores",
        "zip_with(p.d, p.col, (d, c) -> d * stride + c - first) as js",
        "transform(by_col, b -> p[int(b % 4294967296) - 1]) as p",
    ).selectExpr(
        "*",
        f"{_steps('p.col', 'first - 1')} as gaps",
        f"{_steps('js', '-1')} as js_gaps",
    )
    rows = rows.selectExpr(
        *key,
        "transform(days, x -> x.day.of) as days",
        "first",
        "stride",
        "flatten(p.spot) as spots",
        "p.n as ns",
        "p.d as dis",
        "concat(flatten(transform(gaps, (g, i) -> array_repeat(i, g))), array(size(p))) as rank",
        "concat(flatten(zip_with(befores, js_gaps, (n, g) -> array_repeat(n, g))),"
        " array_repeat(total, size(days) * stride - 1 - element_at(js, -1))) as by_day",
    )
    # The days of a column side by side, as they are looked up together.
    turned = "transform(sequence(0, size(by_day) - 1), x -> by_day[x % size(days) * stride + int(x / size(days))]) as sums"
    return rows.selectExpr(*key, "first", "stride", "rank", "days", "spots", "ns", "dis", turned)


def _steps(x: str, before: str) -> str:
    """SQL text of an array's steps from element to element."""
    return f"zip_with({x}, slice(concat(array({before}), {x}), 1, size({x})), (x, y) -> x - y)"


def _deal(days: DataFrame, near: DataFrame, cores: int) -> DataFrame:
    """The pieces of each slab that belong together, each with the number of tasks that share the slab's sites."""
    parts = days.groupBy("slab", "sector", "piece").agg(F.max("shares").alias("shares"), F.count(F.lit(1)).alias("strip_days"))
    parts = parts.join(near.groupBy("slab").agg(F.count(F.lit(1)).alias("n_sites")), "slab")
    parts = settle(
        parts.selectExpr("slab", "sector", "piece", "explode(sequence(0, shares - 1)) as share", "double(n_sites) * strip_days as work"),
        "slab-parts",
    )
    a_task = max(min(parts.agg(F.sum("work")).first()[0] or 1, 4 * cores * WORK) / (4 * cores), 1)
    return parts.selectExpr("slab", "sector", "piece", "share", f"int(ceil(work / {a_task}D)) as salts")


def _stretches(met: DataFrame, grid: Strips, reach: Sequence[float], near: float) -> DataFrame:
    """Sites with pieces. For each circle i: where among the positions its stretches begin and end (s{i}_0 to
    s{i}_3); and three numbers in looks, where in the sums the inner one ends and begins, and how often it
    passes the seam. A column that goes on behind the seam is looked up at j in the piece, k times around the globe."""
    circles = [*reach, near]
    sin = lambda x: f"sin(radians({x}) / 2)"
    low, high = f"row * {grid.w}D", f"(row + 1) * {grid.w}D"
    out = met.selectExpr(
        "*",
        "cos(radians(site_lat)) as cos_s",
        "site[4] as sin_s",
        f"sin(radians({low})) as sin_1",
        f"sin(radians({high})) as sin_2",
        f"{_square(sin(f'{low} - site_lat'))} as u1",
        f"{_square(sin(f'{high} - site_lat'))} as u2",
        f"greatest(cos(radians({low})) * cos(radians(site_lat)), 1e-40D) as v1",
        f"greatest(cos(radians({high})) * cos(radians(site_lat)), 1e-40D) as v2",
    )
    shares, halves, columns = [], [], []
    for i, km in enumerate(circles):
        less, more = (math.sin(max(x, 0) / 2 / EARTH_RADIUS_KM) ** 2 for x in (km - SLACK_KM, km + SLACK_KM))
        angle = (km + SLACK_KM) / EARTH_RADIUS_KM
        inside, wide = SLACK_KM < km <= HEMISPHERE_KM and i < len(reach), km > HEMISPHERE_KM
        shares += [
            f"least(({less!r}D - u1) / v1, ({less!r}D - u2) / v2) as m{i}",
            f"greatest(({more!r}D - u1) / v1, ({more!r}D - u2) / v2) as x{i}",
        ]
        # Where a circle is widest, it may be wider than at the strip's sides.
        widest = f"sin_s >= sin_1 * {math.cos(angle)!r}D and sin_s <= sin_2 * {math.cos(angle)!r}D"
        at_widest = f"degrees(asin(least(1D, {math.sin(angle)!r}D / greatest(cos_s, 1e-40D))))"
        halves += [
            f"{_half(f'm{i}') if inside else '-1D'} as in{i}",
            "180D as out" + str(i) if wide else f"greatest({_half(f'x{i}')}, if({widest}, {at_widest}, -1D)) as out{i}",
        ]
        columns += [
            f"int(ceil((site_lon - in{i}) / {grid.wc}D)) as a{i}",
            f"int(floor((site_lon + in{i}) / {grid.wc}D)) as z{i}",
            f"int(floor((site_lon - out{i}) / {grid.wc}D)) as o{i}",
            f"int(floor((site_lon + out{i}) / {grid.wc}D)) + 1 as e{i}",
        ]
    out = out.selectExpr("*", *shares).selectExpr("*", *halves).selectExpr("*", *columns)
    w, ends, found = grid.width, [], []
    for i in range(len(circles)):
        a, z, o, e = f"a{i}", f"z{i}", f"o{i}", f"e{i}"
        ends.append(
            f"case when out{i} < 0 then array(0, 0, 0, 0) when in{i} >= 180 then array(0, 0, {w}, {w})"
            f" when (out{i} >= 180 or {e} - {o} >= {w}) and (in{i} < 0 or {a} >= {z}) then array(0, 0, 0, {w})"
            f" when out{i} >= 180 or {e} - {o} >= {w} then array({a}, {a}, {z}, {a} + {w})"
            f" when in{i} < 0 or {a} >= {z} then array({o}, {o}, {o}, {e}) else array({o}, {a}, {z}, {e}) end as c{i}"
        )
        for n in range(4):
            found += [
                f"least(greatest(pmod(c{i}[{n}], {w}) - first, 0), stride - 1) as j{i}_{n}",
                f"int(floor(c{i}[{n}] / {w}D)) as k{i}_{n}",
            ]
    looks = [f"j{i}_2 * size(days), j{i}_1 * size(days), k{i}_2 - k{i}_1" for i in range(len(reach))]
    spots = [f"rank[j{i}_{c}] + k{i}_{c} * size(ns) as s{i}_{c}" for i in range(len(circles)) for c in range(4)]
    # Few columns, as functions with hundreds of arguments are not compiled.
    kept = ["city_id", "site", "days", "spots", "ns", "dis", "sums"]
    return out.selectExpr("*", *ends).selectExpr("*", *found).selectExpr(*kept, f"array({', '.join(looks)}) as looks", *spots)


def within(at: DataFrame, sites: DataFrame, bands: Sequence[int], day: str, few: int) -> tuple[DataFrame, float, int]:
    """(city_id, day, w.. per band, km), without sites and days of which nothing was met: the points within
    each band, and the nearest of the positions measured. Also the distance within which a nearest is the
    nearest of all, and the number of days. at: day, lat, lon, and n, the points there."""
    grid, near_km, n_days = plan(at, bands, day)
    far = (max(*bands, near_km) + SLACK_KM) / LESS_PER_DEGREE
    slab = max(1, math.ceil(2 * far / grid.w / SLABS))
    # Never null; said so, the arrays are read without a look for nulls.
    at = at.selectExpr(f"named_struct('of', {day}) as day", *[f"coalesce({c}, 0) as {c}" for c in ("lat", "lon", "n")])
    sites = sites.selectExpr("city_id", *[f"coalesce({c}, 0) as {c}" for c in ("site_lat", "site_lon")])
    placed = at.selectExpr("*", f"{grid.row('lat')} as row", f"{grid.col('lon')} as col")
    placed = placed.selectExpr("*", f"int(floor(col / {SECTOR})) as sector")
    days = settle(_days(placed), "strip-days")
    low, high = (f"int(floor({grid.row(f'(site_lat {sign} {far}D)')} / {slab}))" for sign in "-+")
    near = sites.selectExpr("city_id", "site_lat", "site_lon", f"explode(sequence({low}, {high})) as slab")
    in_slab = f"int(floor(row / {slab})) as slab"
    deal = settle(_deal(days.selectExpr("*", in_slab), near, at.sparkSession.sparkContext.defaultParallelism), "slab-tasks")
    deal = F.broadcast(deal) if deal.count() <= few else deal
    part = ["slab", "sector", "piece", "share"]
    pieces = _pieces(placed, days, few).selectExpr("*", in_slab).join(deal, part)
    pieces = pieces.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).drop("salts")
    near = near.join(deal, "slab").withColumn("salt", F.expr("int(pmod(xxhash64(city_id, site_lat, site_lon), salts))")).drop("salts")
    near = near.selectExpr("*", f"{_spot('site_lat', 'site_lon')} as site")
    # What Spark expects of a table's size leaves out how often its rows are repeated; so the join is named.
    met = _stretches(near.join(pieces.hint("merge"), [*part, "salt"]), grid, bands, near_km)
    n = len(bands)
    whole = " or ".join(f"s{i}_2 > s{i}_1" for i in range(n))
    # Points on a sphere of radius 1 are as near as the product of their vectors is great. Where it can't tell, and
    # for the nearest, the distance itself is asked for. Testing the product twice is cheap, and most rows end there.
    product = "(site[2] * spots[at * 5 + 2] + site[3] * spots[at * 5 + 3] + site[4] * spots[at * 5 + 4])"
    ranges = [f"named_struct('kind', -1, 'km', 0D, 'least', 0D, 'from', 0, 'to', if({whole}, size(days), 0))"]
    for i, b in enumerate(bands):
        least = f"'km', {float(b)!r}D, 'least', {math.cos(min(b / EARTH_RADIUS_KM, math.pi)) - TIE!r}D"
        ranges += [f"named_struct('kind', {i}, {least}, 'from', s{i}_{c}, 'to', s{i}_{c + 1})" for c in (0, 2)]
    ranges.append(f"named_struct('kind', {n}, 'km', 0D, 'least', -2D, 'from', s{n}_0, 'to', s{n}_3)")
    kept = ["city_id", "site", "days", "spots", "ns", "dis", "sums", "looks"]
    one = met.selectExpr(*kept, f"inline(array({', '.join(ranges)}))").where("to > from")
    one = one.selectExpr(*kept, "kind", "km as limit", "least", "explode(sequence(from, to - 1)) as i")
    one = one.selectExpr("*", "if(kind < 0, 0, pmod(i, size(ns))) as at").where(f"kind < 0 or {product} >= least")
    distance = haversine_km("spots[at * 5]", "spots[at * 5 + 1]", "site[0]", "site[1]")
    asked = F.expr(f"kind = {n} or kind >= 0 and {product} < least + {2 * TIE!r}D")
    one = one.withColumns({"d": F.expr("if(kind < 0, i, dis[at])"), "measured": F.when(asked, distance)})
    one = one.withColumn("held", F.expr(f"if(kind = {n} or measured > limit, 0L, ns[at])"))
    inside = []
    for i in range(n):
        around = f"looks[{3 * i + 2}] * (sums[size(sums) - size(days) + d] - sums[d])"
        looked_up = f"sums[looks[{3 * i}] + d] - sums[looks[{3 * i + 1}] + d] + if(looks[{3 * i + 2}] = 0, 0, {around})"
        inside.append(f"case when kind < 0 then {looked_up} when kind = {i} then held else 0 end as w{i}")
    one = one.selectExpr("city_id", "days[d] as day", *inside, f"if(kind = {n}, measured, null) as km")
    summed = one.groupBy("city_id", F.col("day").alias(day)).agg(
        *[F.sum(f"w{i}").alias(f"w{b}") for i, b in enumerate(bands)], F.min("km").alias("km")
    )
    return summed, near_km, n_days
