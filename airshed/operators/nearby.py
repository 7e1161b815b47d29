"""Points around sites: within distances (``strips``), and the nearest, by the rows of a grid.

A row holds the filled cells of one day and one strip of latitude, in order of their columns, as a few
arrays: the columns, and, for every column, how many filled cells lie west of it. So the filled cells beside
a place are found by one look-up, however many cells or points there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.config import EARTH_RADIUS_KM
from airshed.functions.geo import haversine_km
from airshed.operators import strips
from airshed.operators.strips import KM_PER_DEGREE, LESS_PER_DEGREE, SLACK_KM
from airshed.session import settle

FEW = 20_000  # rows of a small table (a few numbers each) that is sent to all tasks, by way of the driver
SALTS = 64
ROW_AS_SITES = 8  # a grid row's arrays are as long as so many sites


class Grid:
    """Cells of ``w`` degrees (a divisor of 90); rows from the equator, columns from Greenwich."""

    def __init__(self, w: float):
        self.w, self.width, self.top = w, round(360 / w), round(90 / w) - 1
        self.half = w * KM_PER_DEGREE * 0.7072 + 0.01  # no point of a cell lies farther from its centre

    def row(self, lat: str) -> str:
        return f"least(int(floor({lat} / {self.w}D)), {self.top})"

    def col(self, lon: str) -> str:
        return f"pmod(int(floor({lon} / {self.w}D)), {self.width})"

    def centre_km(self, row: str, col: str, lat: str, lon: str) -> str:
        """SQL text of the distance to a cell's centre."""
        a, d = f"radians(({row} + 0.5D) * {self.w}D)", f"radians(({col} + 0.5D) * {self.w}D - {lon})"
        return (
            f"2 * {EARTH_RADIUS_KM}D * asin(least(1D, sqrt(pow(sin(({a} - radians({lat})) / 2), 2)"
            f" + cos({a}) * cos(radians({lat})) * pow(sin({d} / 2), 2))))"
        )

    def stretch(self, km: str, row: str, lat: str, lon: str) -> str:
        """SQL text of the struct (a, n): first column, and number of columns, of the cells of a row
        whose centres lie within ``km``."""
        a = f"radians(({row} + 0.5D) * {self.w}D)"
        share = (
            f"((pow(sin(least({km}, {EARTH_RADIUS_KM}D * pi()) / {2 * EARTH_RADIUS_KM}D), 2) - pow(sin(({a} - radians({lat})) / 2), 2))"
            f" / greatest(cos({a}) * cos(radians({lat})), 1e-12D))"
        )
        reach = f"degrees(2 * asin(sqrt(greatest(0D, least(1D, {share})))))"
        first = f"int(ceil(({lon} - {reach}) / {self.w}D - 0.5D))"
        count = f"int(floor(({lon} + {reach}) / {self.w}D - 0.5D)) - {first} + 1"
        none, every = "named_struct('a', 0, 'n', 0)", f"named_struct('a', 0, 'n', {self.width})"
        return (
            f"case when {km} < 0 or {share} < 0 then {none} when {share} >= 1 or {count} >= {self.width} then {every}"
            f" else named_struct('a', pmod({first}, {self.width}), 'n', greatest({count}, 0)) end"
        )

    def west(self, c: str) -> str:
        """SQL text of the number of filled cells west of column ``c``: one look-up."""
        return f"(case when {c} <= cols[0] then 0 when {c} > at_last then size(cols) else rank[{c} - cols[0]] end)"

    def cells_in(self, s: str) -> str:
        """SQL text of the positions, in the row's arrays, of the filled cells in the stretch ``s``."""
        end = f"{s}.a + {s}.n"

        def some(a: str, b: str) -> str:
            return f"if({b} > {a}, sequence({a}, {b} - 1), array())"

        whole = some(self.west(f"{s}.a"), self.west(f"least({end}, {self.width})"))
        return f"concat({whole}, if({end} > {self.width}, {some('0', self.west(f'({end} - {self.width})'))}, array()))"


def positions(points: DataFrame, day: str) -> DataFrame:
    """Distinct positions of a day with their number of points. Points without a place are left out."""
    return points.where("lat is not null and lon is not null").groupBy(day, "lat", "lon").agg(F.count(F.lit(1)).alias("n"))


def prefix_rows(at: DataFrame, grid: Grid, day: str, crowded: int) -> DataFrame:
    """One row per day and grid row: cols, slots (tasks that share a cell), rank (filled cells west of each
    column from the first to the last), at_last."""
    cells = at.groupBy(day, "row", "col").agg(F.expr(f"int(ceil(count(1) / {crowded}D))").alias("slots"))
    rows = cells.groupBy(day, "row").agg(F.array_sort(F.collect_list(F.struct("col", "slots"))).alias("c"))  # at most a row's cells
    return rows.selectExpr(
        day,
        "row",
        "c.col as cols",
        "c.slots as slots",
        "flatten(transform(c.col, (x, i) -> array_repeat(i, if(i = 0, 1, x - c.col[i - 1])))) as rank",
        "c.col[size(c) - 1] as at_last",
    )


def _site_rows(sites: DataFrame, grid: Grid, inner: int, outer: int) -> DataFrame:
    """Sites with each grid row that lies more than ``inner`` and at most ``outer`` rows from theirs, and the
    columns that a row is asked for (``asked``): the two on either side of the site."""
    here = grid.row("site_lat")
    low, high = f"greatest({here} - {outer}, {-grid.top - 1})", f"least({here} + {outer}, {grid.top})"
    rows = sites.selectExpr("city_id", "site_lat", "site_lon", f"explode(sequence({low}, {high})) as row")
    beside = f"site_lon / {grid.w}D - 0.5D"
    asked = [f"pmod(int(ceil({beside})), {grid.width})", f"pmod(int(floor({beside})), {grid.width}) + 1"]
    return rows.where(f"abs(row - {here}) > {inner}").selectExpr("*", f"array({', '.join(asked)}) as asked")


def _met(rows: DataFrame, near: DataFrame, n_rows: int, n_near: int, day: str) -> DataFrame:
    """Rows of every day with the sites they lie near. A few sites are sent to the rows. Otherwise both are
    dealt by row, the larger table over ``SALTS`` shares of each row, for which the smaller is repeated."""
    if n_near <= FEW:
        return rows.join(F.broadcast(near), "row")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    share = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
    by_site = n_rows * ROW_AS_SITES <= n_near
    rows = rows.withColumn("salt", every if by_site else share(day))
    near = near.withColumn("salt", share("city_id") if by_site else every)
    # What Spark expects of a table's size leaves out how often its rows are repeated; so the join is named.
    return rows.join(near.hint("merge"), ["row", "salt"]).drop("salt")


def exposure_of_sites(
    hotspots: DataFrame, sites: DataFrame, bands: Sequence[int], day: str, cell_degrees: float, crowded: int
) -> DataFrame:
    """Per site and day with hotspots: hotspots within each band, and the distance to the nearest one."""
    at = settle(positions(hotspots, day), "positions")
    cores = hotspots.sparkSession.sparkContext.defaultParallelism
    sites = sites.select("city_id", "site_lat", "site_lon").where("site_lat is not null and site_lon is not null")
    sites = settle(sites.repartition(2 * cores), "sites")
    met, near_km, n_days = strips.within(at, sites, bands, day, FEW)
    met = settle(met, "exposure")
    counts = [f"w{b}" for b in bands]
    far = [
        d.select("city_id", day, *[F.lit(0).cast("long").alias(c) for c in counts], "km")
        for d in _nearest(at, sites, met.select("city_id", day, "km"), near_km, n_days, day, cell_degrees, crowded)
    ]
    return (
        reduce(DataFrame.unionByName, [met, *far])
        .groupBy("city_id", day)
        .agg(
            *[F.sum(f"w{b}").alias(f"hotspots_within_{b}km") for b in bands],
            F.min("km").alias("nearest_hotspot_distance_km"),
        )
    )


def _nearest(
    at: DataFrame, sites: DataFrame, met: DataFrame, met_km: float, n_days: int, day: str, cell_degrees: float, crowded: int
) -> list[DataFrame]:
    """(city_id, day, km): the nearest hotspots of sites and days for which ``met`` has none within ``met_km``.

    The rows of a grid are asked for it in rings four times as wide each, until it is proven: a row not yet
    seen lies farther than what was found. Cells that may hold the nearest are opened and measured.
    """
    grid, cores, key = Grid(cell_degrees), at.sparkSession.sparkContext.defaultParallelism, ["city_id", day]
    near_by = proven = settle(_keyed(met.where(F.col("km") <= met_km), day), "proven")
    done, rows = [], None
    inner, reach, every_row = -1, int(2 * met_km / LESS_PER_DEGREE / grid.w) + 1, 2 * grid.top + 2
    sites = sites.withColumn("city_id", F.struct("city_id"))
    while n_days:
        whole = proven.groupBy("city_id").count().where(f"count >= {n_days}")
        left = settle(sites.join(whole, "city_id", "left_anti").repartition(2 * cores), "sites")
        if not (n_left := left.count()):
            break
        if rows is None:
            at = at.withColumn(day, F.struct(day)).selectExpr("*", f"{grid.row('lat')} as row", f"{grid.col('lon')} as col")
            # Each row meets many sites, so a few rows are work for all tasks.
            rows = settle(prefix_rows(at, grid, day, crowded).repartition(2 * cores), "prefix-rows")
            n_rows = rows.count()
            cells = rows.select(day, "row", F.explode(F.arrays_zip("cols", "slots")).alias("c")).select(
                day, "row", F.col("c.cols").alias("col"), F.col("c.slots").alias("slots")
            )
            # Positions in crowded cells are dealt over the cell's slots.
            at = at.join(cells.where("slots > 1"), [day, "row", "col"], "left").selectExpr(
                day, "row", "col", "lat", "lon", "if(slots is null, 0, int(pmod(xxhash64(lat, lon), slots))) as slot"
            )
        near = _site_rows(left, grid, inner, reach)
        asked = _met(rows, near, n_rows, n_left * min(2 * reach + 1, every_row), day).join(proven, key, "left_anti")
        done.append(settle(_measured(asked, rows, at, grid, day), "exposure"))
        if reach >= every_row:
            break
        found = reduce(DataFrame.unionByName, done).groupBy(*key).agg(F.min("km").alias("km"))
        found = found.where(F.col("km") <= reach * grid.w * LESS_PER_DEGREE).select(*key)
        proven = settle(near_by.unionByName(found), "proven")
        inner, reach = reach, 4 * reach
    return [d.select(F.col("city_id.city_id").alias("city_id"), F.col(f"{day}.{day}").alias(day), "km") for d in done]


def _keyed(met: DataFrame, day: str) -> DataFrame:
    """The keys as structs, which are equal where both are null."""
    return met.select(F.struct("city_id").alias("city_id"), F.struct(day).alias(day))


def _measured(met: DataFrame, rows: DataFrame, at: DataFrame, grid: Grid, day: str) -> DataFrame:
    """(city_id, day, km): the nearest hotspot in the rows of ``met``."""
    site = ["city_id", "site_lat", "site_lon"]
    beside = {c: grid.centre_km("row", c, "site_lat", "site_lon") for c in ("east", "west")}
    # The nearest filled cells of a row on either side of the site, around the globe if need be.
    seen = met.selectExpr(*site, day, "row", "cols", f"transform(asked, c -> {grid.west('c')}) as l").selectExpr(
        *site, day, "row", "cols[if(l[0] < size(cols), l[0], 0)] as east", "cols[if(l[1] > 0, l[1], size(cols)) - 1] as west"
    )
    whole = (
        seen.selectExpr(*site, day, "row", f"least({beside['east']}, {beside['west']}) as closest")
        .groupBy(*site, day)
        .agg(
            (F.min("closest") + grid.half).alias("most_km"),
            F.collect_list(F.struct("row", "closest")).alias("seen"),  # at most the rows of the grid
        )
    )
    # Only rows that may hold the nearest are looked at again.
    whole = settle(whole.withColumn("seen", F.expr(f"filter(seen, x -> x.closest - {grid.half}D <= most_km).row")), "met")
    may = grid.stretch(f"(most_km + {grid.half + SLACK_KM}D)", "row", "site_lat", "site_lon")
    opened = (
        whole.selectExpr(*site, day, "most_km", "explode(seen) as row")
        .selectExpr(*site, day, "row", f"{may} as may")
        .join(rows, [day, "row"])
        .selectExpr(*site, day, "row", "cols", "slots", f"explode({grid.cells_in('may')}) as i")
        .selectExpr(*site, day, "row", "cols[i] as col", "explode(sequence(0, slots[i] - 1)) as slot")
        .join(at, [day, "row", "col", "slot"])
    )
    km = haversine_km("lat", "lon", "site_lat", "site_lon").alias("km")
    return opened.select("city_id", day, km).groupBy("city_id", day).agg(F.min("km").alias("km"))
