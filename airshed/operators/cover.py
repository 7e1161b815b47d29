"""A polygon as a cover of cells: wholly inside, wholly outside, or cut by its edges.

Levels of a grid, each an eighth of the one before in width. A cell that no edge comes near is wholly
inside or outside; a cell with few edges is cut and keeps them; a cell with more is split into cells of
the next level. So a point in a whole cell sees no edge, and one in a cut cell only those of its cell,
however many the polygon has.

Whether a point is inside follows from a path: east to its cell's east side, then north along that side.
It is inside when the edges that the path crosses are odd in number. On the first part these are edges
of the cell; on the second, crossings of the side within the cell, stored with it, and those north of
the cell, of which the cell holds the parity. Where rounding might tell the two parts apart (within
``NEAR`` degrees of the corner of the path) the point is tested against all edges of its latitude.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airshed.session import settle

FIRST_DEGREES = 0.5
SPLIT = 8
FEW_EDGES = 32
LEVELS = 4
NEAR = 1e-9
OUTSIDE, INSIDE, CUT, SPLIT_UP = 0, 1, 2, 3


def ring_edges(vertices: DataFrame) -> DataFrame:
    """(lat1, lon1, lat2, lon2): the edges of rings that are not points.

    vertices: ring (any key), seq, lat, lon. Rings are parts and holes alike: a point is inside when
    it is inside an odd number of them. The last vertex may or may not repeat the first.
    """
    around = W.partitionBy("ring").orderBy("seq")
    first = around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return vertices.select(
        F.col("lat").alias("lat1"),
        F.col("lon").alias("lon1"),
        F.coalesce(F.lead("lat").over(around), F.first("lat").over(first)).alias("lat2"),
        F.coalesce(F.lead("lon").over(around), F.first("lon").over(first)).alias("lon2"),
    ).where("lat1 <> lat2 or lon1 <> lon2")


def _clipped(edges: DataFrame, w: float) -> DataFrame:
    """Edges once for each cell (col, row) of width ``w`` that they come within ``NEAR`` of."""
    # In a column an edge spans the latitudes between where it enters and where it leaves.
    at = "lat1 + (least(greatest({x}, least(lon1, lon2)), greatest(lon1, lon2)) - lon1) / (lon2 - lon1) * (lat2 - lat1)"
    enters, leaves = at.format(x=f"(col * {w}D - {NEAR}D)"), at.format(x=f"((col + 1) * {w}D + {NEAR}D)")
    return (
        edges.selectExpr(
            "*",
            f"explode(sequence(int(floor((least(lon1, lon2) - {NEAR}D) / {w}D)), int(floor((greatest(lon1, lon2) + {NEAR}D) / {w}D)))) as col",
        )
        .selectExpr("*", f"if(lon1 = lon2, lat1, {enters}) as a", f"if(lon1 = lon2, lat2, {leaves}) as b")
        .selectExpr(
            "lat1", "lon1", "lat2", "lon2", "col",
            f"explode(sequence(int(floor((least(a, b) - {NEAR}D) / {w}D)), int(floor((greatest(a, b) + {NEAR}D) / {w}D)))) as row",
        )
    )


def _crossings(edges: DataFrame, w: float) -> DataFrame:
    """(col, row, crosses): where edges cross the east sides of columns, by the cells they do it in."""
    first, last = f"int(ceil(least(lon1, lon2) / {w}D)) - 2", f"int(floor(greatest(lon1, lon2) / {w}D))"
    return (
        edges.where("lon1 <> lon2")
        .selectExpr("*", f"explode(sequence({first}, {last})) as col")
        .withColumn("east", F.expr(f"(col + 1) * {w}D"))
        .where("(lon1 > east) <> (lon2 > east)")
        .selectExpr("col", "lat1 + (east - lon1) / (lon2 - lon1) * (lat2 - lat1) as crosses")
        .selectExpr("col", f"int(floor(crosses / {w}D)) as row", "crosses")
    )


def _level(cells: DataFrame, edges: DataFrame, w: float, last: bool) -> DataFrame:
    """The state of each of ``cells`` (col, row), its edges where it is cut, and the crossings of its east side."""
    held = _clipped(edges, w).groupBy("col", "row").agg(F.collect_list(F.struct("lat1", "lon1", "lat2", "lon2")).alias("edges"))
    crossed = _crossings(edges, w).join(cells.select("col").distinct(), "col", "left_semi")
    crossed = crossed.groupBy("col", "row").agg(F.collect_list("crosses").alias("crosses"))
    asked = cells.withColumn("asked", F.lit(True)).join(held, ["col", "row"], "left").join(crossed, ["col", "row"], "full")
    north = F.sum(F.coalesce(F.size("crosses"), F.lit(0))).over(
        W.partitionBy("col").orderBy(F.col("row").desc()).rowsBetween(W.unboundedPreceding, -1)
    )
    n = F.coalesce(F.size("edges"), F.lit(0))
    odd = F.coalesce(north, F.lit(0)) % 2 == 1
    state = F.when(n == 0, F.when(odd, INSIDE).otherwise(OUTSIDE)).when((n <= FEW_EDGES) | F.lit(last), CUT).otherwise(SPLIT_UP)
    return (
        asked.select("col", "row", "asked", "edges", "crosses", odd.alias("odd"), state.alias("state"))
        .where("asked")
        .select("col", "row", "state", "odd", *[F.when(F.col("state") == CUT, F.col(c)).alias(c) for c in ("edges", "crosses")])
    )


def cover(vertices: DataFrame, first_degrees: float = FIRST_DEGREES, levels: int = LEVELS) -> list[tuple[float, DataFrame]]:
    """Cell width and cells of each level: col, row, state, odd (parity north of the cell), edges, crosses.

    Outside cells are not listed. The whole is as large as the boundary is long, and each level is written once.
    """
    edges = settle(ring_edges(vertices), "polygon-edges")
    out, w, cells = [], first_degrees, None
    for level in range(levels):
        if cells is None:
            box = edges.selectExpr(
                *[f"int(floor({f}(least({c}1, {c}2)) / {w}D)) as {c}_{f}" for c in ("lat", "lon") for f in ("min",)],
                *[f"int(floor({f}(greatest({c}1, {c}2)) / {w}D)) as {c}_{f}" for c in ("lat", "lon") for f in ("max",)],
            ).where("lat_min is not null")
            cells = box.selectExpr("explode(sequence(lon_min, lon_max)) as col", "lat_min", "lat_max")
            cells = cells.selectExpr("col", "explode(sequence(lat_min, lat_max)) as row")
        done = settle(_level(cells, edges, w, level == levels - 1).where(F.col("state") != OUTSIDE), "cover")
        out.append((w, done))
        split = done.where(F.col("state") == SPLIT_UP)
        if level == levels - 1 or split.isEmpty():
            break
        w /= SPLIT
        inner = f"explode(sequence({{0}} * {SPLIT}, {{0}} * {SPLIT} + {SPLIT - 1})) as {{0}}"
        cells = split.selectExpr("row", inner.format("col")).selectExpr("col", inner.format("row"))
    return out


def _crosses(e: Column) -> tuple[Column, Column]:
    """Whether an edge straddles the point's latitude, and the longitude at which it does."""
    straddles = (e["lat1"] > F.col("lat")) != (e["lat2"] > F.col("lat"))
    meets = e["lon1"] + (F.col("lat") - e["lat1"]) / (e["lat2"] - e["lat1"]) * (e["lon2"] - e["lon1"])
    return straddles, meets


def by_latitude(points: DataFrame, vertices: DataFrame, band_degrees: float = 0.5) -> DataFrame:
    """Points inside, by counting the edges east of the point among all of its latitude band."""
    edges = ring_edges(vertices).where("lat1 <> lat2")
    low, high = (f"int(floor({f}(lat1, lat2) / {band_degrees}D))" for f in ("least", "greatest"))
    bands = edges.selectExpr(f"explode(sequence({low}, {high})) as __of_band", "struct(lat1, lon1, lat2, lon2) as e")
    bands = bands.groupBy("__of_band").agg(F.collect_list("e").alias("__edges"))

    def east(e: Column) -> Column:
        straddles, meets = _crosses(e)
        return straddles & (F.col("lon") < meets)

    return (
        points.withColumn("__band", F.floor(F.col("lat") / F.lit(band_degrees)).cast("int"))
        .join(bands, F.col("__band") == F.col("__of_band"))
        .where(F.size(F.filter("__edges", east)) % 2 == 1)
        .drop("__band", "__of_band", "__edges")
    )


def placed(points: DataFrame, levels: list[tuple[float, DataFrame]]) -> DataFrame:
    """Points with the state, and the edges if any, of their cell; points in outside cells are left out.

    A point goes on to the next level only while its cell is split. The optimizer sends a level's cells
    to the points where they are small.
    """
    out = points
    for k, (w, cells) in enumerate(levels):
        split = F.lit(True) if not k else F.col("__state") == SPLIT_UP
        names = [c for c in cells.columns if c not in ("col", "row")]
        here = cells.select(F.col("col").alias("__c"), F.col("row").alias("__r"), *[F.col(c).alias(f"__new_{c}") for c in names])
        on = (F.floor(F.col("lon") / F.lit(w)).cast("int") == F.col("__c")) & (F.floor(F.col("lat") / F.lit(w)).cast("int") == F.col("__r"))
        kept = points.columns
        if not k:
            out = out.join(here, on).select(*kept, *[F.col(f"__new_{c}").alias(f"__{c}") for c in names], F.lit(w).alias("__w"))
        else:
            out = out.join(here, on & split, "left").where(~split | F.col("__c").isNotNull())
            values = [F.when(split, F.col(f"__new_{c}")).otherwise(F.col(f"__{c}")).alias(f"__{c}") for c in names if c != "state"]
            state = F.when(split, F.col("__new_state")).otherwise(F.col("__state")).alias("__state")
            out = out.select(*kept, state, *values, F.when(split, F.lit(w)).otherwise(F.col("__w")).alias("__w"))
    return out


def inside_polygon(points: DataFrame, vertices: DataFrame, first_degrees: float = FIRST_DEGREES, levels: int = LEVELS) -> DataFrame:
    """Points (columns lat and lon) within a polygon of any number of parts and holes (``ring_edges`` has
    the form of ``vertices``). Points without a place are outside."""
    kept = points.columns
    cells = cover(vertices, first_degrees, levels)
    at = placed(points.where("lat is not null and lon is not null"), cells)
    side = (F.floor(F.col("lon") / F.col("__w")) + 1) * F.col("__w")
    floor = F.floor(F.col("lat") / F.col("__w")) * F.col("__w")
    close = lambda a, b: F.abs(a - b) < NEAR

    def east(e: Column) -> Column:
        straddles, meets = _crosses(e)
        return straddles & (F.col("lon") < meets) & (meets <= F.col("__side"))

    def unclear(e: Column) -> Column:
        straddles, meets = _crosses(e)
        return straddles & close(meets, F.col("__side"))

    at = at.withColumn("__side", side).withColumn("__low", floor)
    crosses = F.coalesce("__crosses", F.array().cast("array<double>"))
    passed = F.size(F.filter("__edges", east)) + F.size(F.filter(crosses, lambda y: y > F.col("lat"))) + F.col("__odd").cast("int")
    cut = F.col("__state") == CUT
    doubtful = cut & (
        F.exists(crosses, lambda y: close(y, F.col("lat")))
        | F.exists("__edges", unclear)
        | close(F.col("lat"), F.col("__low"))
        | close(F.col("lat"), F.col("__low") + F.col("__w"))
    )
    at = at.withColumn("__doubtful", doubtful)
    sure = at.where(~F.col("__doubtful") & ((F.col("__state") == INSIDE) | (passed % 2 == 1))).select(*kept)
    return sure.unionByName(by_latitude(at.where("__doubtful").select(*kept), vertices))


def edges_seen(points: DataFrame, vertices: DataFrame, band_degrees: float = 0.5) -> DataFrame:
    """One row: points, those in cut cells, and the edges that all points are tested against, by the cover
    and, for comparison, among all edges of a latitude band."""
    located = points.where("lat is not null and lon is not null")
    at = placed(located, cover(vertices))
    seen = at.agg(
        F.count_if(F.col("__state") == CUT).alias("in_cut_cells"),
        F.coalesce(F.sum(F.when(F.col("__state") == CUT, F.size("__edges"))), F.lit(0)).alias("edges_by_cover"),
    )
    edges = ring_edges(vertices).where("lat1 <> lat2")
    low, high = (f"int(floor({f}(lat1, lat2) / {band_degrees}D))" for f in ("least", "greatest"))
    bands = edges.selectExpr(f"explode(sequence({low}, {high})) as band").groupBy("band").agg(F.count("*").alias("n"))
    band = F.floor(F.col("lat") / F.lit(band_degrees)).cast("int").alias("band")
    wide = located.select(band).groupBy("band").agg(F.count("*").alias("points")).join(bands, "band", "left")
    wide = wide.agg(F.sum("points").alias("points"), F.sum(F.col("points") * F.coalesce("n", F.lit(0))).alias("edges_by_band"))
    return wide.join(seen, F.lit(True)).select("points", "in_cut_cells", "edges_by_band", "edges_by_cover")
