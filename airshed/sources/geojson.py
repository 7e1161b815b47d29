"""GeoJSON pages to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators.grouping import keep_one


def collection_schema(properties: T.StructType) -> T.StructType:
    geometry = T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.ArrayType(T.DoubleType())),
        ]
    )
    feature = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("properties", properties),
            T.StructField("geometry", geometry),
        ]
    )
    return T.StructType([T.StructField("features", T.ArrayType(feature))])


def read_pages(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """A folder of page files, one feature collection each, with the file they came from."""
    pages = spark.read.schema(collection_schema(properties)).option("multiLine", True).json(path)
    return pages.withColumn("source_file", F.col("_metadata.file_path"))


def parse_pages(pages: DataFrame, text: str, properties: T.StructType) -> DataFrame:
    """The same for pages already held as text; other columns are kept."""
    parsed = F.from_json(F.col(text), collection_schema(properties))
    return pages.withColumn("features", parsed["features"]).drop(text)


def flatten_features(
    pages: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    drop_empty: bool = False,
    lineage: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per feature: page columns, properties, coordinates, and lineage on request.

    A missing geometry or fewer than two coordinates gives null coordinates. With ``drop_empty`` a
    feature without any property value is left out. ``lineage`` adds the feature id, the geometry
    type and the given constants, e.g. one snapshot time for all rows.
    """
    context = [c for c in pages.columns if c != "features"]
    rows = pages.select(*context, F.explode("features").alias("f"))
    names = pages.schema["features"].dataType.elementType["properties"].dataType.fieldNames()
    if drop_empty:
        rows = rows.where(F.coalesce(*[F.col(f"f.properties.{n}").cast("string") for n in names]).isNotNull())
    point = F.col("f.geometry.coordinates")
    complete = F.size(point) >= 2
    out = [
        *context,
        *[F.col(f"f.properties.{n}").alias(n) for n in names],
        F.when(complete, F.get(point, F.lit(0))).alias(lon),
        F.when(complete, F.get(point, F.lit(1))).alias(lat),
    ]
    if lineage is not None:
        out += [
            F.col("f.id").alias("source_feature_id"),
            F.col("f.geometry.type").alias("geometry_type"),
            *[c.alias(n) for n, c in lineage.items()],
        ]
    return rows.select(*out)


def union_pages(pages: Sequence[DataFrame], key: str, order_by: str) -> DataFrame:
    """All pages as one table with each key once, however much the pages overlap.

    The copy with the smallest ``order_by`` stays, so the result does not depend on page order.
    """
    merged = pages[0]
    for page in pages[1:]:
        merged = merged.unionByName(page, allowMissingColumns=True)
    return keep_one(merged, [key], order_by, copies_col="page_copies")


def read_polygon(spark: SparkSession, path: str) -> DataFrame:
    """Vertices (ring, seq, lat, lon) of all polygons and multi-polygons in GeoJSON files.

    A file is a feature collection, a feature or a bare geometry. Holes are rings as well.
    """
    ring = "array<array<double>>"
    text = spark.read.text(path, wholetext=True).select("value")
    bare = "struct<type:string, coordinates:string>"
    top = text.select(
        F.from_json("value", f"features array<struct<geometry:{bare}>>, geometry {bare}, type string, coordinates string").alias("t")
    )
    each = top.select(
        F.explode(
            F.coalesce(
                F.transform("t.features", lambda f: f["geometry"]),
                F.array(F.coalesce("t.geometry", F.struct("t.type", "t.coordinates"))),
            )
        ).alias("g")
    )
    rings = each.select(
        F.when(F.col("g.type") == "Polygon", F.array(F.from_json("g.coordinates", f"array<{ring}>")))
        .when(F.col("g.type") == "MultiPolygon", F.from_json("g.coordinates", f"array<array<{ring}>>"))
        .alias("parts")
    ).select(F.explode(F.flatten("parts")).alias("r"))
    numbered = rings.select(F.xxhash64(F.to_json("r")).alias("ring"), F.posexplode("r").alias("seq", "p"))
    return numbered.select("ring", "seq", F.col("p")[1].alias("lat"), F.col("p")[0].alias("lon"))


# --- pages whose properties are not declared -----------------------------------------------------

MAX_PROPERTIES = 2000

# What a VARIANT calls the type of a value -> how it is reported.
KINDS = {"BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null"}


def open_features(pages: DataFrame, text: str) -> DataFrame:
    """One row per feature of pages held as text: page columns, id, geometry type and coordinates, and
    ``properties``, a map of VARIANT values. A page that is no JSON object with features has no rows."""
    context = [c for c in pages.columns if c != text]
    page = pages.select(*context, F.try_parse_json(F.col(text)).alias("__page"))
    features = page.select(*context, F.explode(F.try_variant_get("__page", "$.features", "array<variant>")).alias("__f"))
    return features.select(
        *context,
        F.try_variant_get("__f", "$.id", "string").alias("source_feature_id"),
        F.try_variant_get("__f", "$.geometry.type", "string").alias("geometry_type"),
        F.try_variant_get("__f", "$.geometry.coordinates", "array<double>").alias("coordinates"),
        F.try_variant_get("__f", "$.properties", "map<string,variant>").alias("properties"),
    )


def property_report(features: DataFrame) -> DataFrame:
    """Every property that some feature has: its kinds of values, joined by commas, the features that have
    a value, and whether its kind changes between features (null and whole numbers beside others do not
    count as a change)."""
    each = features.select(F.explode("properties").alias("property", "__v"))
    name = F.regexp_extract(F.schema_of_variant("__v"), "^[A-Z]+", 0)
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), name), F.lower(name))
    counted = each.groupBy("property", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    report = counted.groupBy("property").agg(
        F.array_sort(F.collect_set("kind")).alias("kinds"),
        F.sum(F.when(F.col("kind") != "null", F.col("n")).otherwise(0)).alias("feature_count"),
    )
    other = F.filter("kinds", lambda k: ~k.isin("null", "integer"))
    numbers = F.array_except("kinds", F.array(*[F.lit(k) for k in ("null", "integer", "number")]))
    changed = (F.size(F.array_except("kinds", F.array(F.lit("null")))) > 1) & (F.size(numbers) > 0) & (F.size(other) > 0)
    return report.select("property", F.array_join("kinds", ",").alias("kinds"), "feature_count", changed.alias("kind_changes"))


def flatten_open(pages: DataFrame, text: str, lon: str = "longitude", lat: str = "latitude", report: DataFrame | None = None) -> DataFrame:
    """One row per feature with a column for every property that any page has, in the order of their names.

    The names and types come from ``property_report`` of the same pages (its rows are as many as there
    are properties; more than ``MAX_PROPERTIES`` are refused). Whole numbers are bigint, numbers double,
    truth values boolean; anything else, and whatever changes its kind, is text, objects and lists as JSON.
    """
    features = open_features(pages, text)
    found = (property_report(features) if report is None else report).orderBy("property").limit(MAX_PROPERTIES + 1).collect()
    if len(found) > MAX_PROPERTIES:
        raise ValueError(f"more than {MAX_PROPERTIES} properties")
    context = [c for c in pages.columns if c != text]
    taken = {c.lower() for c in [*context, lon, lat, "source_feature_id", "geometry_type"]}
    out = []
    for r in found:
        kinds = set(r["kinds"].split(",")) - {"null"}
        kind = {frozenset(["integer"]): "bigint", frozenset(["boolean"]): "boolean"}.get(frozenset(kinds), "string")
        kind = "double" if "number" in kinds and kinds <= {"integer", "number"} else kind
        name = r["property"]
        while name.lower() in taken:  # beside a page column, or a property that differs in case only
            name = f"property_{name}"
        taken.add(name.lower())
        out.append(F.try_variant_get(F.col("properties").getItem(r["property"]), "$", kind).alias(name))
    complete = F.size("coordinates") >= 2
    return features.select(
        *context,
        "source_feature_id",
        "geometry_type",
        *out,
        F.when(complete, F.get("coordinates", F.lit(0))).alias(lon),
        F.when(complete, F.get("coordinates", F.lit(1))).alias(lat),
    )
