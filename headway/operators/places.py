"""Municipalities: reading GeoJSON and finding the polygon of a point."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as c

CELL = 0.1
RING = T.ArrayType(T.ArrayType(T.DoubleType()))
SCHEMA = "municipality_id string, city_name string, municipality_type string, parts array<array<array<array<double>>>>"


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of a FeatureCollection as rows of SCHEMA; properties have several accepted names; a polygon is one part, each with its outline and holes."""
    feature = T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])),
    ])
    raw = spark.read.schema(T.StructType([T.StructField("features", T.ArrayType(feature))])).json(path, multiLine=True)
    rows = raw.select(F.explode("features").alias("f"))
    p = lambda *names: F.coalesce(*[F.col("f.properties")[n] for n in names])
    single = F.array(F.from_json("f.geometry.coordinates", T.ArrayType(RING)))
    multi = F.from_json("f.geometry.coordinates", T.ArrayType(T.ArrayType(RING)))
    parts = F.when(F.col("f.geometry.type") == "MultiPolygon", multi).otherwise(single)
    out = rows.select(p("ags", "ars", "AGS").alias("municipality_id"), p("gen", "GEN", "name").alias("city_name"), p("bez", "type", "BEZ").alias("municipality_type"), parts.alias("parts"))
    outside = F.exists(F.flatten(F.flatten("parts")), lambda x: (F.abs(x[0]) > 180) | (F.abs(x[1]) > 90))
    return out.withColumn("parts", F.when(outside, F.raise_error(F.lit("coordinates are not in degrees")).cast("array<array<array<array<double>>>>")).otherwise(F.col("parts")))


def inside(x: float, y: float, rings: list) -> bool:
    """Even-odd rule over all rings; the boundary belongs to the polygon."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def ring_area(ring: Column) -> Column:
    """Area of a ring in square degrees with its sign; a ring that doesn't end where it begins is closed."""
    cross = lambda p, q: F.coalesce(p[0] * q[1] - q[0] * p[1], F.lit(0.0))
    closed = F.concat(ring, F.slice(ring, 1, 1))
    steps = F.zip_with(closed, F.slice(closed, 2, F.size(closed)), cross)
    return F.abs(F.aggregate(steps, F.lit(0.0), lambda a, x: a + x)) / 2


def covered_area(parts: Column) -> Column:
    """Area of polygons given as rings, of which the first of each is its outline and the others are holes."""
    whole = lambda rings: F.aggregate(F.transform(F.slice(rings, 2, F.size(rings)), ring_area), ring_area(F.element_at(rings, 1)), lambda a, x: a - x)
    return F.aggregate(F.transform(parts, whole), F.lit(0.0), lambda a, x: a + x)


def locate(points: DataFrame, polygons: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    """key with the smallest polygon (to nine places of its area, then the smallest id) that covers the point: an equi-join on grid cells of bounding boxes, then the exact test."""
    polygons = polygons.withColumn("rings", F.flatten("parts"))
    xs, ys = F.transform(F.flatten("rings"), lambda p: p[0]), F.transform(F.flatten("rings"), lambda p: p[1])
    boxes = polygons.withColumns({"x1": F.array_min(xs), "x2": F.array_max(xs), "y1": F.array_min(ys), "y2": F.array_max(ys)})
    boxes = boxes.withColumn("size", covered_area(F.col("parts")))
    span = lambda a, b: F.explode(F.sequence(c.cell(F.col(a), CELL), c.cell(F.col(b), CELL)))
    cells = boxes.withColumn("cx", span("x1", "x2")).withColumn("cy", span("y1", "y2"))
    own = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(key, F.col(lat).alias("lat"), F.col(lon).alias("lon"), c.cell(F.col(lon), CELL).alias("cx"), c.cell(F.col(lat), CELL).alias("cy"))
    both = own.join(cells, ["cx", "cy"]).filter("lon BETWEEN x1 AND x2 AND lat BETWEEN y1 AND y2")

    @F.pandas_udf("boolean")
    def covers(x: pd.Series, y: pd.Series, rings: pd.Series) -> pd.Series:
        return pd.Series([inside(a, b, [[tuple(p) for p in ring] for ring in r]) for a, b, r in zip(x, y, rings, strict=True)])

    hits = both.filter(covers("lon", "lat", "rings"))
    return hits.groupBy(key).agg(F.min_by(F.struct("municipality_id", "city_name", "municipality_type"), F.struct(F.round("size", 9).alias("size"), "municipality_id")).alias("m")).select(key, "m.*")


def area_cities(areas: DataFrame, polygons: DataFrame) -> DataFrame:
    """City of each area: by official boundary, else from a name that has a comma or says station, else unresolved."""
    from . import names

    found = locate(areas, polygons, "area_id", "area_lat", "area_lon")
    name = F.col("area_name")
    said = (F.coalesce(name, F.lit("")).contains(",") | names.station_words(c.normalised(name))) & (names.city_name(name) != "")
    rows = areas.join(found, "area_id", "left").withColumn("guess", F.when(said, names.city_name(name)))
    kind = lambda a, b, d: F.when(F.col("city_name").isNotNull(), a).when(F.col("guess").isNotNull(), b).otherwise(d)
    return rows.select("area_id", "municipality_id", F.coalesce("city_name", "guess").alias("city_name"), "municipality_type", kind("OFFICIAL_BOUNDARY", "GTFS_NAME_FALLBACK", "UNRESOLVED").alias("source"), kind("OFFICIAL_BOUNDARY", "INFERRED", "UNRESOLVED").alias("quality"))
