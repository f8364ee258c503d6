"""Links from a source's stations to areas, each by the best method that leads to one area only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import derive, graph
from .fusion import name_key

NAMED_METRES, UNIQUE_METRES, CELL = 35, 12, 0.0005
METHODS = ("EXACT_GLOBAL_ID", "EXACT_STOP_CODE", "COORDINATE_NAME_CHECKED", "COORDINATE_UNIQUE")


def station_links(stations: DataFrame, stops: DataFrame) -> DataFrame:
    """station_id, area_id and method for stations (station_id, global_id, code, name, lat, lon)."""
    members = derive.stop_area_members(stops)
    runtime = stops.join(members, "stop_id").select("stop_id", "area_id", "stop_code", "stop_lat", "stop_lon", name_key(F.col("stop_name")).alias("stop_key"))
    by_id = stations.filter(F.col("global_id").startswith("de:")).join(runtime, F.col("global_id") == F.col("stop_id")).select("station_id", "area_id", F.lit(0).alias("rank"))
    # only whether it is one area counts, so of an end's areas the first and the last stand for all
    ends = lambda df, *key: df.groupBy(*key).agg(F.array_distinct(F.array(F.min("area_id"), F.max("area_id"))).alias("x")).select(*key, F.explode("x").alias("area_id"))
    by_code = stations.filter("code IS NOT NULL").join(ends(runtime.filter("stop_code IS NOT NULL"), "stop_code"), F.col("code") == F.col("stop_code")).select("station_id", "area_id", F.lit(1).alias("rank"))
    points = graph.written(stations.filter("lat IS NOT NULL AND lon IS NOT NULL").select("station_id", name_key(F.col("name")).alias("own_key"), F.col("lat").alias("from_lat"), F.col("lon").alias("from_lon")))
    placed = graph.written(ends(runtime.filter("stop_lat IS NOT NULL AND stop_lon IS NOT NULL").select(F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"), "stop_key", "area_id"), "lat", "lon", "stop_key"))
    starts = points.select("from_lat", "from_lon").distinct()
    near = derive.nearby_places(placed.select("lat", "lon").union(starts).distinct(), CELL, 1, NAMED_METRES).join(starts, ["from_lat", "from_lon"], "left_semi")
    near = graph.written(near.join(placed, ["lat", "lon"]).select("from_lat", "from_lon", "distance_meters", "stop_key", "area_id"))
    named = ends(near.filter("stop_key <> ''").withColumnRenamed("stop_key", "own_key"), "from_lat", "from_lon", "own_key")
    named = points.join(named, ["from_lat", "from_lon", "own_key"]).select("station_id", "area_id", F.lit(2).alias("rank"))
    close = ends(near.filter(F.col("distance_meters") <= UNIQUE_METRES), "from_lat", "from_lon")
    close = points.join(close, ["from_lat", "from_lon"]).select("station_id", "area_id", F.lit(3).alias("rank"))
    hits = by_id.union(by_code).union(named).union(close)
    single = hits.groupBy("station_id", "rank").agg(F.count_distinct("area_id").alias("n"), F.min("area_id").alias("area_id")).filter("n = 1")
    best = single.groupBy("station_id").agg(F.min(F.struct("rank", "area_id")).alias("x"))
    method = F.get(F.array(*map(F.lit, METHODS)), F.col("x.rank"))
    return best.select("station_id", F.col("x.area_id").alias("area_id"), method.alias("method"))
