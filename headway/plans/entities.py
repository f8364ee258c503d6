"""Entity resolution, names and places as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import derive, families, fusion, graph, links, names, places, publicnames
from ..sources.testfeed import normal
from .registry import query
from .rules import city_tables, sql_station
from .tables import profiles


@query(None)
def fn18_public_names(f):
    """Public names of the feed's stops and the invented names; of its areas in gr14."""
    known = names.prefix_aliases(f.named_stops)
    out = publicnames.public_names(f.named_stops, "name", "name", known, "city")
    return out.select("name_id", "public_stop_name", "public_city_name", "public_display_name", "public_quality", "name_source", "name_rules")


def cities(f):
    """The city that each area's name says."""
    return derive.stop_areas(f.stops).select("area_id", names.city_name(F.col("area_name")).alias("city_name"))


def family_tables(f):
    """Areas, profiles, members of families, aliases and cities, each written once."""
    areas, known = derive.stop_areas(f.stops), graph.written(profiles(f))
    return areas, known, graph.written(families.members(areas, known)), graph.written(names.aliases(areas, f.stops)), graph.written(cities(f))


@query(None)
def gr08_station_families(f):
    _, known, family, _, _ = family_tables(f)
    return families.with_access(family, known)


@query(None)
def gr11_family_edges(f):
    _, known, family, _, _ = family_tables(f)
    return families.family_edges(families.with_access(family, known))


@query(None)
def gr12_family_names(f):
    areas, known, family, alias, places_ = family_tables(f)
    return families.family_names(family, areas, known, alias, places_)


@query(None)
def gr13_family_aliases(f):
    areas, known, family, alias, places_ = family_tables(f)
    return families.family_aliases(families.family_names(family, areas, known, alias, places_), alias)


@query(None)
def gr14_display_names(f):
    areas, known, family, alias, places_ = family_tables(f)
    named = families.family_names(family, areas, known, alias, places_).join(known.select(F.col("area_id").alias("primary_area_id"), "has_rail_service"), "primary_area_id")
    return publicnames.display_names(areas, family, graph.written(named), places_)


SQUARES = "(SELECT k, 51e0 + k * 0.02e0 AS y1, 51e0 + k * 0.02e0 + 0.02e0 AS y2 FROM range(4) t(k))"


@query(city_tables("stop_areas", "area_name", "x") + f""", placed AS (SELECT a.*, q.k, row_number() OVER (PARTITION BY area_id ORDER BY q.k) AS r FROM x_city a LEFT JOIN {SQUARES} q ON area_lat >= q.y1 AND area_lat <= q.y2 AND area_lon >= 6.9e0 AND area_lon <= 7.1e0),
 said AS (SELECT *, (contains(area_name, ',') OR {sql_station(normal('area_name'))}) AND x_town <> '' AS named FROM placed WHERE r = 1)
 SELECT area_id, 'M' || k AS municipality_id, CASE WHEN k IS NOT NULL THEN 'Ort ' || k WHEN named THEN x_town END AS city_name, CASE WHEN k IS NOT NULL THEN 'OFFICIAL_BOUNDARY' WHEN named THEN 'GTFS_NAME_FALLBACK' ELSE 'UNRESOLVED' END AS source,
 CASE WHEN k IS NOT NULL THEN 'OFFICIAL_BOUNDARY' WHEN named THEN 'INFERRED' ELSE 'UNRESOLVED' END AS quality FROM said""")
def gr15_area_cities(f):
    """Squares share their borders; a point on one belongs to both, and the smaller square, then the smaller id, takes it."""
    edge = lambda k: 51e0 + k * 0.02e0
    rows = [(f"M{k}", f"Ort {k}", "Gemeinde", [[[[6.9, edge(k)], [7.1, edge(k)], [7.1, edge(k) + 0.02e0], [6.9, edge(k) + 0.02e0], [6.9, edge(k)]]]]) for k in range(4)]
    polygons = f.spark.createDataFrame(rows, places.SCHEMA)
    return places.area_cities(derive.stop_areas(f.stops), polygons).select("area_id", "municipality_id", "city_name", "source", "quality")


@query("SELECT 'X' || s.stop_id AS station_id, min(m.area_id) AS area_id, 'EXACT_STOP_CODE' AS method FROM stops s JOIN stops o ON o.stop_code = s.stop_code JOIN members m ON m.stop_id = o.stop_id WHERE s.location_type = 0 GROUP BY s.stop_id HAVING count(DISTINCT m.area_id) = 1")
def gr16_station_links(f):
    own = f.stops.filter("location_type = 0").selectExpr("concat('X', stop_id) AS station_id", "CAST(NULL AS string) AS global_id", "stop_code AS code", "stop_name AS name", "CAST(NULL AS double) AS lat", "CAST(NULL AS double) AS lon")
    return links.station_links(own, f.stops)


@query("""SELECT 'stops' AS member, 'DE' AS source_id, 'DE::' || stop_id AS id, stop_name AS told FROM stops UNION ALL SELECT 'trips', 'DE', 'DE::' || trip_id, 'DE::' || route_id FROM trips UNION ALL SELECT 'stop_times', 'DE', 'DE::' || trip_id, 'DE::' || stop_id FROM stop_times
 UNION ALL SELECT 'feeds', 'DE', 'DE', CAST((SELECT count(*) FROM trips) AS VARCHAR)""")
def gr17_source_static(f):
    """A source's stops, trips and calls under its name, and one row of the source itself."""
    own = lambda df, member: fusion.namespaced_member(df, "DE", member)
    source = lambda member: [F.lit(member).alias("member"), F.lit("DE").alias("source_id")]
    rows = own(f.stops, "stops.txt").select(*source("stops"), F.col("stop_id").alias("id"), F.col("stop_name").alias("told")).union(own(f.trips, "trips.txt").select(*source("trips"), "trip_id", "route_id"))
    return rows.union(own(f.stop_times, "stop_times.txt").select(*source("stop_times"), "trip_id", "stop_id")).union(f.trips.agg(F.lit("feeds"), F.lit("DE"), F.lit("DE"), F.count("*").cast("string")))


def two_sources(f):
    """The feed's trips as source A, and two thirds of them again as source B: shifted, and without their last call, or, where A lacks the last call, without their first.

    Both sources give a journey the same number, as trip_short_name does; a line is a route's label, whatever its route_id.
    """
    calls = f.stop_times.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("stop_sequence", F.col("stop_id").alias("stop_key"), F.col("arrival_seconds").alias("arrival"), F.col("departure_seconds").alias("departure")))).alias("calls"))
    plain = lambda shift: F.transform("calls", lambda x: F.struct(x["stop_key"].alias("stop_key"), (x["arrival"] + shift).alias("arrival"), (x["departure"] + shift).alias("departure")))
    labels = derive.route_labels(f.routes).select("route_id", F.coalesce(F.col("route_type").cast("string"), F.lit("")).alias("mode"), c.normalised(F.col("line_label")).alias("line_key"))
    rows = calls.join(f.trips, "trip_id").join(labels, "route_id").filter(F.size("calls") > 2)
    part, split = F.crc32("trip_id") % 3, (F.crc32("trip_id") % 3 == 1) & (F.size("calls") > 3)

    def source(name, priority, which, held):
        signed = which.join(derive.service_signatures(f.calendar, f.calendar_dates, name), "service_id", "left")
        signature = F.coalesce("signature", F.concat(F.lit(f"UNSCOPED:{name}::"), "service_id")).alias("signature")
        return signed.select(F.lit(name).alias("source_id"), F.lit(priority).alias("source_priority"), F.concat(F.lit(f"{name}::"), "trip_id").alias("trip_id"), signature, "mode", "line_key", F.regexp_extract("trip_id", "[0-9]+$", 0).alias("journey_key"), held.alias("calls"))

    n = F.size("calls")
    a = source("A", 0, rows, F.slice(plain(0), 1, F.when(split, n - 1).otherwise(n)))
    return a.union(source("B", 1, rows.filter((part == 0) | split), F.slice(plain(45), F.when(split, 2).otherwise(1), n - 1)))


@query(None)
def gr19_fused_trips(f):
    """Decisions for the trips of every bucket, however large."""
    return fusion.fuse_trips(two_sources(f), bucket=None).select("trip_id", "decision", "other_trip_id", F.size(F.coalesce("calls", F.array().cast("array<struct<stop_key:string,arrival:int,departure:int>>"))).alias("stitched_calls"))


@query(None)
def gr23_fusion_counts(f):
    both = two_sources(f)
    none = both.select("trip_id", F.lit(0).alias("suppressed"), F.col("trip_id").alias("kept_trip_id")).limit(0)
    return fusion.fusion_counts(fusion.fuse_trips(both, bucket=None), none)
