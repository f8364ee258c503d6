"""A timetable feed projected from the benchmark tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

import unicodedata
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WEEK = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


#: Invented names and their cities that the rules of names are tried on, next to the feed's own.
NAMES = [
    ("Altenfels Hbf", "Altenfels"), ("Altenfels Hauptbahnhof", "Altenfels"), ("Hauptbahnhof Altenfels", "Altenfels"), ("Hbf Altenfels", "Altenfels"), ("ALTENFELS HBF", "Altenfels"), ("Altenfels hauptbahnhof tief", "Altenfels"),
    ("Bergau Bahnhof", "Bergau"), ("Bergau Bf", "Bergau"), ("Bahnhof, Seeheim", "Seeheim"), ("Seeheim, Bahnhof", "Seeheim"), ("Seeheim, S Bahn", "Seeheim"), ("Bf, S Seeheim", "Seeheim"), ("Bergau Bahnhof Seeheim Bodensee", "Bergau"),
    ("Bergau Stadtbahnhof", "Bergau"), ("Stadtbahnhof Bergau", "Bergau"), ("Neu Ulmbach Ostbahnhof", "Neu Ulmbach"), ("Neu Ulmbach Westf Bahnhof", "Neu Ulmbach"), ("Tannau Main Bf", "Tannau"), ("Dorf aller Leute Bf", "Dorf"),
    ("Tannau ZOB", "Tannau"), ("Tannau Busbahnhof", "Tannau"), ("Tannau, Kirchenallee", "Tannau"), ("Tannau Bahnhofstr.", "Tannau"), ("Tannau Bahnhofstraße", "Tannau"), ("Tannau Str. des Friedens", "Tannau"), ("Tannau Ringstr", "Tannau"),
    ("S Birkental", "Birkental"), ("U Birkental", "Birkental"), ("S+U Birkental Süd", "Birkental"), ("S-Bahnhof Birkental", "Birkental"), ("U Bahn Birkental", "Birkental"), ("ubahn birkental nord", "Birkental"), ("s u birkental", "Birkental"),
    ("Altenfels (Oberland)", "Altenfels"), ("Altenfels-Messe", "Altenfels"), ("Altenfels.Markt", "Altenfels"), ("Altenfels", "Altenfels"), ("Altenfelser Hof", "Altenfels"), ("Altenfels krs Bergau", "Altenfels"), ("Altenfels (Süd) Rathaus", "Altenfels Süd"),
    ("AL-Marktplatz", "Altenfels"), ("AF.-Ring", "Altenfels"), ("NU-Tor", "Neu Ulmbach"), ("TU-Campus", "Tannau"), ("ZUP-Platz", "Bergau"), ("SAP-Allee", "Bergau"), ("II-Abschnitt", "Bergau"), ("XQ-Halle", "Bergau"), ("DO-West", "Dortmund"),
    ("Rathaus & Markt", "Bergau"), ("Haus+Hof / Garten", "Bergau"), ("  Ärzte\t Haus  ", "Bergau"), ("Wald-Schule, Nord", "Bergau"), ("Ｗｅｉｔｅ Straße", "Bergau"), ("ﬁliale Mu\u0308hle", "Bergau"), ("Platz Nr.\u00a05", "Bergau"),
    ("Seeheim Gleis 4", "Seeheim"), ("Seeheim Platform B", "Seeheim"), ("Gare de Seeheim", "Seeheim"), ("Haltestelle", "Seeheim"), ("Bahnhof", "Seeheim"), ("---", "Seeheim"), ("", "Seeheim"), (None, "Seeheim"), ("Flughafen Nord", "Bergau"),
]


def normal(text: str) -> str:
    """SQL of the search form of a text whose compatibility forms are folded."""
    bare = f"regexp_replace(coalesce({text}, ''), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    spelled = f"replace(replace(replace(replace(lower({bare}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss')"
    spaced = f"regexp_replace(regexp_replace({spelled}, '[&+]', ' und ', 'g'), '[!-/:-@\\[-`{{-~]+', ' ', 'g')"
    return f"trim(regexp_replace({spaced}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"


def _names_sql() -> str:
    text = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
    folded = lambda x: x if x is None else unicodedata.normalize("NFKC", x)
    return ", ".join(f"({k}, {text(n)}, {text(folded(n))}, {text(c)})" for k, (n, c) in enumerate(NAMES))


class Feed:
    """Tables of a feed as DataFrames; attributes are the tables' names."""

    def __init__(self, spark: SparkSession, **tables: DataFrame):
        self.spark = spark
        self.__dict__.update(tables)


class TestFeed(Feed):
    """The projection of the benchmark tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark)
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def stops(self) -> DataFrame:
        nations = self.source("nation").selectExpr(
            "concat('N', n_nationkey) AS stop_id", "concat('NC', n_nationkey) AS stop_code",
            "concat('Stadt', n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN ' Hbf' WHEN 1 THEN ' Bahnhof' WHEN 2 THEN ', Messe/Süd' ELSE '-Kampstraße U' END) AS stop_name",
            "51e0 + n_nationkey * 0.004e0 AS stop_lat", "7e0 + (n_nationkey % 5) * 0.003e0 AS stop_lon", "CAST(NULL AS string) AS parent_station", "1 AS location_type", "CAST(NULL AS string) AS platform_code",
        )
        suppliers = self.source("supplier").selectExpr(
            "concat('S', s_suppkey) AS stop_id", "concat('SC', s_suppkey % 50) AS stop_code", "concat('Stadt', s_nationkey, ' Gleis ', s_suppkey) AS stop_name",
            "CASE WHEN s_suppkey % 17 <> 0 THEN 51e0 + s_nationkey * 0.004e0 + (s_suppkey % 7) * 0.0006e0 END AS stop_lat", "7e0 + (s_nationkey % 5) * 0.003e0 + (s_suppkey % 3) * 0.0004e0 AS stop_lon",
            "CASE WHEN s_suppkey % 10 <> 9 THEN concat('N', s_nationkey) END AS parent_station", "0 AS location_type", "CAST(s_suppkey % 6 AS string) AS platform_code",
        )
        return nations.unionByName(suppliers)

    @cached_property
    def names(self) -> DataFrame:
        return self.spark.createDataFrame([(k, n, c) for k, (n, c) in enumerate(NAMES)], "name_id int, name string, city string")

    @cached_property
    def named_stops(self) -> DataFrame:
        """The feed's stops and the invented names, with their cities: name_id, name, city."""
        number = "CASE WHEN location_type = 1 THEN 500 ELSE 1000 END + CAST(substring(stop_id, 2, 20) AS int) AS name_id"
        return self.stops.selectExpr(number, "stop_name AS name", "regexp_extract(stop_name, '^(Stadt[0-9]+)', 1) AS city").union(self.names)

    @cached_property
    def trips(self) -> DataFrame:
        return self.source("orders").selectExpr("concat('T', o_orderkey) AS trip_id", "concat('R', o_custkey % 25) AS route_id", "concat('SV', o_custkey % 40) AS service_id", "CAST(o_orderkey % 2 AS string) AS direction_id")

    @cached_property
    def stop_times(self) -> DataFrame:
        order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
        rows = self.source("lineitem").withColumn("seq", F.row_number().over(order))
        rows = rows.selectExpr("concat('T', l_orderkey) AS trip_id", "concat('S', l_suppkey) AS stop_id", "seq AS stop_sequence", "CAST((l_orderkey * 37) % 86000 + seq * 600 AS int) AS departure_seconds")
        return rows.withColumn("arrival_seconds", F.col("departure_seconds") - 30)

    @cached_property
    def routes(self) -> DataFrame:
        return self.spark.range(25).selectExpr(
            "concat('R', id) AS route_id", "CASE WHEN id % 7 = 3 THEN '' ELSE concat('A', id % 5) END AS agency_id",
            "CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('S', id) WHEN 2 THEN concat('RE ', id) ELSE '  ' END AS route_short_name", "CASE WHEN id % 6 <> 0 THEN concat(' Line ', id) END AS route_long_name",
            "CASE id % 10 WHEN 4 THEN 100 WHEN 5 THEN 109 WHEN 6 THEN 400 WHEN 7 THEN 700 WHEN 8 THEN 900 WHEN 9 THEN NULL ELSE CAST(id % 10 AS int) END AS route_type",
            "CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN NULL ELSE 'AA00CC' END AS route_color",
        )

    @cached_property
    def agency(self) -> DataFrame:
        return self.source("region").selectExpr(
            "CASE WHEN r_regionkey = 3 THEN '' ELSE concat('A', r_regionkey) END AS agency_id", "r_name AS agency_name", "r_regionkey AS ordinal",
            "CASE r_regionkey WHEN 0 THEN 'Europe/Berlin' WHEN 1 THEN 'Europe/Zurich' WHEN 2 THEN 'Europe/Berlin' WHEN 3 THEN '' ELSE 'Mars/Olympus' END AS agency_timezone",
        )

    @cached_property
    def calendar(self) -> DataFrame:
        k = self.source("orders").selectExpr("CAST(o_custkey % 40 AS int) AS k").distinct().filter("k % 8 <> 7")
        return k.selectExpr(
            "concat('SV', k) AS service_id", "k % 2 AS monday", "1 AS tuesday", "1 AS wednesday", "CASE WHEN k % 3 = 2 THEN 1 ELSE 0 END AS thursday", "1 AS friday",
            "CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS saturday", "CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS sunday", "'20240101' AS start_date", "CASE WHEN k % 6 = 0 THEN '20240115' ELSE '20241231' END AS end_date",
        )

    @cached_property
    def calendar_dates(self) -> DataFrame:
        rows = self.source("events").filter("event_type IN ('signup', 'error') AND user_id % 3 <> 0").selectExpr("CAST(user_id % 40 AS int) AS k", "date_format(ts, 'yyyyMMdd') AS date").distinct()
        return rows.filter("k NOT IN (3, 15)").selectExpr("concat('SV', k) AS service_id", "date", "CASE WHEN k >= 30 THEN 2 ELSE 1 END AS exception_type")

    @cached_property
    def transfers(self) -> DataFrame:
        order = Window.partitionBy("trip_id").orderBy("stop_sequence")
        n = lambda c: F.substring(c, 2, 20).cast("long")
        pairs = self.stop_times.withColumn("next", F.lead("stop_id").over(order)).filter("next IS NOT NULL").select(n("stop_id").alias("a"), n("next").alias("b")).distinct()
        return pairs.selectExpr(
            "a * 1000000 + b AS transfer_id", "concat('S', a) AS from_stop_id", "concat(CASE WHEN (a + b) % 11 = 0 THEN 'X' ELSE 'S' END, b) AS to_stop_id", "CASE WHEN (a * b) % 7 = 3 THEN concat('R', a % 25) END AS from_route_id",
            "CASE WHEN (a * b) % 13 = 5 THEN concat('T', a) END AS from_trip_id", "CASE WHEN (a + 2 * b) % 19 = 7 THEN concat('R', b % 25) END AS to_route_id", "CASE WHEN (a + 3 * b) % 23 = 6 THEN concat('T', b) END AS to_trip_id",
            "CASE WHEN (a + 2 * b) % 17 = 4 THEN concat('SV', b % 40) END AS service_id",
            "CASE WHEN (a + b) % 7 <> 6 THEN CAST((a + b) % 7 AS int) END AS transfer_type", "CASE WHEN (a + b) % 7 = 2 THEN CAST((a * 13 + b * 7) % 4000 AS int) END AS min_transfer_time",
        )

    @cached_property
    def family_members(self) -> DataFrame:
        """Families of areas: some nations belong to the one before them; suppliers without a station are members, feeders or families of their own."""
        nations = self.source("nation").selectExpr("concat('N', CASE WHEN n_nationkey % 8 = 4 THEN n_nationkey - 1 ELSE n_nationkey END) AS primary_area_id", "concat('N', n_nationkey) AS area_id", "CASE WHEN n_nationkey % 8 = 4 THEN 2 ELSE 0 END AS kind")
        suppliers = self.source("supplier").filter("s_suppkey % 10 = 9").selectExpr(
            "CASE WHEN s_suppkey div 10 % 4 = 3 THEN concat('S', s_suppkey) ELSE concat('N', CASE WHEN s_nationkey % 8 = 4 THEN s_nationkey - 1 ELSE s_nationkey END) END AS primary_area_id",
            "concat('S', s_suppkey) AS area_id", "CASE s_suppkey div 10 % 4 WHEN 3 THEN 1 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 4 END AS kind",
        )
        role = "CASE kind WHEN 0 THEN 'PRIMARY_RAIL' WHEN 1 THEN 'PRIMARY_STOP' WHEN 2 THEN 'RAIL_PLATFORM' WHEN 3 THEN 'NEARBY_URBAN' ELSE 'BUS_FEEDER' END AS member_role"
        return nations.union(suppliers).selectExpr(
            "concat('CAN_', primary_area_id) AS canonical_area_id", "primary_area_id", "area_id", role, "CAST(CASE WHEN kind < 2 THEN 0 ELSE (kind - 1) * 3 END AS int) AS access_cost_minutes",
            "CASE WHEN kind = 4 THEN 0 ELSE 1 END AS is_primary_for_routing", "CASE WHEN kind < 2 THEN 1 ELSE 0 END AS is_primary_for_search",
        )


#: The same projection as common table expressions; what an operator's SQL builds on.
SQL = """WITH RECURSIVE stops AS (
  SELECT 'N' || n_nationkey AS stop_id, 'NC' || n_nationkey AS stop_code,
    'Stadt' || n_nationkey || CASE n_nationkey % 4 WHEN 0 THEN ' Hbf' WHEN 1 THEN ' Bahnhof' WHEN 2 THEN ', Messe/Süd' ELSE '-Kampstraße U' END AS stop_name,
    51e0 + n_nationkey * 0.004e0 AS stop_lat, 7e0 + (n_nationkey % 5) * 0.003e0 AS stop_lon, CAST(NULL AS VARCHAR) AS parent_station, 1 AS location_type, CAST(NULL AS VARCHAR) AS platform_code FROM nation
  UNION ALL SELECT 'S' || s_suppkey, 'SC' || (s_suppkey % 50), 'Stadt' || s_nationkey || ' Gleis ' || s_suppkey,
    CASE WHEN s_suppkey % 17 <> 0 THEN 51e0 + s_nationkey * 0.004e0 + (s_suppkey % 7) * 0.0006e0 END, 7e0 + (s_nationkey % 5) * 0.003e0 + (s_suppkey % 3) * 0.0004e0,
    CASE WHEN s_suppkey % 10 <> 9 THEN 'N' || s_nationkey END, 0, CAST(s_suppkey % 6 AS VARCHAR) FROM supplier),
trips AS (SELECT 'T' || o_orderkey AS trip_id, 'R' || (o_custkey % 25) AS route_id, 'SV' || (o_custkey % 40) AS service_id, CAST(o_orderkey % 2 AS VARCHAR) AS direction_id FROM orders),
stop_times AS (SELECT *, departure_seconds - 30 AS arrival_seconds FROM (
  SELECT 'T' || l_orderkey AS trip_id, 'S' || l_suppkey AS stop_id, CAST(seq AS INTEGER) AS stop_sequence, CAST((l_orderkey * 37) % 86000 + seq * 600 AS INTEGER) AS departure_seconds FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS seq FROM lineitem))),
routes AS (SELECT 'R' || id AS route_id, CASE WHEN id % 7 = 3 THEN '' ELSE 'A' || (id % 5) END AS agency_id,
  CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'S' || id WHEN 2 THEN 'RE ' || id ELSE '  ' END AS route_short_name, CASE WHEN id % 6 <> 0 THEN ' Line ' || id END AS route_long_name,
  CAST(CASE id % 10 WHEN 4 THEN 100 WHEN 5 THEN 109 WHEN 6 THEN 400 WHEN 7 THEN 700 WHEN 8 THEN 900 WHEN 9 THEN NULL ELSE id % 10 END AS INTEGER) AS route_type,
  CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN NULL ELSE 'AA00CC' END AS route_color FROM range(25) t(id)),
agency AS (SELECT CASE WHEN r_regionkey = 3 THEN '' ELSE 'A' || r_regionkey END AS agency_id, r_name AS agency_name, r_regionkey AS ordinal,
  CASE r_regionkey WHEN 0 THEN 'Europe/Berlin' WHEN 1 THEN 'Europe/Zurich' WHEN 2 THEN 'Europe/Berlin' WHEN 3 THEN '' ELSE 'Mars/Olympus' END AS agency_timezone FROM region),
calendar AS (SELECT 'SV' || k AS service_id, k % 2 AS monday, 1 AS tuesday, 1 AS wednesday, CASE WHEN k % 3 = 2 THEN 1 ELSE 0 END AS thursday, 1 AS friday, CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS saturday,
  CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS sunday, '20240101' AS start_date, CASE WHEN k % 6 = 0 THEN '20240115' ELSE '20241231' END AS end_date
  FROM (SELECT DISTINCT CAST(o_custkey % 40 AS INTEGER) AS k FROM orders) WHERE k % 8 <> 7),
calendar_dates AS (SELECT 'SV' || k AS service_id, date, CASE WHEN k >= 30 THEN 2 ELSE 1 END AS exception_type FROM (
  SELECT DISTINCT CAST(user_id % 40 AS INTEGER) AS k, strftime(ts, '%Y%m%d') AS date FROM events WHERE event_type IN ('signup', 'error') AND user_id % 3 <> 0) WHERE k NOT IN (3, 15)),
transfers AS (SELECT a * 1000000 + b AS transfer_id, 'S' || a AS from_stop_id, CASE WHEN (a + b) % 11 = 0 THEN 'X' ELSE 'S' END || b AS to_stop_id, CASE WHEN (a * b) % 7 = 3 THEN 'R' || (a % 25) END AS from_route_id,
  CASE WHEN (a * b) % 13 = 5 THEN 'T' || a END AS from_trip_id, CASE WHEN (a + 2 * b) % 19 = 7 THEN 'R' || (b % 25) END AS to_route_id, CASE WHEN (a + 3 * b) % 23 = 6 THEN 'T' || b END AS to_trip_id, CASE WHEN (a + 2 * b) % 17 = 4 THEN 'SV' || (b % 40) END AS service_id,
  CASE WHEN (a + b) % 7 <> 6 THEN CAST((a + b) % 7 AS INTEGER) END AS transfer_type, CASE WHEN (a + b) % 7 = 2 THEN CAST((a * 13 + b * 7) % 4000 AS INTEGER) END AS min_transfer_time
  FROM (SELECT DISTINCT CAST(substr(stop_id, 2) AS BIGINT) AS a, CAST(substr(nxt, 2) AS BIGINT) AS b FROM (SELECT stop_id, lead(stop_id) OVER (PARTITION BY trip_id ORDER BY stop_sequence) AS nxt FROM stop_times) WHERE nxt IS NOT NULL)),
family_members AS (SELECT 'CAN_' || primary_area_id AS canonical_area_id, primary_area_id, area_id, CASE kind WHEN 0 THEN 'PRIMARY_RAIL' WHEN 1 THEN 'PRIMARY_STOP' WHEN 2 THEN 'RAIL_PLATFORM' WHEN 3 THEN 'NEARBY_URBAN' ELSE 'BUS_FEEDER' END AS member_role,
  CASE WHEN kind < 2 THEN 0 ELSE (kind - 1) * 3 END AS access_cost_minutes, CASE WHEN kind = 4 THEN 0 ELSE 1 END AS is_primary_for_routing, CASE WHEN kind < 2 THEN 1 ELSE 0 END AS is_primary_for_search FROM (
  SELECT 'N' || (CASE WHEN n_nationkey % 8 = 4 THEN n_nationkey - 1 ELSE n_nationkey END) AS primary_area_id, 'N' || n_nationkey AS area_id, CASE WHEN n_nationkey % 8 = 4 THEN 2 ELSE 0 END AS kind FROM nation
  UNION ALL SELECT CASE WHEN s_suppkey // 10 % 4 = 3 THEN 'S' || s_suppkey ELSE 'N' || (CASE WHEN s_nationkey % 8 = 4 THEN s_nationkey - 1 ELSE s_nationkey END) END, 'S' || s_suppkey,
    CASE s_suppkey // 10 % 4 WHEN 3 THEN 1 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 4 END FROM supplier WHERE s_suppkey % 10 = 9)),
names(name_id, name, folded, city) AS (VALUES """ + _names_sql() + """),
named_stops AS (SELECT CASE WHEN location_type = 1 THEN 500 ELSE 1000 END + CAST(substr(stop_id, 2) AS INTEGER) AS name_id, stop_name AS name, stop_name AS folded, regexp_extract(stop_name, '^(Stadt[0-9]+)', 1) AS city FROM stops UNION ALL SELECT * FROM names),
members AS (SELECT coalesce(nullif(trim(parent_station), ''), stop_id) AS area_id, stop_id, CASE WHEN nullif(trim(parent_station), '') IS NULL THEN 'AREA_ANCHOR' ELSE 'STOP' END AS member_role FROM stops),
norm AS (SELECT stop_id, """ + normal("stop_name") + """ AS stop_name_normalized FROM stops),
stop_areas AS (SELECT m.area_id, coalesce(max(CASE WHEN s.stop_id = m.area_id THEN s.stop_name END), min(s.stop_name)) AS area_name, avg(CASE WHEN s.stop_lat IS NOT NULL AND s.stop_lon IS NOT NULL THEN s.stop_lat END) AS area_lat,
  avg(CASE WHEN s.stop_lat IS NOT NULL AND s.stop_lon IS NOT NULL THEN s.stop_lon END) AS area_lon, count(*) AS stop_count FROM members m JOIN stops s USING (stop_id) GROUP BY 1),
labels AS (SELECT route_id, route_type, coalesce(nullif(trim(route_short_name), ''), nullif(trim(route_long_name), ''), route_id) AS line_label FROM routes),
area_routes AS (SELECT m.area_id, t.route_id, l.route_type, l.line_label, count(*) AS stop_time_count, count(DISTINCT st.trip_id) AS trip_count
  FROM stop_times st JOIN members m USING (stop_id) JOIN trips t USING (trip_id) JOIN labels l USING (route_id) GROUP BY ALL),
boarding AS (SELECT s.*, m.area_id FROM stops s JOIN members m USING (stop_id) WHERE coalesce(location_type, 0) = 0),
active AS (SELECT service_id FROM (SELECT service_id FROM calendar WHERE start_date <= '20240102' AND end_date >= '20240102' AND tuesday = 1
  UNION SELECT service_id FROM calendar_dates WHERE date = '20240102' AND exception_type = 1) WHERE service_id NOT IN (SELECT service_id FROM calendar_dates WHERE date = '20240102' AND exception_type = 2)),
legs AS (SELECT a.trip_id, t.route_id, t.service_id, a.stop_id AS from_stop_id, b.stop_id AS to_stop_id, ma.area_id AS from_area, mb.area_id AS to_area, a.stop_sequence AS from_sequence, b.stop_sequence AS to_sequence,
  a.departure_seconds, b.arrival_seconds FROM stop_times a JOIN stop_times b ON a.trip_id = b.trip_id AND b.stop_sequence > a.stop_sequence JOIN members ma ON ma.stop_id = a.stop_id JOIN members mb ON mb.stop_id = b.stop_id
  JOIN trips t ON t.trip_id = a.trip_id JOIN active USING (service_id)),
zones AS (SELECT t.service_id, count(DISTINCT nullif(trim(a.agency_timezone), '')) AS n, min(nullif(trim(a.agency_timezone), '')) AS zone FROM trips t JOIN routes r USING (route_id)
  LEFT JOIN agency a ON coalesce(a.agency_id, '') = coalesce(r.agency_id, '') GROUP BY 1),
feed_zone AS (SELECT count(DISTINCT nullif(trim(agency_timezone), '')) AS n, min(nullif(trim(agency_timezone), '')) AS zone FROM agency),
summary AS (SELECT s.service_id, CASE WHEN c.service_id IS NULL THEN 0 ELSE 1 END AS has_calendar, coalesce(monday + tuesday * 2 + wednesday * 4 + thursday * 8 + friday * 16 + saturday * 32 + sunday * 64, 0) AS weekday_mask, c.start_date, c.end_date,
  coalesce(x.addition_count, 0) AS addition_count, coalesce(x.removal_count, 0) AS removal_count, x.first_exception_date, x.last_exception_date, coalesce(n.trip_count, 0) AS trip_count,
  CASE WHEN z.n = 1 THEN z.zone WHEN z.n > 1 THEN 'MULTIPLE' WHEN g.n = 1 THEN g.zone ELSE 'UNKNOWN' END AS service_timezone,
  CASE WHEN c.service_id IS NOT NULL AND coalesce(x.addition_count, 0) + coalesce(x.removal_count, 0) > 0 THEN 'BASE_WITH_EXCEPTIONS' WHEN c.service_id IS NOT NULL THEN 'BASE_ONLY'
    WHEN coalesce(x.addition_count, 0) + coalesce(x.removal_count, 0) > 0 THEN 'EXCEPTIONS_ONLY' ELSE 'UNRESOLVED' END AS status
  FROM (SELECT service_id FROM calendar UNION SELECT service_id FROM calendar_dates UNION SELECT service_id FROM trips) s LEFT JOIN calendar c USING (service_id)
  LEFT JOIN (SELECT service_id, count(*) FILTER (exception_type = 1) AS addition_count, count(*) FILTER (exception_type = 2) AS removal_count, min(date) AS first_exception_date, max(date) AS last_exception_date FROM calendar_dates GROUP BY 1) x USING (service_id)
  LEFT JOIN (SELECT service_id, count(*) AS trip_count FROM trips GROUP BY 1) n USING (service_id) LEFT JOIN zones z USING (service_id) CROSS JOIN feed_zone g),
transfer_kinds AS (SELECT *, CASE WHEN coalesce(transfer_type, 0) = 0 THEN 'RECOMMENDED' WHEN transfer_type = 1 THEN 'TIMED' WHEN transfer_type = 2 THEN 'MINIMUM_TIME' WHEN transfer_type = 3 THEN 'PROHIBITED'
    WHEN transfer_type = 4 THEN 'IN_SEAT_ALLOWED' WHEN transfer_type = 5 THEN 'IN_SEAT_FORBIDDEN' ELSE 'UNKNOWN' END AS semantic,
  CASE WHEN coalesce(from_trip_id, to_trip_id) IS NOT NULL AND service_id IS NOT NULL THEN 'TRIP_SERVICE' WHEN coalesce(from_trip_id, to_trip_id) IS NOT NULL THEN 'TRIP' WHEN coalesce(from_route_id, to_route_id) IS NOT NULL THEN 'ROUTE' WHEN service_id IS NOT NULL THEN 'SERVICE' ELSE 'STOP' END AS scope_type FROM transfers)
"""
