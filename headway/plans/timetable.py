"""Read-only timetable questions as queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import derive, familyrouting, graph, journeys
from .registry import query
from ..sources import reports
from ..sources.testfeed import normal
from .rules import ALIASES, NAMED, TOKENS, alias_table, named_areas
from .tables import DAY, PROFILES, all_legs, area_routes, calendar_summary, members, profiles

LEG = "trip_id, route_id, service_id, from_stop_id, to_stop_id, from_sequence, to_sequence, departure_seconds, arrival_seconds"
LEG_COLUMNS = LEG.split(", ")


@query("SELECT area_id, area_name, stop_count FROM stop_areas WHERE area_id = 'N3'")
def q01_resolve_area(f):
    return derive.stop_areas(f.stops.filter("stop_id = 'N3' OR parent_station = 'N3'")).select("area_id", "area_name", "stop_count")


@query("SELECT m.stop_id, stop_name, member_role FROM members m LEFT JOIN stops s USING (stop_id) WHERE area_id = 'N3'")
def q02_area_members(f):
    return members(f).filter("area_id = 'N3'").join(f.stops.select("stop_id", "stop_name"), "stop_id", "left").select("stop_id", "stop_name", "member_role")


@query("""SELECT st.trip_id, st.stop_id, t.route_id, st.departure_seconds FROM stop_times st JOIN members m USING (stop_id) JOIN trips t USING (trip_id) JOIN active USING (service_id)
 WHERE m.area_id = 'N3' AND departure_seconds BETWEEN 21600 AND 64800 ORDER BY departure_seconds, st.trip_id, st.stop_sequence LIMIT 50""")
def q03_departures(f):
    return journeys.departures(f.stop_times, members(f), f.trips, derive.active_services(f.calendar, f.calendar_dates, DAY), "N3", 21600, 64800, 50).select("trip_id", "stop_id", "route_id", "departure_seconds")


@query("SELECT service_id FROM active")
def q04_active_services(f):
    return derive.active_services(f.calendar, f.calendar_dates, DAY)


STATUS = "CASE WHEN removed THEN 'removal' WHEN added THEN 'addition' WHEN base THEN 'calendar' ELSE 'inactive' END AS reason"


@query(f"""SELECT service_id, {STATUS} FROM (SELECT s.service_id, coalesce(bool_or(d.exception_type = 2), false) AS removed, coalesce(bool_or(d.exception_type = 1), false) AS added,
 coalesce(bool_or(c.start_date <= '{DAY}' AND c.end_date >= '{DAY}' AND c.tuesday = 1), false) AS base FROM (SELECT DISTINCT service_id FROM trips) s
 LEFT JOIN calendar_dates d ON d.service_id = s.service_id AND d.date = '{DAY}' LEFT JOIN calendar c ON c.service_id = s.service_id GROUP BY 1)""")
def q05_service_status(f):
    return journeys.service_status(f.trips.select("service_id").distinct(), f.calendar, f.calendar_dates, DAY)


@query(f"SELECT {LEG} FROM legs WHERE from_area = 'N20' AND to_area = 'N19' AND departure_seconds BETWEEN 18000 AND 79200 ORDER BY departure_seconds, arrival_seconds, trip_id, from_sequence, to_sequence LIMIT 500")
def q06_direct_legs(f):
    rows = all_legs(f, from_area="N20", to_area="N19").filter(F.col("departure_seconds").between(18000, 79200))
    return rows.orderBy("departure_seconds", "arrival_seconds", "trip_id", "from_sequence", "to_sequence").limit(500).select(*LEG_COLUMNS)


@query("""SELECT to_area, trip_id, departure_seconds, arrival_seconds FROM (SELECT *, row_number() OVER (PARTITION BY to_area ORDER BY arrival_seconds, departure_seconds, trip_id, to_sequence, from_sequence) AS r
 FROM legs WHERE from_area = 'N20' AND to_area <> 'N20' AND departure_seconds BETWEEN 21600 AND 64800) WHERE r = 1""")
def q07_next_legs(f):
    rows = all_legs(f, from_area="N20").filter("to_area <> 'N20' AND departure_seconds BETWEEN 21600 AND 64800")
    return journeys.earliest(rows, "to_area").select("to_area", "trip_id", "departure_seconds", "arrival_seconds")


@query("SELECT st.trip_id, stop_sequence, st.stop_id, stop_name, arrival_seconds, departure_seconds, t.route_id, t.service_id, t.direction_id, l.line_label, l.route_type FROM stop_times st LEFT JOIN stops USING (stop_id) LEFT JOIN trips t ON t.trip_id = st.trip_id LEFT JOIN labels l ON l.route_id = t.route_id WHERE st.trip_id IN ('T5', 'T7')")
def q08_trip_calls(f):
    """Calls of trips with what is known of trip and route."""
    trips = f.trips.join(derive.route_labels(f.routes), "route_id", "left")
    rows = f.stop_times.filter("trip_id IN ('T5', 'T7')").join(f.stops.select("stop_id", "stop_name"), "stop_id", "left").join(trips, "trip_id", "left")
    return rows.select("trip_id", "stop_sequence", "stop_id", "stop_name", "arrival_seconds", "departure_seconds", "route_id", "service_id", "direction_id", "line_label", "route_type")


@query("""SELECT d.service_id, d.day, CASE WHEN s.service_id IS NULL THEN 'UNKNOWN_SERVICE' WHEN x.kind = 1 THEN 'CALENDAR_DATES_ADDITION' WHEN x.kind = 2 THEN 'CALENDAR_DATES_REMOVAL' WHEN x.service_id IS NOT NULL THEN 'INVALID_EXCEPTION_TYPE' WHEN has_calendar = 0 THEN 'EXCEPTIONS_ONLY_NO_ADDITION'
 WHEN start_date IS NULL OR end_date IS NULL OR d.day < start_date OR d.day > end_date THEN 'OUTSIDE_CALENDAR_RANGE' WHEN (weekday_mask & (1 << (isodow(strptime(d.day, '%Y%m%d')) - 1))) <> 0 THEN 'CALENDAR_WEEKDAY_ACTIVE' ELSE 'CALENDAR_WEEKDAY_INACTIVE' END AS reason,
 CASE WHEN s.service_id IS NULL THEN false WHEN x.service_id IS NOT NULL THEN x.kind = 1 ELSE has_calendar = 1 AND coalesce(d.day BETWEEN start_date AND end_date, false) AND (weekday_mask & (1 << (isodow(strptime(d.day, '%Y%m%d')) - 1))) <> 0 END AS active
 FROM (SELECT service_id, day FROM (SELECT DISTINCT service_id FROM trips UNION ALL SELECT 'NONE') CROSS JOIN (VALUES ('20240102'), ('20240106'), ('20240116'), ('20231231')) v(day)) d LEFT JOIN summary s USING (service_id)
 LEFT JOIN (SELECT service_id, date, CASE WHEN service_id IN ('SV1', 'SV2') THEN 7 ELSE exception_type END AS kind FROM calendar_dates) x ON x.service_id = d.service_id AND x.date = d.day""")
def q09_service_day_reasons(f):
    """Also of a service that no table knows, and with exceptions of an unknown type."""
    dates = f.calendar_dates.withColumn("exception_type", F.when(F.col("service_id").isin("SV1", "SV2"), 7).otherwise(F.col("exception_type")))
    asked = f.trips.select("service_id").distinct().union(f.spark.createDataFrame([("NONE",)], "service_id string"))
    return journeys.day_reasons(asked, calendar_summary(f), dates, ["20240102", "20240106", "20240116", "20231231"])


@query("SELECT service_id, list_sort(list(trip_id))[1:20] AS sample FROM trips JOIN active USING (service_id) GROUP BY 1")
def q10_trip_samples(f):
    rows = f.trips.join(derive.active_services(f.calendar, f.calendar_dates, DAY), "service_id")
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("service_id").orderBy("trip_id"))).filter("r <= 20")
    return few.groupBy("service_id").agg(F.array_sort(F.collect_list("trip_id")).alias("sample"))


@query(f"SELECT {LEG} FROM (SELECT * FROM legs WHERE from_area = 'N20' AND to_area = 'N19' ORDER BY trip_id, from_sequence, to_sequence LIMIT 100) ORDER BY departure_seconds, arrival_seconds, trip_id, from_sequence, to_sequence LIMIT 10")
def q11_direct_connections(f):
    scan = all_legs(f, from_area="N20", to_area="N19").orderBy("trip_id", "from_sequence", "to_sequence").limit(100)
    return scan.orderBy("departure_seconds", "arrival_seconds", "trip_id", "from_sequence", "to_sequence").limit(10).select(*LEG_COLUMNS)


CANDIDATES = """, removed AS (SELECT service_id FROM calendar_dates WHERE date = '20240102' AND exception_type = 2), added AS (SELECT service_id FROM calendar_dates WHERE date = '20240102' AND exception_type = 1),
rides AS (SELECT a.trip_id, t.service_id, ma.area_id AS from_area, mb.area_id AS to_area, a.departure_seconds, b.arrival_seconds, t.service_id IN (SELECT service_id FROM active) AS runs, t.service_id IN (SELECT service_id FROM active) AND t.service_id IN (SELECT service_id FROM added) AS by_addition, t.service_id IN (SELECT service_id FROM removed) AS by_removal
  FROM stop_times a JOIN stop_times b ON a.trip_id = b.trip_id AND b.stop_sequence > a.stop_sequence JOIN members ma ON ma.stop_id = a.stop_id JOIN members mb ON mb.stop_id = b.stop_id JOIN trips t ON t.trip_id = a.trip_id)
"""


def rides(f, **ends):
    """All rides, whatever their services do on the day, with what the day says of them."""
    every = f.trips.select("service_id").distinct()
    status = journeys.service_status(every, f.calendar, f.calendar_dates, DAY)
    return derive.legs(f.stop_times, members(f), f.trips, every, **ends).join(F.broadcast(status), "service_id")


@query(CANDIDATES + """SELECT count(*) AS raw, count(*) FILTER (runs) AS active, count(*) FILTER (by_addition) AS added, count(*) FILTER (by_removal) AS removed FROM rides WHERE from_area = 'N20' AND to_area = 'N19' AND departure_seconds BETWEEN 18000 AND 79200 AND arrival_seconds >= departure_seconds""")
def q12_direct_diagnostics(f):
    rows = rides(f, from_area="N20", to_area="N19").filter(F.col("departure_seconds").between(18000, 79200) & (F.col("arrival_seconds") >= F.col("departure_seconds")))
    why = F.col("reason")
    return rows.agg(F.count("*").alias("raw"), F.count_if(why.isin("addition", "calendar")).alias("active"), F.count_if(why == "addition").alias("added"), F.count_if(why == "removal").alias("removed"))


ONE_CHANGE = """, firsts AS (SELECT * FROM legs WHERE from_area = 'N20' AND to_area NOT IN ('N20', 'N19') AND departure_seconds BETWEEN 21600 AND 64800 AND arrival_seconds >= departure_seconds ORDER BY arrival_seconds, departure_seconds, to_area, trip_id, from_sequence, to_sequence LIMIT 500),
bests AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY to_area ORDER BY arrival_seconds, departure_seconds DESC, trip_id, from_sequence, to_sequence) AS k FROM firsts) WHERE k = 1),
changes AS (SELECT b.*, area_name FROM bests b JOIN stop_areas a ON a.area_id = b.to_area ORDER BY arrival_seconds, departure_seconds, area_name, to_area LIMIT 25),
met AS (SELECT c.to_area AS transfer_area, c.area_name AS transfer_name, c.trip_id AS first_trip, s.trip_id AS second_trip, c.departure_seconds, s.arrival_seconds, (s.departure_seconds - c.arrival_seconds) // 60 AS wait_minutes,
  row_number() OVER (PARTITION BY c.to_area ORDER BY s.departure_seconds, s.arrival_seconds, s.trip_id, s.from_sequence, s.to_sequence) AS r FROM changes c JOIN legs s ON s.from_area = c.to_area AND s.to_area = 'N19' AND s.arrival_seconds >= s.departure_seconds AND s.departure_seconds BETWEEN c.arrival_seconds + 180 AND c.arrival_seconds + 2700)
"""


@query(ONE_CHANGE + """SELECT transfer_area, transfer_name, first_trip, second_trip, departure_seconds, arrival_seconds, min(wait_minutes) AS wait_minutes FROM met WHERE r <= 20 GROUP BY 1, 2, 3, 4, 5, 6
 ORDER BY departure_seconds, arrival_seconds, wait_minutes, transfer_name, transfer_area, first_trip, second_trip LIMIT 10""")
def q13_one_transfer(f):
    return journeys.one_transfer(all_legs(f, from_area="N20"), all_legs(f, to_area="N19"), derive.stop_areas(f.stops), "N20", "N19", 21600, 64800)


@query("""SELECT * FROM (SELECT NULL AS transfer_area, trip_id AS first_trip, NULL AS second_trip, departure_seconds, arrival_seconds FROM legs WHERE from_area = 'N20' AND to_area = 'N19' AND departure_seconds BETWEEN 21600 AND 22600
 UNION ALL SELECT DISTINCT c.to_area, c.trip_id, s.trip_id, c.departure_seconds, s.arrival_seconds FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY to_area ORDER BY arrival_seconds, departure_seconds, trip_id, to_sequence, from_sequence) AS k FROM legs
  WHERE from_area = 'N20' AND to_area NOT IN ('N20', 'N19') AND departure_seconds BETWEEN 21600 AND 22600 AND arrival_seconds >= departure_seconds) WHERE k = 1 ORDER BY arrival_seconds, departure_seconds, trip_id, to_area LIMIT 40) c
  JOIN legs s ON s.from_area = c.to_area AND s.to_area = 'N19' AND s.departure_seconds BETWEEN c.arrival_seconds + 180 AND least(22600 + 7200, c.arrival_seconds + 2700) WHERE (SELECT count(*) FROM legs WHERE from_area = 'N20' AND to_area = 'N19' AND departure_seconds BETWEEN 21600 AND 22600) < 1000)
 ORDER BY departure_seconds, arrival_seconds, first_trip, second_trip NULLS FIRST, transfer_area NULLS FIRST LIMIT 20""")
def q14_hybrid_search(f):
    return journeys.hybrid(all_legs(f, from_area="N20", to_area="N19"), all_legs(f, from_area="N20"), all_legs(f, to_area="N19"), "N20", "N19", 21600, 22600, enough=1000)


@query(CANDIDATES + "SELECT count(*) AS raw, count(*) FILTER (runs) AS active, count(DISTINCT to_area) FILTER (runs) AS areas FROM rides WHERE from_area = 'N20' AND to_area <> 'N20' AND departure_seconds BETWEEN 21600 AND 64800 AND arrival_seconds >= departure_seconds")
def q15_next_leg_funnel(f):
    rows = rides(f, from_area="N20").filter(F.col("departure_seconds").between(21600, 64800) & (F.col("to_area") != "N20") & (F.col("arrival_seconds") >= F.col("departure_seconds")))
    runs = F.col("reason").isin("addition", "calendar")
    return rows.agg(F.count("*").alias("raw"), F.count_if(runs).alias("active"), F.count_distinct(F.when(runs, F.col("to_area"))).alias("areas"))


QUERIES = ["Stadt1", "stadt4 hbf", "Hauptbahnhof", "Altenfels", "Altenfels Hauptbahnhof", "bergau", "U Birkental", "Seeh", "Ärzte-Haus", "xyz", " - "]
ASKED = ", ".join(f"('{q}')" for q in QUERIES)
WHOLE = "'hbf', 'hauptbahnhof', 'bf', 'bahnhof', 'u', 'ubahn', 's', 'sbahn'"
SEARCH = TOKENS + f""", asked AS (SELECT q, n, list_distinct(string_split(n, ' ')) AS ws FROM (SELECT q, {normal('q')} AS n FROM (VALUES {ASKED}) v(q)) WHERE n <> ''),
parts AS (SELECT q, n, ws, len(ws) > 1 AND len(list_filter(ws, lambda w: w NOT IN ({WHOLE}))) > 0 AS specific FROM asked),
told_words AS (SELECT DISTINCT q, w FROM (SELECT q, unnest(ws) AS w FROM parts UNION ALL SELECT q, y.token FROM (SELECT q, unnest(ws) AS w FROM parts) x JOIN (VALUES ('hbf', 'hauptbahnhof'), ('hauptbahnhof', 'hbf'), ('bf', 'bahnhof'), ('bahnhof', 'bf'), ('u', 'ubahn'), ('s', 'sbahn')) y(w, token) USING (w))),
used AS (SELECT q, w FROM told_words JOIN parts USING (q) WHERE NOT (specific AND w IN ({WHOLE}))),
lookups AS (SELECT q, n AS w, true AS whole FROM parts UNION SELECT q, w, true FROM used UNION SELECT q, w, false FROM used WHERE length(w) >= 3),
found AS (SELECT q, w, whole, area_id, token, token_type, source FROM lookups JOIN tokens ON CASE WHEN whole THEN token = w ELSE starts_with(token, w) END),
points AS (SELECT q, w, area_id, coalesce(max(CASE WHEN whole THEN CASE WHEN token_type = 'NORMALIZED' THEN 1600 ELSE 1000 END END), 0) + CASE WHEN bool_or(NOT whole) THEN 420 ELSE 0 END + 180 * count(DISTINCT token) FILTER (source = 'AREA_NAME') AS p FROM found GROUP BY 1, 2, 3),
totals AS (SELECT q, area_id, sum(p) AS p, list(w) AS seen FROM points GROUP BY 1, 2),
scored AS (SELECT q AS query, area_id, name AS area_name, CAST(p + CASE WHEN f = n THEN 8000 WHEN starts_with(f, n) THEN 3000 WHEN contains(f, n) THEN 1200 ELSE 0 END + CASE WHEN missing = 0 THEN 4000 ELSE -4000 * missing END + least(120, stop_count * 4) AS BIGINT) AS score
  FROM (SELECT t.*, a.name, a.stop_count, a.f, p.n, len(list_filter(p.ws, lambda w: NOT list_contains(t.seen, w) AND NOT list_contains(string_split(a.f, ' '), w))) AS missing FROM totals t JOIN parts p USING (q) JOIN (SELECT d.area_id, d.name, coalesce(s.stop_count, 1) AS stop_count, {normal('d.folded')} AS f FROM named d LEFT JOIN stop_areas s USING (area_id)) a USING (area_id)))
"""


def search_areas(f):
    return derive.stop_areas(f.stops).select("area_id", "area_name", "stop_count").union(named_areas(f).filter("area_id LIKE 'name%'").select("area_id", "area_name", F.lit(1)))


@query(SEARCH + "SELECT query, area_id, area_name, score, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, area_name, area_id) AS r FROM scored) WHERE r <= 20")
def q16_stop_search(f):
    asked = f.spark.createDataFrame([(q,) for q in QUERIES], "query string")
    return journeys.search(derive.search_tokens(f.stops, named_areas(f)), search_areas(f), asked, 20)


@query(SEARCH + """, best AS (SELECT query, area_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, area_name, area_id) AS r FROM scored) WHERE r = 1),
 gone AS (SELECT area_id, count(*) AS departures, min(departure_seconds) AS first_departure FROM stop_times JOIN members USING (stop_id) JOIN trips USING (trip_id) JOIN active USING (service_id) WHERE departure_seconds BETWEEN 21600 AND 36000 GROUP BY 1)
 SELECT query, area_id, score, coalesce(departures, 0) AS departures, first_departure FROM best LEFT JOIN gone USING (area_id)""")
def q17_search_with_departures(f):
    """The best area of each query and what leaves there in a window of the day."""
    asked = f.spark.createDataFrame([(q,) for q in QUERIES], "query string")
    best = journeys.search(derive.search_tokens(f.stops, named_areas(f)), search_areas(f), asked, 1).select("query", "area_id", "score")
    rows = f.stop_times.filter(F.col("departure_seconds").between(21600, 36000)).join(members(f), "stop_id").join(f.trips, "trip_id").join(derive.active_services(f.calendar, f.calendar_dates, DAY), "service_id")
    gone = rows.groupBy("area_id").agg(F.count("*").alias("departures"), F.min("departure_seconds").alias("first_departure"))
    return best.join(gone, "area_id", "left").fillna(0, ["departures"])


FAMILY_SEARCH = PROFILES + ALIASES.replace(NAMED, NAMED, 1) + TOKENS.replace(NAMED, "", 1) + f""", queries AS (SELECT q, {normal('q')} AS n FROM (VALUES {ASKED}) v(q)), heads AS (SELECT area_id, {normal('folded')} AS f FROM named WHERE left(area_id, 1) <> 'S'),
 hits AS (SELECT q, area_id, CASE WHEN f = n THEN 45000 ELSE 18000 END AS p FROM queries JOIN heads ON starts_with(f, n) WHERE n <> '' UNION ALL SELECT q, area_id, CASE WHEN alias_normalized = n THEN 20000 ELSE 8000 END + priority * 100 FROM queries JOIN aliases ON starts_with(alias_normalized, n) WHERE n <> ''
  UNION ALL SELECT q, area_id, 2000 * count(DISTINCT token) FROM (SELECT DISTINCT q, unnest(string_split(n, ' ')) AS w FROM queries WHERE n <> '') JOIN tokens ON token = w GROUP BY 1, 2)
"""


@query(FAMILY_SEARCH + "SELECT q AS query, h.area_id, CAST(sum(p + coalesce(search_priority_score, 0)) AS BIGINT) AS score FROM hits h LEFT JOIN profiles USING (area_id) GROUP BY 1, 2")
def q18_canonical_search(f):
    asked = f.spark.createDataFrame([(q,) for q in QUERIES], "query string")
    heads = named_areas(f).filter("NOT startswith(area_id, 'S')").select("area_id", F.col("area_name").alias("display_name"))
    return journeys.family_search(heads, alias_table(f), derive.search_tokens(f.stops, named_areas(f)), profiles(f), asked)


RELATIONS = [(f"N{k}", f"N{(k + d) % 25}") for d in (1, 2, 7, 12, 19) for k in range(25)]
#: Relations between families that a task makes.
TASK_RELATIONS = 1_000_000
WINDOWS = [(21600, 25200, 36000), (43200, 45000, 54000), (64800, 68400, 82800), (79200, 86400, 93600)]


def top(rows: str, key: str, order: str, k: int) -> str:
    return f"SELECT * EXCLUDE (_k) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _k FROM ({rows})) WHERE _k <= {k}"


CASE = "start, target, lo, hi, latest"
PAIR = CASE + ", a, b"
FAMILIES = """, shown AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical_area_id ORDER BY is_primary_for_routing DESC, is_primary_for_search DESC, access_cost_minutes, member_role, area_id) AS k FROM family_members) WHERE k <= 12),
owned AS (SELECT requested, coalesce((SELECT min(m.canonical_area_id) FROM family_members m WHERE m.area_id = requested), (SELECT min(m.canonical_area_id) FROM family_members m WHERE m.primary_area_id = requested)) AS canonical_area_id FROM requests),
expanded AS (SELECT requested, canonical_area_id, area_id, member_role, access_cost_minutes, is_primary_for_routing, is_primary_for_search, 0 AS added FROM owned JOIN shown USING (canonical_area_id)
  UNION ALL SELECT requested, coalesce(canonical_area_id, requested), requested, 'RAW_STOP_AREA', 0, 1, 1, 1 FROM owned o WHERE NOT EXISTS (SELECT 1 FROM shown s WHERE s.canonical_area_id = o.canonical_area_id AND s.area_id = o.requested)),
placed AS (SELECT *, row_number() OVER (PARTITION BY requested ORDER BY added, is_primary_for_routing DESC, is_primary_for_search DESC, access_cost_minutes, member_role, area_id) AS place FROM expanded),
routing AS (SELECT * FROM (SELECT requested, area_id, access_cost_minutes, row_number() OVER (PARTITION BY requested ORDER BY is_primary_for_routing DESC, access_cost_minutes, area_id) AS routing_place FROM expanded WHERE is_primary_for_routing = 1 OR area_id = requested) WHERE routing_place <= 8)"""


@query(", requests AS (SELECT DISTINCT area_id AS requested FROM stop_areas UNION SELECT 'nowhere')" + FAMILIES + " SELECT requested, canonical_area_id, area_id, member_role, access_cost_minutes, place, routing_place FROM placed LEFT JOIN routing USING (requested, area_id, access_cost_minutes)")
def q20_station_families(f):
    """The family of every area, as it is searched from there."""
    areas = derive.stop_areas(f.stops).select("area_id")
    return familyrouting.station_families(f.family_members, areas.union(f.spark.createDataFrame([("nowhere",)], "area_id string")))


#: Counts of rides of each case, over pairs of family members; legs, which has every ride of the day, is restricted by nothing here.
COVERAGE = f""", requests AS (SELECT start AS requested FROM cases UNION SELECT target FROM cases){FAMILIES},
pairs AS MATERIALIZED (SELECT c.*, s.area_id AS a, t.area_id AS b, least(hi, lo + s.access_cost_minutes * 60) AS alo, least(hi, lo + t.access_cost_minutes * 60) AS blo, latest - t.access_cost_minutes * 60 AS until FROM cases c JOIN routing s ON s.requested = start JOIN routing t ON t.requested = target),
timely AS MATERIALIZED (SELECT * FROM legs WHERE arrival_seconds >= departure_seconds),
directs AS MATERIALIZED (SELECT {CASE}, count(*) AS n FROM ({top("SELECT c.*, l.arrival_seconds AS a1, l.departure_seconds AS d1, l.trip_id AS t1, l.from_sequence AS f1, l.to_sequence AS o1 FROM pairs c JOIN timely l ON l.from_area = a AND l.to_area = b AND l.departure_seconds BETWEEN alo AND hi WHERE until > alo", PAIR, "d1, a1, t1, f1, o1", 8)}) WHERE a1 <= until GROUP BY ALL),
left1 AS MATERIALIZED (SELECT * FROM pairs ANTI JOIN directs USING ({CASE})),
reached AS MATERIALIZED ({top("SELECT c.*, l.to_area AS area1, l.trip_id AS t1, l.departure_seconds AS d1, l.arrival_seconds AS a1, l.to_sequence AS o1, l.from_sequence AS f1 FROM (SELECT DISTINCT a, alo, hi FROM left1) c JOIN timely l ON l.from_area = a AND l.to_area <> a AND l.departure_seconds BETWEEN alo AND hi", "a, alo, hi, area1", "a1, d1, t1, o1, f1", 1)}),
soonest AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY a, alo, hi ORDER BY a1, d1, t1, area1) AS turn FROM reached),
first1 AS (SELECT * FROM left1 JOIN soonest USING (a, alo, hi) WHERE turn <= 60 AND area1 NOT IN (a, b)),
ones AS MATERIALIZED (SELECT {CASE}, count(*) AS n FROM ({top("SELECT c.*, l.departure_seconds AS d2, l.arrival_seconds AS a2, l.trip_id AS t2, l.from_sequence AS f2, l.to_sequence AS o2 FROM first1 c JOIN timely l ON l.from_area = area1 AND l.to_area = b AND l.departure_seconds BETWEEN a1 + 180 AND least(a1 + 2700, until) WHERE least(a1 + 2700, until) > a1 + 180", PAIR + ", area1", "d2, a2, t2, f2, o2", 8)}) GROUP BY ALL),
first2 AS MATERIALIZED (SELECT * FROM first1 ANTI JOIN ones USING ({CASE}) WHERE turn <= 30),
again AS ({top("SELECT c.*, l.to_area AS area2, l.trip_id AS t2, l.departure_seconds AS d2, l.arrival_seconds AS a2, l.to_sequence AS o2, l.from_sequence AS f2 FROM (SELECT DISTINCT area1, a1, latest FROM first2) c JOIN timely l ON l.from_area = area1 AND l.to_area <> area1 AND l.departure_seconds BETWEEN a1 + 180 AND least(a1 + 2100, latest)", "area1, a1, latest, area2", "a2, d2, t2, o2, f2", 1)}),
second AS (SELECT * FROM first2 JOIN ({top("SELECT * FROM again", "area1, a1, latest", "a2, d2, t2, area2", 10)}) USING (area1, a1, latest) WHERE area2 NOT IN (a, b) AND t2 <> t1),
twos AS (SELECT {CASE}, sum(n) AS n FROM (SELECT {PAIR}, count(DISTINCT t1 || '|' || t2 || '|' || t3) AS n FROM ({top("SELECT c.*, l.departure_seconds AS d3, l.arrival_seconds AS a3, l.trip_id AS t3, l.from_sequence AS f3, l.to_sequence AS o3 FROM second c JOIN timely l ON l.from_area = area2 AND l.to_area = b AND l.departure_seconds BETWEEN a2 + 180 AND least(a2 + 2100, until) WHERE least(a2 + 2100, until) > a2 + 180", PAIR + ", area1, area2", "d3, a3, t3, f3, o3", 5)})
  WHERE (d2 - a1) // 60 + (d3 - a2) // 60 <= 60 GROUP BY ALL) GROUP BY ALL),
running AS MATERIALIZED (SELECT area_id, departure_seconds FROM stop_times JOIN members USING (stop_id) JOIN trips USING (trip_id) SEMI JOIN active USING (service_id)),
counted AS (SELECT c.start, c.target, c.lo AS from_seconds, c.hi AS to_seconds, c.latest, coalesce(d.n, 0) AS direct, coalesce(o.n, 0) AS one_transfer, CAST(coalesce(t.n, 0) AS BIGINT) AS two_transfers,
  CASE WHEN d.n > 0 THEN 'FOUND_DIRECT' WHEN o.n > 0 THEN 'FOUND_ONE_TRANSFER' WHEN t.n > 0 THEN 'FOUND_TWO_TRANSFER' ELSE 'UNKNOWN' END AS classification,
  EXISTS (SELECT 1 FROM pairs p JOIN running r ON r.area_id = p.a AND r.departure_seconds BETWEEN p.alo AND p.hi WHERE p.start = c.start AND p.lo = c.lo AND p.hi = c.hi) AS start_departs,
  EXISTS (SELECT 1 FROM pairs p JOIN running r ON r.area_id = p.b AND r.departure_seconds BETWEEN p.blo AND p.hi WHERE p.target = c.target AND p.lo = c.lo AND p.hi = c.hi) AS target_departs
  FROM cases c LEFT JOIN directs d USING ({CASE}) LEFT JOIN ones o USING ({CASE}) LEFT JOIN twos t USING ({CASE}))
SELECT *, CASE WHEN classification <> 'UNKNOWN' THEN 'OK' WHEN NOT (start_departs AND target_departs) THEN 'NO_ACTIVE_DEPARTURES_SELECTED_AREA' ELSE 'TRANSFER_DEPTH_OR_SEARCH_WINDOW' END AS suspected_cause FROM counted"""
CASE_TYPES = "start string, target string, from_seconds int, to_seconds int, latest int"


def family_calls(f):
    return familyrouting.active_calls(f.stop_times, members(f), f.trips, derive.active_services(f.calendar, f.calendar_dates, DAY))


@query(f", cases(start, target, lo, hi, latest) AS (SELECT a, b, lo, hi, latest FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in RELATIONS)}) r(a, b) CROSS JOIN (VALUES {', '.join(map(str, WINDOWS))}) w(lo, hi, latest))" + COVERAGE)
def q23_coverage_matrix(f):
    """125 relations by four windows, over families: the first kind of ride that is found, and what may be the cause where none is."""
    cases = f.spark.createDataFrame([(a, b, *w) for a, b in RELATIONS for w in WINDOWS], CASE_TYPES)
    return familyrouting.coverage(family_calls(f), f.family_members, cases)


@query(", heads AS (SELECT DISTINCT primary_area_id AS area_id FROM family_members), cases AS (SELECT x.area_id AS start, y.area_id AS target, 28800 AS lo, 30600 AS hi, 36000 AS latest FROM heads x CROSS JOIN heads y WHERE x.area_id <> y.area_id)" + COVERAGE)
def q22_all_relations(f):
    """Every relation between two families in one window."""
    heads = graph.written(f.family_members.select("primary_area_id").distinct())
    # all relations are the question; families are few rows, so starts are dealt by the number of relations
    tasks = max(f.spark.sparkContext.defaultParallelism, heads.count() ** 2 // TASK_RELATIONS)
    pairs = heads.toDF("start").repartition(tasks).join(F.broadcast(heads.toDF("target")), F.col("start") != F.col("target"))
    cases = pairs.select("start", "target", F.lit(28800).alias("from_seconds"), F.lit(30600).alias("to_seconds"), F.lit(36000).alias("latest"))
    return familyrouting.coverage(family_calls(f), f.family_members, cases)


def _round(name: str, before: str, since: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT s.start, l.to_area AS area_id, min(l.arrival_seconds) AS got FROM {before} s JOIN legs l ON l.from_area = s.area_id AND l.departure_seconds >= {since} AND l.departure_seconds <= 36000 AND l.arrival_seconds <= 36000 GROUP BY ALL)"


@query(", requests AS (SELECT DISTINCT primary_area_id AS requested FROM family_members)" + FAMILIES + f""", ready AS (SELECT requested AS start, area_id, 28800 + access_cost_minutes * 60 AS got FROM routing),
{_round("ride1", "ready", "s.got")}, {_round("ride2", "ride1", "s.got + 180")}, {_round("ride3", "ride2", "s.got + 180")},
best AS (SELECT start, area_id, min(got * 10 + k) AS x FROM (SELECT *, 1 AS k FROM ride1 UNION ALL SELECT *, 2 FROM ride2 UNION ALL SELECT *, 3 FROM ride3) GROUP BY ALL),
ends AS (SELECT b.start, r.requested AS target, min(x + r.access_cost_minutes * 600) AS x FROM best b JOIN routing r ON r.area_id = b.area_id WHERE b.start <> r.requested AND x // 10 + r.access_cost_minutes * 60 <= 36000 GROUP BY ALL)
SELECT start, target, CAST(x // 10 AS INTEGER) AS arrival_seconds, CAST(x % 10 AS INTEGER) AS rides FROM ends""")
def q22_family_arrivals(f):
    """When each family is reached first from each other, with up to two changes."""
    heads = f.family_members.select(F.col("primary_area_id").alias("area_id")).distinct()
    return familyrouting.earliest_arrivals(family_calls(f), f.family_members, heads, heads, 28800, 36000)


_BROKEN = "CASE WHEN ascii(right(trip_id, 1)) % 4 = 1 THEN {a} ELSE {b} END"


@query(""", claims AS (SELECT trip_id, from_stop_id, to_stop_id, from_sequence, to_sequence, departure_seconds + CASE WHEN ascii(right(trip_id, 1)) % 4 = 1 THEN 60 ELSE 0 END AS departure_seconds, CASE WHEN ascii(right(trip_id, 1)) % 5 = 2 THEN 0 ELSE arrival_seconds END AS arrival_seconds, CASE WHEN ascii(right(trip_id, 1)) % 6 = 3 THEN 'NONE' ELSE service_id END AS service_id FROM legs WHERE from_area = 'N20' AND to_area = 'N19')
 SELECT c.trip_id, c.from_sequence, c.to_sequence, list_filter([CASE WHEN a.trip_id IS NULL OR b.trip_id IS NULL THEN 'CALL_NOT_FOUND' END, CASE WHEN a.departure_seconds <> c.departure_seconds OR b.arrival_seconds <> c.arrival_seconds THEN 'TIME_MISMATCH' END, CASE WHEN c.arrival_seconds < c.departure_seconds THEN 'ARRIVES_BEFORE_DEPARTURE' END,
  CASE WHEN c.to_sequence <= c.from_sequence THEN 'WRONG_ORDER' END, CASE WHEN c.service_id NOT IN (SELECT service_id FROM active) THEN 'SERVICE_INACTIVE' END], lambda x: x IS NOT NULL) AS failures FROM claims c
 LEFT JOIN stop_times a ON a.trip_id = c.trip_id AND a.stop_sequence = c.from_sequence AND a.stop_id = c.from_stop_id LEFT JOIN stop_times b ON b.trip_id = c.trip_id AND b.stop_sequence = c.to_sequence AND b.stop_id = c.to_stop_id""")
def q25_leg_validation(f):
    """Claimed legs against the tables, some of them with wrong times or services."""
    last = F.ascii(F.substring("trip_id", -1, 1))
    legs = all_legs(f, from_area="N20", to_area="N19")
    claims = legs.withColumns({"departure_seconds": F.col("departure_seconds") + F.when(last % 4 == 1, 60).otherwise(0), "arrival_seconds": F.when(last % 5 == 2, 0).otherwise(F.col("arrival_seconds")), "service_id": F.when(last % 6 == 3, "NONE").otherwise(F.col("service_id"))})
    return journeys.leg_failures(claims, f.stop_times, derive.active_services(f.calendar, f.calendar_dates, DAY)).select("trip_id", "from_sequence", "to_sequence", "failures")


@query("SELECT to_area, trip_id FROM (SELECT *, row_number() OVER (PARTITION BY to_area ORDER BY arrival_seconds, departure_seconds DESC, trip_id, from_sequence, to_sequence) AS k FROM legs WHERE from_area = 'N20' AND to_area <> 'N20') WHERE k = 1")
def win04_latest_departure(f):
    return journeys.earliest(all_legs(f, from_area="N20").filter("to_area <> 'N20'"), "to_area", latest=True).select("to_area", "trip_id")


@query("SELECT to_area, trip_id, arrival_seconds FROM (SELECT *, row_number() OVER (PARTITION BY to_area ORDER BY arrival_seconds, departure_seconds, trip_id, to_sequence, from_sequence) AS r FROM legs WHERE from_area = 'N5') WHERE r = 1")
def win01_earliest_arrival(f):
    return journeys.earliest(all_legs(f, from_area="N5"), "to_area").select("to_area", "trip_id", "arrival_seconds")


@query("SELECT trip_id, stop_id, departure_seconds FROM stop_times ORDER BY departure_seconds, trip_id, stop_sequence LIMIT 25")
def ord01_first_departures(f):
    return f.stop_times.orderBy("departure_seconds", "trip_id", "stop_sequence").limit(25).select("trip_id", "stop_id", "departure_seconds")


@query("SELECT stop_id, count(*) AS n FROM (SELECT * FROM stop_times ORDER BY departure_seconds, trip_id, stop_sequence LIMIT 500) GROUP BY 1")
def ord02_limit_then_count(f):
    return f.stop_times.orderBy("departure_seconds", "trip_id", "stop_sequence").limit(500).groupBy("stop_id").agg(F.count("*").alias("n"))


WAYS = "SELECT canonical_area_id, area_id AS from_area_id, primary_area_id AS to_area_id, access_cost_minutes AS minutes, 'CANONICAL_FAMILY_DISTANCE' AS source FROM family_members WHERE area_id <> primary_area_id"


@query(PROFILES + f""", ways AS ({WAYS} UNION ALL SELECT canonical_area_id, to_area_id, from_area_id, minutes, source FROM ({WAYS}) UNION ALL SELECT canonical_area_id, area_id, area_id, 0, 'SAME_CANONICAL_PRIMARY' FROM family_members WHERE area_id = primary_area_id),
asked AS (SELECT area_id AS requested, min(canonical_area_id) AS canonical_area_id FROM family_members WHERE area_id IN (SELECT area_id FROM stop_areas) GROUP BY 1),
leaving AS (SELECT area_id, count(*) AS departures FROM stop_times JOIN members USING (stop_id) JOIN trips USING (trip_id) SEMI JOIN active USING (service_id) WHERE departure_seconds BETWEEN 28800 AND 36000 GROUP BY 1)
SELECT requested, canonical_area_id, 'member' AS part, CAST(row_number() OVER (PARTITION BY requested ORDER BY is_primary_for_search DESC, is_primary_for_routing DESC, access_cost_minutes, member_role, area_name, f.area_id) AS INTEGER) AS place, f.area_id, NULL AS other_area_id, member_role AS role, access_cost_minutes AS minutes,
 coalesce(profile_class, '') AS profile_class, coalesce(departures, 0) AS departures FROM asked JOIN family_members f USING (canonical_area_id) JOIN stop_areas s ON s.area_id = f.area_id LEFT JOIN profiles p ON p.area_id = f.area_id LEFT JOIN leaving l ON l.area_id = f.area_id
UNION ALL SELECT requested, canonical_area_id, 'way', place, from_area_id, to_area_id, source, minutes, NULL, NULL FROM asked JOIN (SELECT *, CAST(row_number() OVER (PARTITION BY canonical_area_id ORDER BY from_area_id, to_area_id) AS INTEGER) AS place FROM ways) USING (canonical_area_id) WHERE place <= 24""")
def q24_family_graph(f):
    """The family of every area: members with departures of two hours, and ways between them."""
    family = f.family_members.withColumn("is_visible_suggestion", F.col("is_primary_for_search"))
    areas = derive.stop_areas(f.stops)
    away = family.filter("area_id <> primary_area_id")
    way = lambda a, b: away.select("canonical_area_id", F.col(a).alias("from_area_id"), F.col(b).alias("to_area_id"), F.col("access_cost_minutes").alias("access_minutes"), F.lit("CANONICAL_FAMILY_DISTANCE").alias("source"))
    same = family.filter("area_id = primary_area_id").select("canonical_area_id", "area_id", "area_id", F.lit(0), F.lit("SAME_CANONICAL_PRIMARY"))
    ways = way("area_id", "primary_area_id").union(way("primary_area_id", "area_id")).union(same)
    return familyrouting.family_graph(family, ways, areas, profiles(f), family_calls(f), areas, 28800, 36000)


SCENARIOS = [("day", "20240102", 28800, 36000), ("saturday", "20240106", 28800, 36000), ("late", "20240102", 79200, 93600), ("before", "20231231", 0, 93600), ("exceptions", "20240116", 0, 93600)]


@query(f""", scenarios(name, day, lo, hi) AS (VALUES {', '.join(map(str, SCENARIOS))}),
 runs AS (SELECT d.day, s.service_id FROM (SELECT DISTINCT day FROM scenarios) d CROSS JOIN summary s LEFT JOIN calendar_dates x ON x.service_id = s.service_id AND x.date = d.day WHERE CASE WHEN x.exception_type = 1 THEN true WHEN x.exception_type = 2 THEN false ELSE has_calendar = 1 AND d.day BETWEEN start_date AND end_date AND (weekday_mask & (1 << (isodow(strptime(d.day, '%Y%m%d')) - 1))) <> 0 END)
 SELECT c.name, c.day, (SELECT count(*) FROM runs r WHERE r.day = c.day) AS services, count(DISTINCT st.trip_id) AS trips, count(st.trip_id) AS departures, count(DISTINCT m.area_id) AS areas, count(*) FILTER (st.departure_seconds >= 86400) AS overflow,
 (SELECT count(*) FROM calendar_dates x WHERE x.date = c.day AND x.exception_type = 1) AS additions, (SELECT count(*) FROM calendar_dates x WHERE x.date = c.day AND x.exception_type = 2) AS removals FROM scenarios c
 LEFT JOIN runs r ON r.day = c.day LEFT JOIN trips t ON t.service_id = r.service_id LEFT JOIN stop_times st ON st.trip_id = t.trip_id AND st.departure_seconds BETWEEN c.lo AND c.hi LEFT JOIN members m ON m.stop_id = st.stop_id GROUP BY 1, 2, c.lo, c.hi""")
def q26_scenario_audit(f):
    """What runs in each scenario: services, trips, departures, areas, times beyond midnight and exceptions."""
    scenarios = f.spark.createDataFrame(SCENARIOS, "name string, day string, lo int, hi int")
    return journeys.scenario_audit(scenarios, calendar_summary(f), f.calendar_dates, f.trips, f.stop_times, members(f))


@query(NAMED + """, stored AS (SELECT area_id, name, CASE WHEN ascii(right(area_id, 1)) % 3 = 0 THEN name || ' alt' WHEN ascii(right(area_id, 1)) % 3 = 1 THEN name END AS old FROM named) SELECT CASE WHEN old IS NULL THEN 'NEW' WHEN old = name THEN 'SAME' ELSE 'CHANGED' END AS state, count(*) AS n FROM stored WHERE name IS NOT NULL GROUP BY 1""")
def q27_name_refresh(f):
    """What a refresh of stored names would change."""
    last = F.ascii(F.substring("area_id", -1, 1)) % 3
    fresh = named_areas(f).filter("area_name IS NOT NULL").select("area_id", F.col("area_name").alias("name"))
    stored = fresh.filter(last != 2).select("area_id", F.when(last == 0, F.concat("name", F.lit(" alt"))).otherwise(F.col("name")).alias("name"))
    return reports.changes(stored, fresh, "area_id", ["name"]).groupBy("state").agg(F.count("*").alias("n"))
