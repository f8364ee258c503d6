"""Scalar rules and row filters as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import names
from ..sources.testfeed import normal
from .registry import query


def name_key_of(column: str):
    return F.concat(F.lit("name"), F.col(column).cast("string"))


def named_areas(f):
    """Areas of the feed, and the invented names as areas of their own."""
    from ..operators.derive import stop_areas

    return stop_areas(f.stops).select("area_id", "area_name").union(f.names.select(name_key_of("name_id"), "name"))



@query("SELECT stop_id, coalesce(nullif(trim(parent_station), ''), stop_id) AS area_id FROM stops")
def prj01_area_id(f):
    return f.stops.select("stop_id", c.area_id(F.col("parent_station"), F.col("stop_id")).alias("area_id"))


@query("SELECT area_id, stop_id, member_role FROM members")
def prj02_member_role(f):
    from ..operators.derive import stop_area_members

    return stop_area_members(f.stops)


@query("SELECT stop_id, location_type FROM stops WHERE coalesce(location_type, 0) = 0")
def prj03_boarding_stops(f):
    from ..operators.derive import boarding_stops

    return boarding_stops(f.stops).select("stop_id", "location_type")


@query("SELECT stop_id, coalesce(stop_lat BETWEEN -90 AND 90 AND stop_lon BETWEEN -180 AND 180, false) AS valid FROM stops")
def prj04_valid_coordinates(f):
    ok = F.col("stop_lat").between(-90, 90) & F.col("stop_lon").between(-180, 180)
    return f.stops.select("stop_id", F.coalesce(ok, F.lit(False)).alias("valid"))


@query("SELECT route_id, line_label FROM labels")
def prj05_line_label(f):
    return f.routes.select("route_id", c.line_label(F.col("route_short_name"), F.col("route_long_name"), F.col("route_id")).alias("line_label"))


@query("SELECT transfer_id, semantic FROM transfer_kinds")
def prj06_transfer_semantic(f):
    return f.transfers.select("transfer_id", c.transfer_semantic(F.col("transfer_type")).alias("semantic"))


@query("SELECT transfer_id, scope_type FROM transfer_kinds")
def prj07_transfer_scope(f):
    from ..operators.derive import transfer_kinds

    return transfer_kinds(f.transfers).select("transfer_id", "scope_type")


@query("SELECT transfer_id FROM transfer_kinds WHERE scope_type = 'STOP' AND (transfer_type IS NULL OR transfer_type IN (0, 2))")
def prj08_pedestrian_transfers(f):
    from ..operators.derive import transfer_kinds

    return transfer_kinds(f.transfers).filter("pedestrian_usable = 1").select("transfer_id")


@query("""SELECT route_id, CAST(CASE WHEN route_type IS NULL THEN -1 WHEN route_type BETWEEN 100 AND 199 THEN 2 WHEN route_type BETWEEN 200 AND 299 THEN 3 WHEN route_type BETWEEN 300 AND 399 THEN 2
 WHEN route_type BETWEEN 400 AND 699 THEN 1 WHEN route_type BETWEEN 700 AND 799 THEN 3 WHEN route_type BETWEEN 800 AND 899 THEN 11 WHEN route_type BETWEEN 900 AND 999 THEN 0 ELSE route_type END AS INTEGER) AS family FROM routes""")
def prj09_route_family(f):
    return f.routes.select("route_id", c.route_family(F.col("route_type")).alias("family"))


@query("""SELECT route_id, coalesce(route_type = 2 OR route_type BETWEEN 100 AND 109, false) AS train, coalesce(route_type IN (1, 400, 401), false) AS subway,
 coalesce(route_type IN (0, 900, 901), false) AS tram, coalesce(route_type = 3 OR route_type BETWEEN 700 AND 709, false) AS bus FROM routes""")
def prj10_mode_flags(f):
    t = F.col("route_type")
    return f.routes.select("route_id", c.is_train(t).alias("train"), c.is_subway(t).alias("subway"), c.is_tram(t).alias("tram"), c.is_bus(t).alias("bus"))


@query("SELECT route_id, coalesce(route_type IS NULL AND (regexp_matches(upper(trim(line_label)), '^(ICE|IC|EC|ECE|RE|RB)') OR regexp_matches(upper(trim(line_label)), '^S[0-9]')), false) AS rail FROM labels")
def prj11_rail_labels(f):
    from ..operators.derive import route_labels

    return route_labels(f.routes).select("route_id", (F.col("route_type").isNull() & c.is_rail_label(F.col("line_label"))).alias("rail"))


CATALOGUE = """, catalogue AS (SELECT 'S' || k AS line, 'america' AS operator, '008D4F' AS colour, 'FFFFFF' AS ink FROM range(30) t(k) UNION ALL SELECT 'RE' || k, 'middle east', 'EE1C23', '000000' FROM range(30) t(k)),
kept AS (SELECT r.*, nullif(trim(route_color), '') IS NULL AND k.line IS NOT NULL AS fits, colour, ink FROM routes r LEFT JOIN agency a ON a.agency_id = r.agency_id AND trim(a.agency_id) <> ''
  LEFT JOIN catalogue k ON k.line = upper(regexp_replace(coalesce(route_short_name, ''), '\\s', '', 'g')) AND k.operator = lower(a.agency_name))
"""


@query(CATALOGUE + "SELECT route_id, CASE WHEN fits THEN colour ELSE route_color END AS route_color, CASE WHEN fits THEN ink END AS route_text_color FROM kept")
def prj12_route_colours(f):
    from ..operators.tables import enrich_colours

    catalogue = [(f"S {k}", "008D4F", "FFFFFF", "America") for k in range(30)] + [(f"re{k}", "EE1C23", "000000", "Middle-East") for k in range(30)]
    return enrich_colours(f.routes, f.spark.createDataFrame(catalogue, "line_label string, route_color string, route_text_color string, operator string"), f.agency).select("route_id", "route_color", "route_text_color")


@query("SELECT trip_id, CAST(greatest(0, (max(arrival_seconds) - min(departure_seconds)) // 60) AS BIGINT) AS minutes FROM stop_times GROUP BY 1")
def prj15_duration_minutes(f):
    return f.stop_times.groupBy("trip_id").agg(F.greatest(F.lit(0).cast("long"), F.expr("(max(arrival_seconds) - min(departure_seconds)) div 60")).alias("minutes"))


@query("SELECT stop_id, regexp_replace(stop_name, '[^A-Za-z0-9]+', '_', 'g') AS sane FROM stops")
def prj16_sanitised_ids(f):
    return f.stops.select("stop_id", c.sanitised(F.col("stop_name")).alias("sane"))


@query("SELECT 'DE::' || stop_id AS stop_id, 'DE::' || parent_station AS parent_station FROM stops")
def prj17_namespaced_ids(f):
    from ..operators.fusion import namespaced

    return namespaced(f.stops, "DE", ["stop_id", "parent_station"]).select("stop_id", "parent_station")


@query("SELECT 'DE::' || trip_id AS trip_id, 'DE::' || route_id AS route_id, 'DE::' || service_id AS service_id, direction_id FROM trips")
def prj18_namespaced_trips(f):
    from ..operators.fusion import namespaced_member

    return namespaced_member(f.trips, "DE", "trips.txt")


@query("SELECT transfer_id, 'DE::' || from_stop_id AS from_stop_id, 'DE::' || to_stop_id AS to_stop_id, 'DE::' || from_route_id AS from_route_id, 'DE::' || from_trip_id AS from_trip_id, service_id FROM transfers")
def prj18_namespaced_transfers(f):
    from ..operators.fusion import namespaced_member

    return namespaced_member(f.transfers, "DE", "transfers.txt").select("transfer_id", "from_stop_id", "to_stop_id", "from_route_id", "from_trip_id", "service_id")


@query("SELECT trip_id, stop_id, departure_seconds FROM stop_times WHERE departure_seconds BETWEEN 28800 AND 29400")
def prj19_departure_window(f):
    return f.stop_times.filter(F.col("departure_seconds").between(28800, 29400)).select("trip_id", "stop_id", "departure_seconds")


@query(f"SELECT stop_id AS id, stop_name_normalized AS form FROM norm UNION ALL SELECT 'name' || name_id, {normal('folded')} FROM names")
def fn01_normalised_names(f):
    own = f.stops.select(F.col("stop_id").alias("id"), F.col("stop_name").alias("name")).union(f.names.select(name_key_of("name_id"), "name"))
    return own.select("id", c.normalised(F.col("name")).alias("form"))


TIME = "lpad(CAST(departure_seconds // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((departure_seconds // 60) % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(departure_seconds % 60 AS VARCHAR), 2, '0')"


@query("SELECT trip_id, stop_sequence, departure_seconds AS parsed FROM stop_times")
def fn02_parsed_times(f):
    return f.stop_times.select("trip_id", "stop_sequence", c.seconds(c.clock(F.col("departure_seconds"))).alias("parsed"))


@query(f"SELECT trip_id, stop_sequence, {TIME} AS clock FROM stop_times")
def fn03_formatted_times(f):
    return f.stop_times.select("trip_id", "stop_sequence", c.clock(F.col("departure_seconds")).alias("clock"))


@query("SELECT service_id, CAST(strptime(date, '%Y%m%d') AS DATE) AS day FROM calendar_dates")
def fn04_flexible_dates(f):
    both = F.when(F.substring("date", 8, 1).isin("1", "3"), F.concat_ws("-", F.substring("date", 1, 4), F.substring("date", 5, 2), F.substring("date", 7, 2))).otherwise(F.col("date"))
    return f.calendar_dates.select("service_id", c.service_date(both).alias("day"))


@query("SELECT service_id, date, isodow(strptime(date, '%Y%m%d')) - 1 AS weekday FROM calendar_dates")
def fn05_weekday(f):
    return f.calendar_dates.select("service_id", "date", F.weekday(c.service_date(F.col("date"))).cast("long").alias("weekday"))


METRES = "CAST(floor(2e0 * 6371000 * atan2(sqrt({a}), sqrt(1 - {a})) + 0.5e0) AS BIGINT)"
HAV = "(pow(sin(radians(b.{y} - a.{y}) / 2), 2) + cos(radians(a.{y})) * cos(radians(b.{y})) * pow(sin(radians(b.{x} - a.{x}) / 2), 2))"


@query(f"SELECT a.stop_id AS a, b.stop_id AS b, {METRES.format(a=HAV.format(y='stop_lat', x='stop_lon'))} AS distance_meters FROM stops a JOIN stops b ON a.parent_station = b.stop_id WHERE a.stop_lat IS NOT NULL")
def fn06_haversine(f):
    a, b = f.stops.alias("a"), f.stops.alias("b")
    both = a.join(b, F.col("a.parent_station") == F.col("b.stop_id")).filter("a.stop_lat IS NOT NULL")
    return both.select(F.col("a.stop_id").alias("a"), F.col("b.stop_id").alias("b"), c.metres(F.col("a.stop_lat"), F.col("a.stop_lon"), F.col("b.stop_lat"), F.col("b.stop_lon")).alias("distance_meters"))


@query("SELECT stop_id, CAST(floor(stop_lat / 0.01e0) AS BIGINT) AS cy, CAST(floor(stop_lon / 0.01e0) AS BIGINT) AS cx FROM stops")
def fn07_grid_cells(f):
    return f.stops.select("stop_id", c.cell(F.col("stop_lat"), 0.01).alias("cy"), c.cell(F.col("stop_lon"), 0.01).alias("cx"))


@query("SELECT stop_id, contains(' ' || stop_name_normalized || ' ', ' gleis ') AS has_gleis FROM norm")
def fn08_contains_token(f):
    return f.stops.select("stop_id", c.contains_token(c.normalised(F.col("stop_name")), "gleis").alias("has_gleis"))


SYNONYMS = "(VALUES ('hbf', 'hauptbahnhof'), ('bf', 'bahnhof'), ('hauptbahnhof', 'hbf'), ('bahnhof', 'bf'), ('u', 'ubahn'), ('ubahn', 'ubahn'), ('s', 'sbahn'), ('sbahn', 'sbahn'))"
NAMED = f", named AS (SELECT area_id, area_name AS name, area_name AS folded FROM stop_areas UNION ALL SELECT 'name' || name_id, name, folded FROM names)\n"
TOKENS = NAMED + f""", told AS (SELECT s.stop_id, m.area_id, {normal('stop_name')} AS n, 'STOP_NAME' AS source, 'NAME' AS kind FROM stops s JOIN members m USING (stop_id) UNION ALL SELECT NULL, area_id, {normal('folded')}, 'AREA_NAME', 'AREA_NAME' FROM named),
words AS (SELECT stop_id, area_id, source, kind, unnest(string_split(n, ' ')) AS w FROM told WHERE n <> ''),
tokens AS (SELECT DISTINCT * FROM (SELECT stop_id, area_id, n AS token, 'NORMALIZED' AS token_type, source FROM told WHERE n <> '' UNION ALL SELECT stop_id, area_id, w, kind, source FROM words
  UNION ALL SELECT stop_id, area_id, y.token, 'SYNONYM', source FROM words JOIN {SYNONYMS} y(w, token) USING (w)))
"""


@query(TOKENS + "SELECT * FROM tokens")
def fn09_search_tokens(f):
    from ..operators.derive import search_tokens

    return search_tokens(f.stops, named_areas(f))


@query(NAMED + f"""SELECT area_id, contains(' ' || n || ' ', ' hbf ') OR contains(n, 'hauptbahnhof') AS main_station, contains(' ' || n || ' ', ' hbf ') OR contains(' ' || n || ' ', ' bf ') OR contains(n, 'bahnhof') AS station
 FROM (SELECT area_id, {normal('folded')} AS n FROM named)""")
def fn10_name_signals(f):
    from ..operators.derive import name_signs

    main, station = name_signs(c.normalised(F.col("area_name")))
    return named_areas(f).select("area_id", main.alias("main_station"), station.alias("station"))


STATIONS = "'hbf', 'hauptbahnhof', 'bahnhof', 'bf', 'stadtbahnhof'"


def sql_city(n: str) -> str:
    """City before a station word of a search form, without a region."""
    out = n
    for w in ("stadtbahnhof", "hauptbahnhof", "hbf", "bahnhof", "bf", "zob"):
        out = f"regexp_replace({out}, '\\s+{w}.*$', '')"
    out = f"trim(regexp_replace(trim({out}), ' aller.*$', ''))"
    return f"regexp_replace({out}, '^(.+) (bay|main|westf)$', '\\1')"


def sql_region(x: str) -> str:
    return f"CASE WHEN ends_with({x}, ' bodensee') THEN trim(left({x}, length({x}) - 9)) ELSE regexp_replace({x}, '^(.+) (bay|main|westf)$', '\\1') END"


def sql_until_station(words: str) -> str:
    end = f"coalesce(list_position(list_transform({words}, lambda x: x IN ({STATIONS}, 'zob')), true), 0)"
    return f"array_to_string(CASE WHEN {end} = 0 THEN {words} ELSE {words}[1:{end} - 1] END, ' ')"


def sql_has(word: str, n: str = "n") -> str:
    return f"contains(' ' || {n} || ' ', ' {word} ')"


SAYS_STATION = f"({sql_has('hbf')} OR {sql_has('bf')} OR contains(n, 'bahnhof'))"
_PLAIN = [
    ("n", "CANONICAL", 0, "true"), ("replace(replace(n, ' hbf', ' hauptbahnhof'), 'hbf ', 'hauptbahnhof ')", "STATION_SYNONYM", 10, sql_has("hbf")), ("replace(n, 'hauptbahnhof', 'hbf')", "STATION_SYNONYM", 10, "contains(n, 'hauptbahnhof')"),
    ("replace(replace(n, ' bf', ' bahnhof'), 'bf ', 'bahnhof ')", "STATION_SYNONYM", 10, sql_has("bf")), ("replace(n, 'bahnhof', 'bf')", "STATION_SYNONYM", 10, "contains(n, 'bahnhof')"),
    *[(f"replace(n, 'stadtbahnhof', '{w}')", "RAIL_STATION_INTENT", 10, "contains(n, 'stadtbahnhof')") for w in ("bahnhof", "bf")], *[(f"city || ' {w}'", "RAIL_STATION_INTENT", 15, "fits") for w in ("bahnhof", "bf")],
    *[(f"city || ' {w}'", "RAIL_STATION_INTENT", 15, f"fits AND ({sql_has('hbf')} OR contains(n, 'hauptbahnhof'))") for w in ("hbf", "hauptbahnhof")],
    ("regexp_replace(regexp_replace(n, '^(s und u|s u|s|u) ', ''), '^(s und u|s u|s|u)$', '')", "MODE_PREFIX_STRIPPED", 20, "regexp_replace(n, '^(s und u|s u|s|u) ', '') <> n"),
    ("trim(left(n, length(n) - 3))", "STATION_SUFFIX_STRIPPED", 30, "ends_with(n, ' bf')"), ("trim(left(n, length(n) - 8))", "STATION_SUFFIX_STRIPPED", 30, "ends_with(n, ' bahnhof')"),
    ("town || ' ' || n", "CITY_QUALIFIED", 5, "town <> '' AND n <> town AND NOT starts_with(n, town || ' ')"),
]
_BEHIND = [(f"{x} || ' {w}'", test) for x, test in (("far", "true"), ("near", "near <> far AND near <> ''")) for w in ("bahnhof", "bf")] + [(f"{x} || ' {w}'", f"{test} AND w IN ('hbf', 'hauptbahnhof')") for x, test in (("far", "true"), ("near", "near <> far AND near <> ''")) for w in ("hbf", "hauptbahnhof")]
ALIASES = NAMED + f""", base AS (SELECT d.area_id, name, {normal('folded')} AS n, 'AREA_NAME' AS source, 100 AS p, coalesce({normal('x.city')}, '') AS town FROM named d LEFT JOIN (SELECT 'name' || name_id AS area_id, city FROM names) x USING (area_id)
  UNION ALL SELECT area_id, stop_name, {normal('stop_name')}, 'STOP_NAME', 70, '' FROM stops JOIN members USING (stop_id)),
cut AS (SELECT *, {sql_city('n')} AS city, string_split(n, ' ') AS ws FROM base WHERE n <> ''),
known AS (SELECT *, city <> '' AND NOT ({SAYS_STATION.replace('n ||', 'city ||').replace('(n,', '(city,')}) AND {SAYS_STATION} AS fits FROM cut),
behind AS (SELECT *, {sql_region('far')} AS near FROM (SELECT *, {sql_until_station('rest')} AS far FROM (SELECT *, ws[i] AS w, ws[i + 1:] AS rest FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM known WHERE fits)) WHERE w IN ({STATIONS})) WHERE far <> '' AND NOT {sql_has('bahnhof', 'far')} AND NOT {sql_has('bf', 'far')}),
made AS ({' UNION ALL '.join(f"SELECT area_id, source, {t} AS t, '{k}' AS kind, p - {less} AS p, name FROM known WHERE {test}" for t, k, less, test in _PLAIN)} UNION ALL {' UNION ALL '.join(f"SELECT area_id, source, {t}, 'RAIL_STATION_INTENT', p - 20, name FROM behind WHERE {test}" for t, test in _BEHIND)}),
spread AS (SELECT area_id, source, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS t, CASE WHEN kind = 'CANONICAL' THEN regexp_replace(name, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') ELSE trim(regexp_replace(t, '\\s+', ' ', 'g')) END AS alias, kind, p FROM made),
streets AS (SELECT area_id, source, array_to_string(list_transform(string_split(t, ' '), lambda x: CASE WHEN length(x) > 3 AND ends_with(x, 'str') THEN x || 'asse' ELSE x END), ' ') AS t2, t, kind, p FROM spread),
every AS (SELECT area_id, source, t, alias, kind, p FROM spread UNION ALL SELECT area_id, source, t2, t2, kind, p FROM streets WHERE t2 <> t),
aliases AS (SELECT area_id, alias, t AS alias_normalized, kind AS alias_type, source, p AS priority FROM (SELECT *, row_number() OVER (PARTITION BY area_id, t, kind, source ORDER BY p DESC, alias) AS r FROM every WHERE t <> '') WHERE r = 1)
"""


def alias_table(f):
    cities = f.names.select(name_key_of("name_id").alias("area_id"), F.col("city").alias("city_name"))
    return names.aliases(named_areas(f), f.stops, cities)


@query(ALIASES + "SELECT area_id, alias, alias_normalized, alias_type, source, CAST(priority AS INTEGER) AS priority FROM aliases")
def fn11_aliases(f):
    return alias_table(f)


@query(NAMED + f"SELECT area_id, {sql_city('n')} AS city, {sql_region('n')} AS near, {sql_until_station('ws[2:]')} AS behind FROM (SELECT area_id, n, string_split(n, ' ') AS ws FROM (SELECT area_id, {normal('folded')} AS n FROM named))")
def fn12_city_candidates(f):
    rows = named_areas(f).withColumn("n", c.normalised(F.col("area_name")))
    return rows.select("area_id", names.city_candidate(F.col("n")).alias("city"), names.region_stripped(F.col("n")).alias("near"), names.trailing_city(F.split("n", " "), F.lit(2)).alias("behind"))


def sql_clean(x: str) -> str:
    bare = f"regexp_replace(regexp_replace(coalesce({x}, ''), '\\s*\\([^)]*\\)', '', 'g'), '[/,]', ' ', 'g')"
    out = f"trim(regexp_replace({bare}, '\\s+', ' ', 'g'))"
    for a, b in (("Hauptbahnhof", "Hbf"), ("hauptbahnhof", "Hbf"), ("HBF", "Hbf"), ("Bahnhofstr.", "Bahnhofstrasse"), ("Bahnhofstraße", "Bahnhofstrasse")):
        out = f"replace({out}, '{a}', '{b}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def sql_no_mode(x: str) -> str:
    return f"trim(regexp_replace({x}, '(?i)^(s\\+u|s u|s\\+u-bahnhof|s-bahnhof|u-bahnhof|s|u)\\s+', ''))"


def sql_station(n: str) -> str:
    return f"({sql_has('hbf', n)} OR {sql_has('bf', n)} OR contains({n}, 'bahnhof'))"


ENDS = "'hbf', 'hauptbahnhof', 'bahnhof', 'bf', 'zob', 'bus', 'str', 'strasse', 'kaiserstrasse', 'bahnhofstrasse', 'platz', 'kirchenallee', 'steintordamm', 'nord', 'sued', 'sud', 'ost', 'west'"


def city_tables(source: str, column: str, prefix: str) -> str:
    """Tables that end in {prefix}_city (all columns of ``source`` and town): the city in names, step by step."""
    p = prefix
    return f""", {p}_a AS (SELECT *, trim(regexp_replace(coalesce({column}, ''), '\\s*\\([^)]*\\)', '', 'g')) AS _b FROM {source}),
{p}_c AS (SELECT *, strpos(_b, ',') AS _at, {sql_clean("CASE WHEN strpos(_b, ',') > 1 THEN left(_b, strpos(_b, ',') - 1) ELSE '' END")} AS _l, {sql_no_mode(sql_clean("CASE WHEN strpos(_b, ',') > 1 THEN substr(_b, strpos(_b, ',') + 1) ELSE '' END"))} AS _r, string_split({sql_no_mode(sql_clean('_b'))}, ' ') AS _w FROM {p}_a),
{p}_d AS (SELECT *, coalesce(list_position(list_transform(_w, lambda x: {normal('x')} = '' OR {normal('x')} IN ({ENDS}) OR contains({normal('x')}, 'bf')), true), 0) AS _e FROM {p}_c),
{p}_city AS (SELECT * EXCLUDE (_b, _at, _l, _r, _w, _e), trim(CASE WHEN _at > 1 THEN CASE WHEN {sql_station(normal('_l'))} AND _r <> '' THEN _r ELSE _l END
  WHEN len(_w) > 1 AND {sql_station(normal('_w[1]'))} THEN array_to_string(_w[2:], ' ') ELSE array_to_string(CASE WHEN _e = 0 THEN _w ELSE _w[1:_e - 1] END, ' ') END) AS {p}_town FROM {p}_d)
"""


def sql_station_name(shown: str, city: str) -> str:
    """The display form without its city in front."""
    leads = f"trim({city}) <> '' AND lower(left({shown}, length({city}))) = lower({city}) AND (length({shown}) = length({city}) OR regexp_matches(substr({shown}, length({city}) + 1, 1), '[\\s,/\\-.(]'))"
    return f"CASE WHEN {leads} THEN regexp_replace(trim(substr({shown}, length({city}) + 1)), '^\\.\\s*', '') ELSE {shown} END"


def sql_technical(n: str) -> str:
    return "(" + " OR ".join([f"contains({n}, '{x}')" for x in ("kaiserstrasse", "bahnhofstrasse", "kirchenallee", "steintordamm", "zob", "bus")] + [sql_has("str", n), sql_has("strasse", n)]) + ")"


@query(NAMED + f"SELECT area_id, {sql_clean('name')} AS clean FROM named")
def fn13_display_cleaning(f):
    return named_areas(f).select("area_id", names.clean_display(F.col("area_name")).alias("clean"))


@query(NAMED + city_tables("named", "name", "x") + "SELECT area_id, x_town AS city FROM x_city")
def fn14_city_names(f):
    return named_areas(f).select("area_id", names.city_name(F.col("area_name")).alias("city"))


@query(f"SELECT name_id, {sql_station_name(sql_no_mode(sql_clean('name')), 'city')} AS station_name FROM named_stops")
def fn15_station_names(f):
    return f.named_stops.select("name_id", names.station_name(F.col("name"), F.col("city")).alias("station_name"))


@query(NAMED + f"SELECT area_id, CASE WHEN trim(coalesce(name, '')) = '' OR {sql_technical(normal('folded'))} THEN 'TECHNICAL' ELSE 'GOOD' END AS quality FROM named")
def fn16_display_quality(f):
    return named_areas(f).select("area_id", names.display_quality(F.col("area_name")).alias("quality"))


_KIND = "CASE WHEN " + sql_has("hbf") + " OR contains(n, 'hauptbahnhof') THEN 'Hbf' WHEN contains(n, 'ostbahnhof') THEN 'Ostbahnhof' WHEN contains(n, 'westbahnhof') THEN 'Westbahnhof' WHEN contains(n, 'nordbahnhof') THEN 'Nordbahnhof' WHEN contains(n, 'suedbahnhof') OR contains(n, 'sudbahnhof') THEN 'Suedbahnhof' ELSE 'Bahnhof' END"
_STREET = "(" + " OR ".join([f"contains(c, '{x}')" for x in ("bahnhofstr", "kaiserstr", "kirchenallee", "steintordamm", "zob", "bus")] + [sql_has("str", "c"), sql_has("strasse", "c")]) + ")"


@query(f""", own AS (SELECT name_id, name_id % 2 = 0 AS station, CASE WHEN name_id % 5 = 0 THEN city END AS official, trim(coalesce(name, '')) AS name FROM named_stops){city_tables('own', 'name', 'o')},
 shown AS (SELECT *, {sql_clean('name')} AS s FROM o_city){city_tables('shown', 's', 's')}, pair AS (SELECT *, CASE WHEN trim(o_town) <> '' THEN o_town ELSE s_town END AS town, {normal('name')} AS n, {normal('s')} AS c FROM s_city),
 pick AS (SELECT *, CASE WHEN station AND ({sql_technical('c')} OR s = '') THEN CASE WHEN town = '' THEN '' ELSE town || ' ' || {_KIND} END WHEN station AND town <> '' AND ({sql_has('hbf')} OR contains(n, 'hauptbahnhof')) AND NOT {sql_has('hbf', 'c')} THEN town || ' Hbf'
  WHEN station AND {_STREET} THEN CASE WHEN town = '' THEN '' ELSE town || ' ' || {_KIND} END ELSE s END AS k FROM pair),
 final AS (SELECT name_id, official, CASE WHEN trim(k) <> '' THEN {sql_clean("replace(replace(k, '(', '['), ')', ']')")} ELSE s END AS display_name FROM pick){city_tables('final', 'display_name', 'f')},
 named AS (SELECT name_id, display_name, CASE WHEN trim({sql_clean('official')}) <> '' THEN {sql_clean('official')} ELSE f_town END AS city_name FROM f_city)
 SELECT name_id, display_name, city_name, {sql_station_name(sql_no_mode(sql_clean('display_name')), 'city_name')} AS station_name, CASE WHEN city_name = '' THEN 'STATION_ONLY' ELSE 'CITY_STATION' END AS name_order,
 CASE WHEN display_name = '' OR {sql_technical(normal('display_name'))} THEN 'TECHNICAL' ELSE 'GOOD' END AS display_quality FROM named""")
def fn17_harmonised_names(f):
    rows = f.named_stops.select("name_id", "name", (F.col("name_id") % 2 == 0).alias("station"), F.when(F.col("name_id") % 5 == 0, F.col("city")).alias("official"))
    return names.harmonised(rows, "name", "station", official="official").select("name_id", "display_name", "city_name", "station_name", "name_order", "display_quality")


KEYS = f"""array_to_string(list_filter(string_split_regex(regexp_replace(n, '\\b(?:gleis|platform|plattform|quai|quay|perron)\\s*[a-z0-9-]*\\b', ' ', 'g'), ' +'),
 lambda w: w <> '' AND w NOT IN ('bahnhof', 'bf', 'hbf', 'station', 'gare', 'stazione', 'staziun', 'halt', 'haltestelle')), ' ')"""


@query(NAMED + f"SELECT area_id, {KEYS} AS name_key, regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]', '', 'g') AS code_key FROM (SELECT area_id, name, {normal('folded')} AS n FROM named)")
def fn25_station_keys(f):
    from ..operators.fusion import code_key, name_key

    return named_areas(f).select("area_id", name_key(F.col("area_name")).alias("name_key"), code_key(F.col("area_name")).alias("code_key"))


def sql_undistricted(n: str) -> str:
    return f"trim(regexp_replace(regexp_replace({n}, '\\b(krs|kreis|landkreis|kr)\\b.*', '', 'g'), '\\s+', ' ', 'g'))"


@query(NAMED + f"SELECT area_id, list_filter(string_split({sql_undistricted(normal('folded'))}, ' '), lambda x: length(x) >= 3 AND x NOT IN ({ENDS.replace(chr(39) + 'bf' + chr(39) + ', ', '')})) AS words FROM named")
def fn26_meaningful_words(f):
    return named_areas(f).select("area_id", names.meaningful(c.normalised(F.col("area_name"))).alias("words"))


@query("SELECT stop_id, sha256(stop_name) AS name_hash, substr(sha256(stop_id || chr(31) || stop_name), 1, 20) AS short_hash FROM stops")
def fn28_hashes(f):
    return f.stops.select("stop_id", F.sha2("stop_name", 256).alias("name_hash"), F.substring(F.sha2(F.concat_ws("\x1f", "stop_id", "stop_name"), 256), 1, 20).alias("short_hash"))


@query("SELECT stop_id FROM norm WHERE starts_with(stop_name_normalized, 'stadt1')")
def fn30_prefix_scan(f):
    return f.stops.filter(c.normalised(F.col("stop_name")).startswith("stadt1")).select("stop_id")


ORDERED = "[" + ", ".join(f"'{r}'" for r in (
    "CITY_FROM_RESOLVED_CONTEXT", "CITY_CODE_EXPANDED", "CITY_PREFIX_REMOVED", "CITY_QUALIFIER_REMOVED", "MODE_PREFIX_REMOVED", "TECHNICAL_QUALIFIER_REMOVED", "STATION_ABBREVIATION_EXPANDED", "GENERIC_STATION_SUFFIX_REMOVED",
    "STREET_SUFFIX_NORMALIZED", "LOCALITY_COMPOUND_PRESERVED", "STOP_CITY_COMPOSED")) + "]"
_CODES = [("STOP_CITY_COMPOSED", "contains(name, ',')"), ("STATION_ABBREVIATION_EXPANDED", "contains(name, 'Hbf')"), ("STREET_SUFFIX_NORMALIZED", "contains(name, 'str')"), ("CITY_QUALIFIER_REMOVED", "contains(name, '(')")]


@query(NAMED + f""", codes AS (SELECT area_id, name, list_filter([{', '.join(f"CASE WHEN {t} THEN '{k}' END" for k, t in _CODES)}], lambda x: x IS NOT NULL) AS found FROM named),
 written AS (SELECT *, CASE WHEN len(found) = 0 THEN 'NONE' ELSE array_to_string(list_filter({ORDERED}, lambda x: list_contains(found, x)), '|') END AS rules, array_to_string(found, '|') AS loose FROM codes)
 SELECT area_id, rules, loose = '' AS empty, loose = rules OR (len(found) = 1) AS loose_valid, trim(regexp_extract('a=1; rules=' || rules || '; output=x', '(?:^|;\\s*)rules=([^;]+)', 1)) AS told FROM written""")
def fn22_rule_codes(f):
    n = F.col("area_name")
    tests = {"STOP_CITY_COMPOSED": n.contains(","), "STATION_ABBREVIATION_EXPANDED": n.contains("Hbf"), "STREET_SUFFIX_NORMALIZED": n.contains("str"), "CITY_QUALIFIER_REMOVED": n.contains("(")}
    found = F.array_compact(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]))
    rows = named_areas(f).withColumn("found", found).withColumn("rules", names.encode_rules(F.col("found"))).withColumn("loose", F.array_join("found", "|"))
    return rows.select("area_id", "rules", (F.col("loose") == "").alias("empty"), names.rules_valid(F.col("loose")).alias("loose_valid"), names.rules_of(F.concat(F.lit("a=1; rules="), "rules", F.lit("; output=x"))).alias("told"))


FIXED_CODES = "(VALUES ('D', 'duesseldorf'), ('DO', 'dortmund'), ('DU', 'duisburg'), ('E', 'essen'), ('FFM', 'frankfurt am main'), ('MG', 'moenchengladbach'), ('OB', 'oberhausen'), ('SZ', 'salzgitter'), ('AB', 'aschaffenburg'), ('PB', 'paderborn'), ('GD', 'schwaebisch gmuend'), ('FRANKFURT', 'frankfurt am main')) v(code, city)"
PREFIX_TABLES = f""", places AS (SELECT DISTINCT {normal('city')} AS city FROM named_stops WHERE city IS NOT NULL),
codes AS (SELECT code, city FROM {FIXED_CODES} UNION SELECT upper(left(replace(city, ' ', ''), 2)), city FROM places WHERE length(replace(city, ' ', '')) >= 2
  UNION SELECT upper(array_to_string(list_transform(string_split(city, ' '), lambda w: left(w, 1)), '')), city FROM places WHERE contains(city, ' ')),
texts AS (SELECT name_id, {normal('city')} AS city, trim(regexp_replace(coalesce(name, ''), '\\s+', ' ', 'g')) AS t FROM named_stops),
cuts AS (SELECT *, unnest(range(1, least(length(t), 14) + 1)) AS i FROM texts),
heads AS (SELECT *, trim(left(t, i - 1)) AS p, trim(substr(t, i + 1)) AS rest FROM cuts WHERE substr(t, i, 1) = '-' OR (substr(t, i, 1) = ' ' AND i = strpos(t, ' ') AND i > 1)),
fits AS (SELECT h.* FROM heads h JOIN codes k ON k.city = h.city AND k.code = upper(regexp_replace(p, '[^\\p{{L}}]', '', 'g')) WHERE rest <> '' AND ((length(p) <= 10 AND regexp_matches(p, '^[\\p{{Lu}}.-]*\\p{{Lu}}[\\p{{Lu}}.-]*$')) OR k.code = 'FRANKFURT'))
"""


@query(PREFIX_TABLES + "SELECT t.name_id, coalesce(f.rest, t.t) AS stripped_name, coalesce(f.p, '') AS stripped_prefix FROM texts t LEFT JOIN (SELECT DISTINCT name_id, arg_max(rest, i) AS rest, arg_max(p, i) AS p FROM fits GROUP BY name_id) f USING (name_id)")
def fn23_stripped_prefixes(f):
    known = names.prefix_aliases(f.named_stops)
    return names.without_prefix(f.named_stops, known, "name_id", "name", "city").select("name_id", "stripped_name", "stripped_prefix")


@query(f"""SELECT p.prefix, r.r_name AS city, CASE WHEN p.prefix IN ('HEIG', 'UNIL', 'KIT', 'HAWK', 'TU', 'DFB', 'LWL', 'LVR') THEN 'INSTITUTION_NAME' WHEN p.prefix IN ('AST', 'BAB', 'BSAG', 'GVZ', 'KVG', 'OEG', 'RVE', 'RVK', 'SBB', 'SSB', 'ZUP') THEN 'TRANSIT_OR_INFRASTRUCTURE_TERM'
 WHEN p.prefix IN ('AOK', 'ASB', 'AWO', 'BMW', 'BRK', 'DRK', 'EDEKA', 'ERGO', 'JVA', 'REWE', 'SAP', 'VW') THEN 'NAMED_ENTITY' WHEN p.prefix IN ('II', 'III', 'IV', 'VI', 'VII', 'VIII', 'IX') THEN 'SECTION_OR_ZONE_LABEL'
 WHEN length(p.prefix) >= 2 AND regexp_matches(upper(regexp_replace({normal('r.r_name')}, '[^a-z0-9]', '', 'g')), array_to_string(string_split(p.prefix, ''), '.*')) THEN 'LOCALITY_CODE_CANDIDATE' ELSE 'PRESERVED_ACRONYM' END AS class
 FROM (VALUES ('UNIL'), ('TU'), ('ZUP'), ('AST'), ('SAP'), ('VW'), ('II'), ('IX'), ('AF'), ('AM'), ('EU'), ('AC'), ('ME'), ('MEA'), ('XYZ'), ('A')) p(prefix) CROSS JOIN region r""")
def fn24_prefix_classes(f):
    prefixes = f.spark.createDataFrame([(p,) for p in ("UNIL", "TU", "ZUP", "AST", "SAP", "VW", "II", "IX", "AF", "AM", "EU", "AC", "ME", "MEA", "XYZ", "A")], "prefix string")
    both = F.broadcast(prefixes).crossJoin(f.source("region").select(F.col("r_name").alias("city")))
    return both.select("prefix", "city", names.prefix_class(F.col("prefix"), F.col("city")).alias("class"))


def sql_base(x: str) -> str:
    """A search form without station words and what is behind them."""
    out = f"regexp_replace({x}, '\\b(krs|kreis|landkreis|kr)\\b.*', '', 'g')"
    for w in ("bahnhof", "bf", "hauptbahnhof", "hbf"):
        out = f"regexp_replace({out}, '\\b{w}\\b.*', '', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


@query(city_tables("named_stops", "name", "x") + f""", forms AS (SELECT name_id, name_id % 2 = 0 AS rail, {normal('name')} AS n, {normal('x_town')} AS town FROM x_city),
 flags AS (SELECT *, town <> '' AND {sql_undistricted('n')} IN (town, town || ' bahnhof', town || ' bf', town || ' hbf', town || ' hauptbahnhof') AS generic, rail AND (contains(n, 'kaiserstr') OR contains(n, 'bahnhofstr') OR contains(n, 'kirchenallee') OR contains(n, 'steintordamm') OR {sql_has('str')} OR {sql_has('strasse')}) AS technical FROM forms),
 keys AS (SELECT *, {sql_base('town')} AS a, {sql_base('n')} AS b FROM flags) SELECT name_id, generic, technical, CASE WHEN generic OR technical THEN CASE WHEN a <> '' THEN a ELSE b END ELSE '' END AS merge_key FROM keys""")
def fn27_generic_stations(f):
    n, rail = F.col("name"), F.col("name_id") % 2 == 0
    return f.named_stops.select("name_id", names.generic_station(n).alias("generic"), names.technical_station(c.plain(n), rail).alias("technical"), names.merge_key(n, rail).alias("merge_key"))


@query(f"""SELECT name_id, station, station = false AND specific BETWEEN 1 AND 2 AS rail_place, regexp_matches(n, '(^| )(ost|west|nord|sued|sud)bahnhof$') AS directional, n IN ('bahnhof', 'hbf', 'hauptbahnhof', 'ostbahnhof', 'westbahnhof', 'nordbahnhof', 'suedbahnhof', 'sudbahnhof') AS generic
 FROM (SELECT name_id, n, contains(n, 'hbf') OR contains(n, 'bahnhof') OR ends_with(n, ' bf') OR contains(n, 'suedkreuz') AS station, len(list_distinct(list_filter(string_split(n, ' '), lambda w: length(w) >= 2 AND w NOT IN ('hbf', 'hauptbahnhof', 'bf', 'bahnhof', 'u', 'ubahn', 's', 'sbahn')))) AS specific
 FROM (SELECT name_id, {normal('folded')} AS n FROM named_stops))""")
def fn31_query_intents(f):
    from ..operators.journeys import query_intents

    return f.named_stops.select("name_id", *[x.alias(k) for k, x in query_intents(c.normalised(F.col("name"))).items()])


@query("SELECT name_id, CASE WHEN regexp_matches(x, '[\",\r\n]') THEN '\"' || replace(x, '\"', '\"\"') || '\"' ELSE x END AS field FROM (SELECT name_id, coalesce(name || CASE name_id % 3 WHEN 0 THEN '\"x' WHEN 1 THEN chr(10) || 'y' ELSE '' END, '') AS x FROM named_stops)")
def fn32_csv_fields(f):
    from ..sources.gtfs import csv_field

    more = F.when(F.col("name_id") % 3 == 0, '"x').when(F.col("name_id") % 3 == 1, "\ny").otherwise("")
    return f.named_stops.select("name_id", csv_field(F.concat("name", more)).alias("field"))
