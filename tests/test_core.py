"""Rules, files, names, places and entity resolution on small fixtures."""

import json
import zipfile
from datetime import date, timedelta
from hashlib import sha256
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from headway.functions import columns as c
from headway.operators import audits, derive, families, fusion, graph, links, names, places, publicnames
from headway.plans import entities
from headway.sources import gtfs, reports

FEED = {
    "stops.txt": "\ufeffstop_id,stop_code,stop_name,stop_lat,stop_lon,parent_station,location_type,extra\nP,,Altenfels Hbf,51.5175,7.4592,,1,x\nA,a1,\"Altenfels \"\"Hbf\"\" Gleis 1\",51.5176,7.4593,P,0,x\nB,a2,Altenfels Hbf Gleis 2,51.5177,7.4595,P,,x\nX,,Seeheim,51.6,7.5,,0,x\n\nY,,Bergau,,,,0\n",
    "agency.txt": "agency_id,agency_name,agency_timezone\n,Erste,Europe/Berlin\nA2,Zweite,Europe/Berlin\n",
    "routes.txt": "route_id,agency_id,route_short_name,route_type\nR1,A2,RE 1,106\nR2,,,3\n",
    "trips.txt": "trip_id,route_id,service_id,direction_id,trip_short_name\nT1,R1,S1,0,11\nT2,R1,S1,0,12\nT3,R2,S2,1,\n",
    "nested/stop_times.txt": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT1,23:50:00,23:51:00,A,1\nT1,24:30:00,25:10:00,X,2\nT2,8:00:00,8:01:00,B,1\nT2,8:30:00,8:31:00,X,2\nT3,9:00:00,9:00:00,X,1\nT3,9:10:00,9:10:00,Y,2\n",
    "calendar.txt": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nS1,1,1,1,1,1,0,0,20260101,20261231\n",
    "calendar_dates.txt": "service_id,date,exception_type\nS1,20260102,2\nS2,20260103,1\n",
    "transfers.txt": "from_stop_id,to_stop_id,transfer_type,min_transfer_time\nA,X,2,300\nX,A,3,\nA,Z,0,\nA,B,0,\n",
}


@pytest.fixture
def feed(spark, tmp_path):
    path = tmp_path / "feed.zip"
    with zipfile.ZipFile(path, "w") as z:
        for name, text in FEED.items():
            z.writestr(name, text)
    return gtfs.read_feed(spark, str(path))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["trip_id", "route_id"]


def test_reading(feed):
    assert rows(feed.stops.filter("stop_id = 'A'"), "stop_name", "location_type") == [('Altenfels "Hbf" Gleis 1', 0)]
    assert rows(feed.stops.filter("stop_id = 'Y'"), "stop_lat", "parent_station") == [(None, None)]
    assert rows(feed.stop_times.filter("trip_id = 'T1'"), "arrival_seconds", "departure_seconds") == [(85800, 85860), (88200, 90600)]
    assert rows(feed.agency, "ordinal", "agency_id", "agency_name") == [(0, None, "Erste"), (1, "A2", "Zweite")] and feed.shapes.columns[0] == "shape_id"
    assert rows(feed.transfers, "transfer_id", "to_stop_id") == [(1, "X"), (2, "A"), (3, "Z"), (4, "B")]
    gtfs.require_unique(feed.trips, ["trip_id"])
    with pytest.raises(ValueError):
        gtfs.require_unique(feed.trips, ["route_id"])


def test_blank_required_value_aborts(spark, tmp_path):
    (tmp_path / "trips.txt").write_text("trip_id,route_id,service_id\nT1,,S\n")
    with pytest.raises(Exception, match="blank route_id"):
        gtfs.read_member(spark, str(tmp_path / "trips.txt"), "trips").collect()


def test_lines_of_members(spark, tmp_path):
    lines = ["stop_id,stop_name,stop_code,stop_lat", 'a,ab"c"d,x,1', 'b,"e, ""f""",,2.5', "c,short", "   ", '"",blank id', 'd,"open, to the end']
    (tmp_path / "x.txt").write_text("\ufeff" + "\r\n".join(lines) + "\r\n\r\n")
    got = gtfs.read_rows(spark, str(tmp_path / "x.txt"), gtfs.headers(str(tmp_path / "x.txt"))).orderBy("_row").drop("_row", "_real").collect()
    want = [("a", "abcd", "x", "1"), ("b", 'e, "f"', "", "2.5"), ("c", "short", None, None), ("   ", None, None, None), ("", "blank id", None, None), ("d", "open, to the end", None, None)]
    assert [tuple(r) for r in got] == want


def test_unknown_stops(feed):
    lost = gtfs.unknown_stops(feed.stop_times, feed.stops.filter("stop_id NOT IN ('X', 'Y')")).first()
    assert (lost.unknown, lost.samples) == (4, ["X", "Y"])


def test_derived_tables(feed):
    """From a ZIP through every derived table, with values worked by hand."""
    members = derive.stop_area_members(feed.stops)
    assert rows(members.filter("area_id = 'P'"), "stop_id", "member_role") == [("A", "STOP"), ("B", "STOP"), ("P", "AREA_ANCHOR")]
    assert rows(derive.footpaths(feed.stops), "from_stop_id", "to_stop_id", "is_traversable", "quality") == [("A", "B", 1, "GOOD"), ("B", "A", 1, "GOOD")]
    edges = rows(derive.transfer_edges(feed.stops, feed.transfers), "transfer_edge_id", "from_area_id", "to_area_id", "min_transfer_seconds", "min_transfer_minutes", "is_traversable", "quality")
    assert edges == [("edge_P_P", "P", "P", 120, 2, 0, "CANDIDATE"), ("edge_gtfs_1", "P", "X", 300, 5, 1, "OK"), ("edge_gtfs_4", "P", "P", 180, 3, 1, "GOOD")]
    rules = rows(derive.transfer_rules(feed.transfers, members), "transfer_rule_id", "transfer_semantic", "scope_type")
    assert rules == [("gtfs_transfer_1", "MINIMUM_TIME", "STOP"), ("gtfs_transfer_2", "PROHIBITED", "STOP"), ("gtfs_transfer_4", "RECOMMENDED", "STOP"), ("same_area_P", "AREA_MEMBERSHIP", "AREA")]
    assert rows(derive.transfer_counts(feed.transfers, members), "observed", "mapped", "unmapped", "usable", "same_area_rules") == [(4, 3, 1, 2, 1)]
    assert rows(derive.active_services(feed.calendar, feed.calendar_dates, "20260105"), "service_id") == [("S1",)]
    assert rows(derive.active_services(feed.calendar, feed.calendar_dates, "20260102"), "service_id") == []
    assert rows(derive.active_services(feed.calendar, feed.calendar_dates, "20260103"), "service_id") == [("S2",)]
    axes = rows(derive.route_axes(feed.stop_times, members, feed.trips), "route_id", "path", "trip_count")
    assert axes == [("R1", "P>X", 2), ("R2", "X>Y", 1)]
    summary = derive.calendar_summary(feed.calendar, feed.calendar_dates, feed.trips, feed.routes, feed.agency)
    assert rows(summary, "service_id", "status", "service_timezone", "weekday_mask") == [("S1", "BASE_WITH_EXCEPTIONS", "Europe/Berlin", 31), ("S2", "EXCEPTIONS_ONLY", "Europe/Berlin", 0)]
    area_route = derive.area_routes(feed.stop_times, members, feed.trips, feed.routes)
    hubs = rows(derive.hub_profiles(feed.stops, area_route, feed.transfers), "area_id", "score", "hub_level", "reference_count")
    # P: 3 stops, 1 route, 1 type, 2 trips, 5 ends of transfers, a main station
    assert hubs == [("P", 6 + 5 + 6 + 0 + 15 + 10 + 20, "MAIN_STATION_CANDIDATE", 5), ("X", 2 + 10 + 12 + 0 + 6, "MEDIUM", 2), ("Y", 2 + 5 + 6, "NONE", 0)]
    profiles = derive.area_profiles(feed.stops, area_route)
    assert rows(profiles, "area_id", "profile_class", "line_labels", "route_types") == [("P", "MAIN_RAIL", "RE 1", "106"), ("X", "RAIL", "R2,RE 1", "3,106"), ("Y", "BUS_ONLY", "R2", "3")]
    patterns = derive.trip_patterns(feed.stop_times, feed.trips, feed.routes, derive.service_signatures(feed.calendar, feed.calendar_dates, "AA"))
    assert rows(patterns, "trip_id", "mode", "line_key", "journey_key", "stop_count") == [("T1", 2, "re 1", "11", 2), ("T2", 2, "re 1", "12", 2), ("T3", 3, "", "", 2)]
    tokens = rows(derive.search_tokens(feed.stops).filter("area_id = 'P' AND source = 'AREA_NAME'"), "token", "token_type")
    assert tokens == [("altenfels", "AREA_NAME"), ("altenfels hbf", "NORMALIZED"), ("hauptbahnhof", "SYNONYM"), ("hbf", "AREA_NAME")]
    part = gtfs.corridor(feed, ["P"])
    assert {k: df.count() for k, df in part.items() if k in ("trips", "stops", "stop_times", "routes")} == {"trips": 2, "stops": 4, "stop_times": 4, "routes": 1}
    audit = audits.transfer_audit(feed.stops, feed.transfers, derive.transfer_edges(feed.stops, feed.transfers), derive.footpaths(feed.stops)).first()
    assert audit["pass"] and audit.transfer_edges == 3 and audit.multi_stop_areas == 1
    assert audits.service_day_model(summary, feed.calendar, feed.calendar_dates, feed.stop_times).first()["pass"]


def test_timezones_of_services(spark):
    agency = spark.createDataFrame([("A", "Europe/Berlin"), ("B", "Europe/Zurich"), ("C", " ")], "agency_id string, agency_timezone string")
    routes = spark.createDataFrame([("ra", "A"), ("rb", "B"), ("rc", "C")], "route_id string, agency_id string")
    trips = spark.createDataFrame([("1", "ra", "one"), ("2", "ra", "two"), ("3", "rb", "two"), ("4", "rc", "none")], "trip_id string, route_id string, service_id string")
    none = spark.createDataFrame([], "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string")
    dates = spark.createDataFrame([], "service_id string, date string, exception_type int")
    assert rows(derive.calendar_summary(none, dates, trips, routes, agency), "service_id", "service_timezone", "status") == [("none", "UNKNOWN", "UNRESOLVED"), ("one", "Europe/Berlin", "UNRESOLVED"), ("two", "MULTIPLE", "UNRESOLVED")]
    assert rows(derive.calendar_summary(none, dates, trips, routes, agency.filter("agency_id <> 'B'")), "service_id", "service_timezone") == [("none", "Europe/Berlin"), ("one", "Europe/Berlin"), ("two", "Europe/Berlin")]


def test_publish_and_zip(feed, tmp_path):
    counts = gtfs.publish({"stops": feed.stops, "trips": feed.trips}, str(tmp_path / "out"))
    other = feed.trips.withColumn("direction_id", F.lit("9"))
    told = []
    for name, df in (("same", feed.trips), ("other", other)):
        gtfs.publish({"stops": feed.stops, "trips": df}, str(tmp_path / name))
        told.append(json.loads((tmp_path / name / "manifest.json").read_text())["identity"])
    assert told[0] == json.loads((tmp_path / "out/manifest.json").read_text())["identity"] != told[1]
    assert counts == {"stops": 5, "trips": 3} and json.loads((tmp_path / "out/manifest.json").read_text())["rows"] == counts
    with pytest.raises(FileExistsError):
        gtfs.publish({}, str(tmp_path / "out"))
    gtfs.write_zip({"trips": feed.trips.orderBy("trip_id").select("trip_id", "route_id")}, str(tmp_path / "x.zip"))
    assert zipfile.ZipFile(tmp_path / "x.zip").read("trips.txt").decode().splitlines()[:2] == ["trip_id,route_id", "T1,R1"]
    quoted = feed.stops.filter("stop_id = 'A'").select("stop_id", "stop_name")
    gtfs.write_member(quoted, str(tmp_path / "quoted.csv"))
    assert (tmp_path / "quoted.csv").read_text() == 'stop_id,stop_name\nA,"Altenfels ""Hbf"" Gleis 1"\n'
    assert json.loads(reports.report_json({"row_counts": audits.row_counts({"trips": feed.trips})}))["row_counts"] == {"trips": 3}
    assert reports.markdown_table(feed.trips.filter("trip_id = 'T1'").select("trip_id", F.lit("a|b").alias("x"))).splitlines()[2] == "| T1 | a\\|b |"
    assert reports.csv_text(quoted).splitlines()[1] == 'A,"Altenfels ""Hbf"" Gleis 1"'


@pytest.mark.parametrize("name, want", [("Mühl  Messe/Ost", "muehl messe ost"), ("Straße & Weg", "strasse und weg"), ("S+U Alt-Birken (Bergau)", "s und u alt birken bergau"), ("ﬁliale Mu\u0308hle", "filiale muehle"), (None, "")])
def test_normalised(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(c.normalised(F.col("n"))).first()[0] == want


PUBLIC = [
    # name, resolved city, stop, city
    ("Bergau Bahnhof", "Bergau", "Bahnhof", "Bergau"), ("Bergau Bf", "Bergau", "Bahnhof", "Bergau"), ("Altenfels Hbf", "Altenfels", "Hauptbahnhof", "Altenfels"), ("Bahnhof, Seeheim", None, "Bahnhof", "Seeheim"), ("Seeheim, Bahnhof", None, "Bahnhof", "Seeheim"),
    ("AL-Marktplatz", "Altenfels", "Marktplatz", "Altenfels"), ("Altenfels Ringstraße", "Altenfels", "Ringstr.", "Altenfels"), ("Markt, Altenfels", "Altenfels", "Markt", "Altenfels"), ("Bahnhof (Bergau)", None, "Bahnhof", "Bergau"),
    ("Flughafen Nord", "Bergau", "Flughafen Nord", ""), ("DO-Westhof", None, "Westhof", "Dortmund"), ("Neudorf Bahnhof", "Bergau", "Bahnhof", "Bergau"), ("Bergau Neudorf Bahnhof", "Bergau", "Neudorf", "Bergau"), ("Altenfels (Süd) Rathaus", "Altenfels Süd", "Rathaus", "Altenfels Süd"),
    ("Rathaus", "Bergau", "Rathaus", "Bergau"), ("Rathaus", None, "Rathaus", ""), ("Waldweg Mitte", "Bergau", "Waldweg Mitte", "Bergau"),
]


def test_public_names(spark):
    given = spark.createDataFrame([(k, n, city) for k, (n, city, _, _) in enumerate(PUBLIC)], "k int, name string, city string")
    aliases = names.prefix_aliases(given)
    out = publicnames.public_names(given, "name", "name", aliases, "city").orderBy("k").collect()
    assert [(r.public_stop_name, r.public_city_name) for r in out] == [(s, c) for _, _, s, c in PUBLIC]
    assert all(r.public_display_name == (f"{r.public_stop_name}, {r.public_city_name}" if r.public_city_name else r.public_stop_name) for r in out)
    rules = {n: r.name_rules for (n, *_), r in zip(PUBLIC, out, strict=True)}
    assert rules["DO-Westhof"] == "CITY_CODE_EXPANDED|CITY_PREFIX_REMOVED|STOP_CITY_COMPOSED" and rules["Bergau Neudorf Bahnhof"].split("|")[2] == "GENERIC_STATION_SUFFIX_REMOVED"
    # what came out has nothing left to strip
    audit = publicnames.name_audit(publicnames.public_names(given, "name", "name", aliases, "city"), aliases, "k").first()
    assert (audit.city_codes, audit.duplicate_city, audit.format_mismatches, audit.invalid_rules) == (0, 0, 0, 0)


def test_unknown_rules_raise(spark):
    with pytest.raises(Exception, match="unknown rules"):
        spark.range(1).select(names.encode_rules(F.array(F.lit("OTHER")))).collect()


def test_places(spark, tmp_path):
    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    shapes = [("1", "Big", "Polygon", [square(7, 51, 1)]), ("2", "Small", "MultiPolygon", [[square(7.4, 51.4, 0.2)], [square(9, 51, 0.1)]]), ("3", "Hole", "Polygon", [square(10, 51, 1), square(10.4, 51.4, 0.2)])]
    data = {"type": "FeatureCollection", "features": [{"properties": {"ags": i, "GEN": n, "bez": "Stadt"}, "geometry": {"type": t, "coordinates": g}} for i, n, t, g in shapes]}
    (tmp_path / "m.json").write_text(json.dumps(data))
    polygons = places.read_geojson(spark, str(tmp_path / "m.json"))
    points = spark.createDataFrame([("a", 51.5, 7.5), ("b", 51.1, 7.1), ("c", 51.05, 9.05), ("d", 51.5, 10.5), ("e", 51.0, 7.0), ("f", None, 7.0), ("g", 40.0, 7.0)], "id string, lat double, lon double")
    assert rows(places.locate(points, polygons, "id", "lat", "lon"), "id", "city_name") == [("a", "Small"), ("b", "Big"), ("c", "Small"), ("e", "Big")]


def test_graph(spark):
    chain = [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(40)] + [("x", "y"), ("y", "z"), ("z", "x"), ("q", "q")]
    got = dict(rows(graph.components(spark.createDataFrame(chain, "a string, b string")), "node", "label"))
    assert all(got[f"n{k:03d}"] == "n000" for k in range(41)) and {got[k] for k in "xyz"} == {"x"}
    deep = [(f"m{k}", f"m{k + 1}") for k in range(30)] + [("m30", None)]
    up = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None), ("d", "e"), ("e", "d"), ("f", " "), ("g", "nobody"), ("h", "d"), ("i", "i"), *deep], "n string, p string")
    got = dict(rows(graph.roots(up, "n", "p"), "n", "root"))
    assert {k: got[k] for k in "abcdefghi"} == {"a": "c", "b": "c", "c": "c", "d": "d", "e": "e", "f": "f", "g": "g", "h": "h", "i": "i"}
    assert {got[f"m{k}"] for k in range(31)} == {"m30"}


def test_families(spark):
    """Worked by hand: 0.0045 degrees of latitude are 500 m."""
    given = [
        # area, name, lat, train, rail, subway, tram, bus only, station, main, score, routes
        ("main", "Bergau Hbf", 51.5000, 1, 1, 0, 0, 0, 1, 1, 900, 5), ("near", "Bergau Bahnhof", 51.5030, 1, 1, 0, 0, 0, 1, 0, 500, 3), ("plain", "Bergau", 51.5180, 0, 1, 0, 0, 0, 0, 0, 300, 2), ("other", "Seeheim Bahnhof", 51.5031, 1, 1, 0, 0, 0, 1, 0, 400, 2),
        ("bus", "Bergau ZOB", 51.5010, 0, 0, 0, 0, 1, 1, 0, 50, 4), ("mute", "Bergau Markt", 51.5011, 0, 0, 0, 0, 1, 0, 0, 20, 2), ("far", "Bergau Nordbus", 51.5100, 0, 0, 0, 0, 1, 1, 0, 20, 1), ("idle", "Bergau Alt", 51.5009, 0, 0, 0, 0, 0, 0, 0, 5, 0),
        ("lost", "Tannau Bahnhof", None, 0, 1, 0, 0, 0, 1, 0, 100, 1), ("lost2", "Tannau", None, 0, 1, 0, 0, 0, 0, 0, 90, 1),
    ]
    areas = spark.createDataFrame([(a, n, lat, None if lat is None else 7.5) for a, n, lat, *_ in given], "area_id string, area_name string, area_lat double, area_lon double")
    profiles = spark.createDataFrame([(g[0], *g[3:10], g[10], g[11], "", "") for g in given], "area_id string, has_train int, has_rail_service int, has_subway int, has_tram int, bus_only int, station_name_signal int, main_station_signal int, search_priority_score long, route_count long, profile_class string, line_labels string")
    family = graph.written(families.members(areas, profiles))
    want = [
        ("bus", "CAN_main", "BUS_FEEDER", 111), ("far", "CAN_far", "PRIMARY_BUS", 0), ("lost", "CAN_lost", "PRIMARY_RAIL", 0), ("lost2", "CAN_lost", "RAIL_PLATFORM", 5000), ("main", "CAN_main", "PRIMARY_RAIL", 0), ("mute", "CAN_mute", "PRIMARY_BUS", 0),
        ("near", "CAN_main", "RAIL_PLATFORM", 334), ("other", "CAN_other", "PRIMARY_RAIL", 0), ("plain", "CAN_main", "RAIL_PLATFORM", 2002),
    ]
    assert rows(family, "area_id", "canonical_area_id", "member_role", "distance_meters") == want
    access = families.with_access(family, profiles)
    assert rows(access.filter("canonical_area_id = 'CAN_main'"), "area_id", "access_cost_minutes", "is_primary_for_routing") == [("bus", 4, 0), ("main", 0, 1), ("near", 6, 1), ("plain", 10, 1)]
    edges = rows(families.family_edges(access).filter("canonical_area_id = 'CAN_lost'"), "from_area_id", "to_area_id", "access_minutes", "quality")
    assert edges == [("lost", "lost", 0, "GOOD"), ("lost", "lost2", 10, "LONG"), ("lost2", "lost", 10, "LONG")]
    cities = areas.select("area_id", F.lit("Bergau").alias("city_name"))
    stops = areas.select(F.concat(F.lit("s"), "area_id").alias("stop_id"), F.col("area_name").alias("stop_name"), F.col("area_id").alias("parent_station"))
    alias = names.aliases(areas, stops)
    named = families.family_names(family, areas, profiles, alias, cities)
    assert rows(named.filter("primary_area_id = 'main'"), "display_name", "city_name", "station_name", "display_quality", "member_count") == [("Bergau Hbf", "Bergau", "Hbf", "GOOD", 4)]
    more = families.family_aliases(named, alias).filter("alias_type = 'CANONICAL_FAMILY' AND area_id = 'main'")
    assert rows(more, "alias", "priority") == [("Bergau Hauptbahnhof", 108), ("Bergau Hbf", 115)]


def test_source_names():
    with pytest.raises(ValueError):
        fusion.namespaced(None, "bad name", [])


def test_rewritten_members(spark):
    plan = spark.createDataFrame([("BB::s1", "AA::x1", True), ("BB::s2", "BB::s2", False), ("AA::x1", "AA::x1", False)], "stop_key string, output_id string, suppressed boolean")
    trips = spark.createDataFrame([("BB::t1", "AA::t9"), ("BB::t2", "BB::t2")], "trip_id string, canonical_trip_id string")
    stops = spark.createDataFrame([("s1", None), ("s2", "s1")], "stop_id string, parent_station string")
    write = lambda df, member, stitched=None: fusion.rewritten(df, "BB", member, plan, trips, stitched)
    assert rows(write(stops, "stops.txt"), "stop_id", "parent_station") == [("BB::s2", "AA::x1")]
    times = spark.createDataFrame([("t1", "s1", 5, 0, 0), ("t2", "s1", 7, 10, 20), ("t2", "s2", 8, 30, 40)], "trip_id string, stop_id string, stop_sequence int, arrival_seconds int, departure_seconds int")
    assert rows(write(times, "stop_times.txt"), "trip_id", "stop_id", "stop_sequence") == [("BB::t2", "AA::x1", 7), ("BB::t2", "BB::s2", 8)]
    stitched = spark.createDataFrame([("BB::t2", [("AA::x1", 1, 2), ("BB::s2", 3, 4), ("AA::z", 5, 6)])], "trip_id string, calls array<struct<stop_key: string, arrival: int, departure: int>>")
    assert rows(write(times, "stop_times.txt", stitched), "stop_id", "stop_sequence", "arrival_seconds") == [("AA::x1", 1, 1), ("AA::z", 3, 5), ("BB::s2", 2, 3)]
    moves = spark.createDataFrame([("s1", "s2", "t1")], "from_stop_id string, to_stop_id string, from_trip_id string")
    assert rows(write(moves, "transfers.txt"), "from_stop_id", "to_stop_id", "from_trip_id") == [("AA::x1", "BB::s2", "AA::t9")]
    agency = spark.createDataFrame([("", "x"), ("1", "y")], "agency_id string, agency_name string")
    assert rows(write(agency, "agency.txt"), "agency_id") == [("BB::1",), ("BB::__DEFAULT_AGENCY",)]
    told = spark.createDataFrame([("a", "b", "c"), ("a", "b", "c")], "table_name string, field_name string, language string")
    assert fusion.merged_member([told, told.limit(1).drop("language")], ["table_name", "field_name", "language"]).count() == 2


def test_station_links(spark):
    stops = spark.createDataFrame([("de:1", "c1", "Bergau Markt", 51.5, 7.5, None), ("s2", "c2", "Seeheim Hbf", 51.6, 7.6, None), ("s3", "dup", "Tannau", 51.7, 7.7, None), ("s4", "dup", "Birkental", 51.8, 7.8, None)], "stop_id string, stop_code string, stop_name string, stop_lat double, stop_lon double, parent_station string")
    own = [("1", "de:1", None, "x", None, None), ("2", None, "c2", "x", None, None), ("3", None, "dup", "x", None, None), ("4", None, None, "Seeheim Bahnhof", 51.6001, 7.6001), ("5", None, None, "other", 51.80005, 7.80005)]
    stations = spark.createDataFrame(own, "station_id string, global_id string, code string, name string, lat double, lon double")
    assert rows(links.station_links(stations, stops), "station_id", "area_id", "method") == [("1", "de:1", "EXACT_GLOBAL_ID"), ("2", "s2", "EXACT_STOP_CODE"), ("4", "s2", "COORDINATE_NAME_CHECKED"), ("5", "s4", "COORDINATE_UNIQUE")]


def test_service_signatures(spark):
    week = "monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int"
    calendar = spark.createDataFrame([(s, *[on] * 7, a, b) for s, on, a, b in (
        ("L1", 1, "20200101", "20261231"), ("L2", 1, "20200101", "20261231"), ("E1", 0, "20240101", "20240131"), ("E2", 0, "20240101", "20240131"), ("E3", 1, "20240131", "20240101"),
        ("W", 1, "20240101", "20240103"), ("N1", 1, "20240101", "20240103"), ("N2", 1, "20240101", "20240104"), ("M", 1, "20200101", "20250623"),
    )], f"service_id string, {week}, start_date string, end_date string")
    dates = spark.createDataFrame([("N2", "20240104", 2), ("W", "20300101", 2), ("R", "20240101", 2), ("L1", "20240101", 2)], "service_id string, date string, exception_type int")
    signature = lambda days: "DATES:" + sha256("".join(f"{d};" for d in days).encode()).hexdigest()
    span = lambda n, d: [d + timedelta(k) for k in range(n)]
    want = {s: f"UNSCOPED:A::{s}" for s in ("L1", "L2", "W")} | {s: f"EMPTY:A::{s}" for s in ("E1", "E2", "E3", "R")}
    want |= {s: signature(span(3, date(2024, 1, 1))) for s in ("N1", "N2")} | {"M": signature(span(2001, date(2020, 1, 1)))}
    found = derive.service_signatures(calendar, dates, "A")
    assert dict(rows(found, "service_id", "signature")) == want
    trips = spark.createDataFrame([(f"t{s}", s, "h", 0) for s in want], "trip_id string, service_id string, exact_hash string, source_priority int")
    assert rows(fusion.duplicate_trips(trips.join(found, "service_id")).filter("suppressed = 1"), "trip_id", "kept_trip_id") == [("tN2", "tN1")]
    odd = spark.createDataFrame([("N1", "20240102", 7)], "service_id string, date string, exception_type int")
    assert dict(rows(derive.service_signatures(calendar, odd, "A"), "service_id", "signature"))["N1"] == signature([date(2024, 1, 1), date(2024, 1, 3)])


def test_fused_trips_of_a_feed(spark):
    """Trips of one line over two routes, against every pair compared."""
    paths = {f"T{k}": ("R1" if k % 2 else "R2" if k < 20 else "R3", "PQRS" + "VWXYZ"[k % 5], 20 * (k // 2)) for k in range(30)}
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    feed = SimpleNamespace(
        routes=table([("R1", 3, "S 1", None), ("R2", 3, None, "S 1"), ("R3", 3, "S 2", None)], "route_id string, route_type int, route_short_name string, route_long_name string"),
        trips=table([(t, r, "W") for t, (r, _, _) in paths.items()], "trip_id string, route_id string, service_id string"),
        stop_times=table([(t, k + 1, x, start + 600 * k, start + 600 * k) for t, (_, text, start) in paths.items() for k, x in enumerate(text)], "trip_id string, stop_sequence int, stop_id string, arrival_seconds int, departure_seconds int"),
        calendar=table([("W", *[1] * 7, "20240101", "20240107")], "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string"),
        calendar_dates=table([], "service_id string, date string, exception_type int"),
    )
    trips = {r.trip_id: r for r in entities.two_sources(feed).collect()}
    like = lambda x, y: x[0] == y[0] and abs(x[1] - y[1]) <= 90 and abs(x[2] - y[2]) <= 90
    shared = lambda x, y: len({c[0] for c in trips[x].calls} & {c[0] for c in trips[y].calls})
    first = lambda t: (trips[t].source_priority, t)
    pairs = [(a, b) for a in trips for b in trips if first(a) < first(b) and trips[a].source_id != trips[b].source_id and trips[a].line_key == trips[b].line_key and shared(a, b) > 1]
    pairs.sort(key=lambda p: (-max(len(trips[t].calls) for t in p), p))
    gone, want = set(), []
    for a, b in pairs:
        long, short = sorted((a, b), key=lambda t: -len(trips[t].calls))
        x, y = trips[long].calls, trips[short].calls
        if not {a, b} & gone and len(y) < len(x) and any(all(map(like, y, x[k:])) for k in range(len(x) - len(y) + 1)):
            gone.add(short)
            want.append((short, "SUBSET_SUPPRESSED", long))
    for a, b in pairs:
        x, y = trips[a].calls, trips[b].calls
        meets = any(all(map(like, p[-n:], q[:n])) for p, q in ((x, y), (y, x)) for n in range(2, min(len(x), len(y)) + 1))
        if not {a, b} & gone and a[3:] == b[3:] and meets:
            gone.add(b)
            want.append((b, "STITCHED", a))
    for a, b in pairs:
        if not {a, b} & gone and sum(any(like(x, y) for y in trips[b].calls) for x in trips[a].calls) >= 2:
            want.append((b, "AMBIGUOUS_KEPT", a))
    got = rows(entities.gr19_fused_trips(feed), "trip_id", "decision", "other_trip_id")
    assert got == sorted(want) and {d for _, d, _ in got} >= {"SUBSET_SUPPRESSED", "STITCHED"}
    assert any(a[3:] != b[3:] for a, _, b in got)


def test_transfer_scope_of_either_end(spark):
    columns = ["transfer_id", "from_route_id", "to_route_id", "from_trip_id", "to_trip_id", "service_id"]
    table = [(1, None, None, None, "t", None), (2, None, "r", None, None, None), (3, None, " ", None, "", None), (4, "r", None, None, "t", "s"), (5, None, None, None, None, "s"), (6, "r", None, None, None, "s")]
    df = spark.createDataFrame(table, "transfer_id int, " + ", ".join(f"{c} string" for c in columns[1:])).withColumn("transfer_type", F.lit(None).cast("int"))
    got = rows(derive.transfer_kinds(df), "transfer_id", "scope_type", "pedestrian_usable")
    assert got == [(1, "TRIP", 0), (2, "ROUTE", 0), (3, "STOP", 1), (4, "TRIP_SERVICE", 0), (5, "SERVICE", 0), (6, "ROUTE", 0)]


def test_names_are_folded_once(spark):
    """A filter on a search form doesn't fold the name again in a worker of its own."""
    rows = spark.createDataFrame([("Ｗｅｉｔｅ Straße",), ("ﬁliale Mühle",), ("  ",), (None,), ("a",)], "name string").select(c.normalised(F.col("name")).alias("n")).filter("n <> ''")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(r.n for r in rows.collect()) == ["a", "filiale muehle", "weite strasse"]
