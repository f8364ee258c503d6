"""Joins whose keys many rows share: the same rows, in tasks that don't grow with a key."""

import pytest
from pyspark.sql import functions as F

from headway.operators import audits, derive, familyrouting, graph, links

STOPS = "stop_id string, stop_code string, stop_name string, stop_lat double, stop_lon double, parent_station string, location_type int"


@pytest.fixture
def crowded(spark):
    """600 stops of one station at six places, a tenth of them without a place."""
    own = spark.range(600).selectExpr("concat('s', id) AS stop_id", "concat('c', id % 3) AS stop_code", "concat('Gleis ', id % 4) AS stop_name", "CASE WHEN id % 10 <> 0 THEN 51.5 + (id % 3) * 0.003 END AS stop_lat", "7.5 + (id % 2) * 0.0001 AS stop_lon", "'P' AS parent_station", "0 AS location_type")
    station = spark.createDataFrame([("P", None, "Bergau", 51.5, 7.5, None, 1)], STOPS)
    return station.union(own)


def test_trips_sharing_stops(spark):
    """Thousands of trips of one route and service that don't meet aren't compared."""
    lone = spark.range(20000).selectExpr("concat('T', id) AS trip_id", "explode(array(concat('a', id), concat('b', id))) AS stop_id")
    more = [("X", "x"), ("X", "y"), ("X", "z"), ("Y", "z"), ("Y", "x"), ("Y", "x"), ("Z", "z"), ("Z", "z"), ("W", "x"), ("W", "y"), ("W", "z")]
    calls = lone.union(spark.createDataFrame(more, lone.schema))
    trips = calls.select("trip_id").distinct().select("trip_id", F.lit("R").alias("route_id"), F.when(F.col("trip_id") == "W", "S2").otherwise("S1").alias("service_id"))
    assert sorted(map(tuple, derive.trips_sharing_stops(calls, trips).collect())) == [("X", "Y")]


def test_footpaths_of_a_crowded_station(spark, crowded, monkeypatch):
    monkeypatch.setattr(graph, "TASK_PAIRS", 40_000)
    monkeypatch.setattr(graph, "BLOCK_ROWS", 64)
    got = derive.footpaths(crowded).withColumn("part", F.spark_partition_id())
    assert got.select("from_stop_id", "to_stop_id").distinct().count() == got.count() == 600 * 599
    assert max(r["count"] for r in got.groupBy("part").count().collect()) < 600 * 599 / 3
    near = derive.nearby_pairs(crowded, "stop_id", "stop_lat", "stop_lon", 0.005, 1, 50).withColumn("part", F.spark_partition_id())
    a, b = (crowded.filter("stop_lat IS NOT NULL").select(F.col("stop_id").alias(s), F.col("stop_lat").alias(f"{s}_lat")) for s in "ab")
    assert near.select("from_id", "to_id").distinct().count() == near.count() == a.join(b, F.col("a_lat") == F.col("b_lat")).filter("a <> b").count()
    assert max(r["count"] for r in near.groupBy("part").count().collect()) < near.count() / 2


def test_pairs_to_other_points(spark, crowded):
    """Pairs to other points are those of all points together, without the pairs inside either."""
    own, others = crowded.filter("stop_id < 's3'"), crowded.filter("stop_id >= 's3'")
    near = derive.nearby_pairs(own, "stop_id", "stop_lat", "stop_lon", 0.005, 1, 500, others)
    every = derive.nearby_pairs(crowded, "stop_id", "stop_lat", "stop_lon", 0.005, 1, 500).filter("from_id < 's3' AND to_id >= 's3'")
    assert near.count() and sorted(map(tuple, near.collect())) == sorted(map(tuple, every.collect()))


def test_footpaths_counted_by_places(spark, crowded):
    paths, places = derive.footpaths(crowded), derive.footpath_places(crowded)
    assert places.count() <= 64
    by = ["area_id", "distance_meters", "min_transfer_seconds", "is_traversable", "quality"]
    want = sorted(map(str, paths.groupBy(*by).agg(F.count("*").alias("n")).collect()))
    assert sorted(map(str, places.groupBy(*by).agg(F.sum("pairs").alias("n")).collect())) == want
    transfers = spark.createDataFrame([(1, "s1", "s2", 2, 100)], "transfer_id long, from_stop_id string, to_stop_id string, transfer_type int, min_transfer_time int").withColumns({k: F.lit(None).cast("string") for k in ("from_route_id", "to_route_id", "from_trip_id", "to_trip_id", "service_id")})
    edges = derive.transfer_edges(crowded, transfers)
    assert audits.transfer_audit(crowded, transfers, edges, places).first() == audits.transfer_audit(crowded, transfers, edges, paths).first()


def test_links_of_a_shared_code(spark, crowded):
    """A code that many stops of one area share links; one of two areas doesn't, nor does a place of two areas."""
    lone = spark.createDataFrame([("L", "c1", "Gleis 1", 51.503, 7.5001, None, 0), ("M", "m", "Tannau", 51.7, 7.7, None, 0)], STOPS)
    stations = spark.createDataFrame([("1", None, "c0", "x", None, None), ("2", None, "c1", "x", None, None), ("3", None, None, "Gleis 1", 51.503, 7.5001), ("4", None, None, "x", 51.506, 7.5), ("5", None, None, "x", 51.503, 7.5001)], "station_id string, global_id string, code string, name string, lat double, lon double")
    got = sorted(tuple(r) for r in links.station_links(stations, crowded.union(lone)).collect())
    assert got == [("1", "P", "EXACT_STOP_CODE"), ("4", "P", "COORDINATE_UNIQUE")]


def test_rides_of_a_busy_station(spark, monkeypatch):
    """Of a station's rides only those count that none later overtakes; searches and rides are dealt to parts, in steps."""
    monkeypatch.setattr(familyrouting, "TASK_ROWS", 40)
    monkeypatch.setattr(familyrouting, "STEP_MEETINGS", 16)
    calls = [(f"T{k}", area, seq, at, at) for k in range(400) for seq, area, at in ((1, "N", 100 + k % 80), (2, f"S{k % 5}", 100 + k % 80 + 7 * (k % 11)))]
    starts = [(f"H{k}", "N", 100 + k * 3) for k in range(30)]
    rides = spark.createDataFrame(calls, "trip_id string, area_id string, stop_sequence int, arrival_seconds int, departure_seconds int")
    way = graph.written(familyrouting.useful_rides(rides, 100, 500))
    assert way.select("to_area", "leaves").distinct().count() < 200
    got = familyrouting.ridden(spark.createDataFrame(starts, "start string, area_id string, ready int"), way)
    best = {}
    for start, _, ready in starts:
        for k in range(400):
            leaves = 100 + k % 80
            if leaves >= ready:
                at = leaves + 7 * (k % 11)
                best[start, f"S{k % 5}"] = min(best.get((start, f"S{k % 5}"), at), at)
    assert {(r.start, r.area_id): r.at for r in got.collect()} == best


def test_blocks_of_searches_and_rides(spark, monkeypatch):
    """However many searches and rides there are, two blocks of fixed size meet in a task, and arrivals are as in one block; a ride is listed once."""
    calls = [(f"T{k}", area, seq, at, at) for k in range(300) for seq, area, at in ((1, f"N{k % 3}", 100 + 2 * k), (2, f"S{k % 17}", 160 + 2 * k + 5 * (k % 7)), (3, f"N{k % 4}", 400 + 2 * k))]
    rides = spark.createDataFrame(calls, "trip_id string, area_id string, stop_sequence int, arrival_seconds int, departure_seconds int")
    way = graph.written(familyrouting.useful_rides(rides, 100, 900))
    assert way.select("area_id", "to_area", "leaves").distinct().count() == way.count() <= 900
    starts = [(f"H{k}", f"{'NS'[k % 2]}{k % 5}", 100 + k * 7) for k in range(60)]
    edges = spark.createDataFrame(starts, "start string, area_id string, ready int")
    whole = sorted(map(tuple, familyrouting.ridden(edges, way).collect()))
    sizes = []
    real = familyrouting.packed
    monkeypatch.setattr(familyrouting, "packed", lambda df, block, columns: sizes.extend(r["count"] for r in df.groupBy(block.alias("b")).count().collect()) or real(df, block, columns))
    monkeypatch.setattr(familyrouting, "BLOCK_ROWS", 20)
    monkeypatch.setattr(familyrouting, "PACK_ROWS", 7)
    monkeypatch.setattr(familyrouting, "STEP_MEETINGS", 16)
    assert sorted(map(tuple, familyrouting.ridden(edges, way).collect())) == whole and len(whole) > 60
    assert len(sizes) > 10 and max(sizes) < 200


def test_relations_are_made_by_all_cores(spark):
    """All relations of families are dealt to tasks, and neither they nor what their areas are asked for is made again in one."""
    from headway.plans import timetable
    from headway.sources.testfeed import TestFeed

    class Seen(Exception):
        pass

    def look(calls, family, cases):
        got = cases.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
        assert len(got) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in got) * 2 < sum(r["count"] for r in got)
        raise Seen

    real, familyrouting.coverage = familyrouting.coverage, look
    try:
        with pytest.raises(Seen):
            timetable.q22_all_relations(TestFeed(spark, "/root/testdata/sf0.01"))
    finally:
        familyrouting.coverage = real


def test_second_rides_of_a_crowded_second(spark, monkeypatch):
    """Of hundreds of rides that leave in one second few are sent on, and the soonest areas are as among all."""
    calls = [(f"T{k:03}", area, seq, at, at) for k in range(600) for seq, area, at in ((1, "N", 1000 + k % 3), (2, f"S{k % 40}", 1500 + (k * 7) % 211))]
    calls = spark.createDataFrame(calls, "trip_id string, area_id string, stop_sequence int, arrival_seconds int, departure_seconds int")
    asked = spark.createDataFrame([("N", 820, 6000), ("N", 822, 6000)], "via string, a_at int, latest int")
    sent = []
    real = familyrouting.top
    monkeypatch.setattr(familyrouting, "top", lambda rows, key, order, k: sent.append(x := real(rows, key, order, k)) or x)
    got = {(r.a_at, r.second_via, r.b_trip) for r in familyrouting.second_rides(asked, calls, calls).collect()}
    want = set()
    for at in (820, 822):
        first = {}
        for arrives, leaves, trip, area in sorted((1500 + (k * 7) % 211, 1000 + k % 3, f"T{k:03}", f"S{k % 40}") for k in range(600) if 1000 + k % 3 >= at + 180):
            first.setdefault(area, trip)
        want |= {(at, area, trip) for area, trip in list(first.items())[: familyrouting.TWO_SECOND]}
    assert got == want and sent[-1].count() == 3 * familyrouting.TWO_SECOND


def test_trips_of_an_area_are_dealt(spark, monkeypatch):
    """Trips of one area and route are counted in as many tasks as their calls need; calls of one trip there count once."""
    monkeypatch.setattr(derive, "TASK_CALLS", 100)
    calls = spark.range(400).selectExpr("concat('T', id) AS trip_id", "explode(array('a', 'a', 'b')) AS stop_id")
    trips = spark.range(400).selectExpr("concat('T', id) AS trip_id", "concat('R', id % 2) AS route_id")
    members = spark.createDataFrame([("a", "N"), ("b", "N")], "stop_id string, area_id string")
    routes = spark.createDataFrame([("R0", 3, "x", None), ("R1", 3, "y", None)], "route_id string, route_type int, route_short_name string, route_long_name string")
    got = derive.area_routes(calls, members, trips, routes)
    assert sorted((r.area_id, r.route_id, r.stop_time_count, r.trip_count) for r in got.collect()) == [("N", "R0", 600, 200), ("N", "R1", 600, 200)]
    assert "RepartitionByExpression [trip_id" in got._jdf.queryExecution().optimizedPlan().toString()


def test_changes_at_a_busy_station(spark, monkeypatch):
    """Rides with a change are counted, up to the limit a place of change, in parts and steps; second rides are the soonest to each area."""
    monkeypatch.setattr(familyrouting, "TASK_ROWS", 60)
    monkeypatch.setattr(familyrouting, "STEP_MEETINGS", 16)
    calls = [(f"T{k}", area, seq, at, at) for k in range(400) for seq, area, at in ((1, f"N{k % 2}", 1000 + 13 * k), (2, f"S{k % 23}", 1500 + 13 * k + 7 * (k % 11)))]
    calls = spark.createDataFrame(calls, "trip_id string, area_id string, stop_sequence int, arrival_seconds int, departure_seconds int")
    starts = [(f"A{k % 7}", 900, 1200, 6000, f"N{k % 2}", 1000 + 60 * k) for k in range(40)]
    ends = [("S1", 0), ("S2", 240), ("S2", 0)]
    ways = graph.written(familyrouting.onward_rides(calls, calls))
    rides = [tuple(r) for r in ways.collect()]
    assert len(rides) == 400
    want = {}
    for *search, via, at in starts:
        for b, walk in ends:
            last = min(at + familyrouting.ONE_WAIT, search[3] - walk)
            n = sum(r[0] == via and r[1] == b and at + 180 <= r[3] <= last for r in rides)
            key = (*search, b, walk)
            want[key] = want.get(key, 0) + (min(n, familyrouting.ONE_LIMIT) if last > at + 180 else 0)
    frame = spark.createDataFrame(starts, "a string, low int, to_seconds int, latest int, via string, a_at int")
    got = familyrouting.changes_counted(frame, ways, spark.createDataFrame(ends, "b string, walk int"))
    assert {tuple(r)[:6]: r.n for r in got.collect()} == {k: n for k, n in want.items() if n}
    got = familyrouting.second_rides(frame.select("via", "a_at", "latest"), calls, calls).collect()
    for _, _, _, latest, via, at in starts:
        first = {}
        for r in sorted((r for r in rides if r[0] == via and at + 180 <= r[3] <= min(at + familyrouting.TWO_WAIT, latest)), key=lambda r: (r[4], r[3], r[2])):
            first.setdefault(r[1], (r[2], r[3], r[4]))
        soonest = sorted(first.items(), key=lambda x: (x[1][2], x[1][1], x[1][0], x[0]))[: familyrouting.TWO_SECOND]
        assert {(r.second_via, r.b_trip, r.b_leaves, r.b_at) for r in got if (r.via, r.a_at) == (via, at)} == {(area, *x) for area, x in soonest}


def test_transfers_are_made_once(spark):
    """What reads transfers several times reads them written: only gr22's own calls come from the calls' table."""
    from headway.plans import audits as plans, tables
    from headway.sources.testfeed import TestFeed

    feed = TestFeed(spark, "/root/testdata/sf0.001")
    scans = lambda df: sum("Relation [" in x and "l_orderkey" in x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert scans(plans.ways(feed)) == 0
    assert scans(tables.gr22_rewritten_members(feed)) == 1


def test_connections_make_calls_once(spark, monkeypatch):
    """Both kinds of legs of join18 come from calls that are written once; a trip that is listed twice connects twice."""
    from collections import Counter

    from headway.plans import tables
    from headway.sources.testfeed import TestFeed

    feed = TestFeed(spark, "/root/testdata/sf0.001")
    plans = []
    real = graph.written
    monkeypatch.setattr(graph, "written", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df))
    once = Counter(map(tuple, tables.join18_connections(feed).collect()))
    assert sum(any("Relation [" in x and "l_orderkey" in x for x in p.splitlines()) for p in plans) == 1
    lines = [sum("Relation [" in x and "l_orderkey" in x for x in p.splitlines()) for p in plans]
    assert sum(lines) == 1
    trip = next(iter(once))[0]
    feed.trips = feed.trips.union(feed.trips.filter(F.col("trip_id") == trip))
    twice = Counter(map(tuple, tables.join18_connections(feed).collect()))
    assert twice == Counter({k: n * (2 if k[0] == trip else 1) * (2 if k[1] == trip else 1) for k, n in once.items()})
