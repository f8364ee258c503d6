"""Families in searches: members, access minutes, kinds of rides, causes and earliest arrivals."""

import random

import pytest
from pyspark.sql import functions as F

from headway.operators import familyrouting as fr

FAMILY = "canonical_area_id string, primary_area_id string, area_id string, member_role string, access_cost_minutes int, is_primary_for_routing int, is_primary_for_search int"
CALLS = "trip_id string, area_id string, stop_sequence int, arrival_seconds int, departure_seconds int"
CASES = "start string, target string, from_seconds int, to_seconds int, latest int"


def member(family, area, role="RAIL_PLATFORM", minutes=2, routing=1, search=0):
    return (f"CAN_{family}", family, area, role, minutes, routing, search)


def head(area):
    return member(area, area, "PRIMARY_RAIL", 0, 1, 1)


def test_members_and_limits(spark):
    big = [head("H"), *(member("H", f"m{k:02}", minutes=k) for k in range(1, 10)), *(member("H", f"z{k}", "BUS_FEEDER", k, 0) for k in range(1, 6))]
    asked = spark.createDataFrame([("H",), ("z5",), ("m09",), ("lone",), ("P",), (None,)], "area_id string")
    family = spark.createDataFrame([*big, member("P", "q", minutes=None)], FAMILY)
    got = {}
    for r in fr.station_families(family, asked).orderBy("requested", "place").collect():
        got.setdefault(r.requested, []).append((r.area_id, r.member_role, r.access_cost_minutes, r.routing_place))
    assert set(got) == {"H", "z5", "m09", "lone", "P"}
    assert len(got["H"]) == 12 and [x[0] for x in got["H"] if x[3]] == ["H", *(f"m{k:02}" for k in range(1, 8))]
    # a requested feeder that isn't shown is added, and takes its turn by minutes among those for routing
    assert len(got["z5"]) == 13 and got["z5"][-1] == ("z5", "RAW_STOP_AREA", 0, 2)
    # the ninth routing member is beyond the eight, even if it is the one requested
    assert ("m09", "RAIL_PLATFORM", 9, None) in got["m09"]
    assert got["lone"] == [("lone", "RAW_STOP_AREA", 0, 1)]
    # P is only named as a primary: its family counts, and it is added to it
    assert got["P"] == [("q", "RAIL_PLATFORM", 0, 2), ("P", "RAW_STOP_AREA", 0, 1)]


def calls_of(spark, trips):
    rows = [(name, area, k, t - 10, t) for name, calls in trips.items() for k, (area, t) in enumerate(calls)]
    return spark.createDataFrame(rows, CALLS)


TRIPS = {
    # from the platform A2, four minutes away from A, straight to B
    "direct": [("A2", 1300), ("B", 2000)],
    # to C by way of X, with a wait of three minutes and more
    "to_x": [("A", 1100), ("X", 1500)],
    "from_x": [("X", 1800), ("C", 2400)],
    "too_soon": [("X", 1600), ("C", 1700)],
    # to D with two changes
    "y1": [("A", 1200), ("Y", 1600)],
    "y2": [("Y", 1900), ("Z", 2200)],
    "y3": [("Z", 2500), ("D", 2900)],
}
PLACES = [head("A"), member("A", "A2", minutes=4), head("B"), head("C"), head("D"), head("E")]


def test_kinds_of_rides(spark):
    cases = [("A", t, 1000, 1400, 4000) for t in "BCDE"] + [("A", "B", 1000, 1400, 1985), ("A", "B", 1100, 1400, 4000), ("E", "A", 1000, 1400, 4000), ("A", "B", 1000, 1400, 4000)]
    out = fr.coverage(calls_of(spark, TRIPS), spark.createDataFrame(PLACES, FAMILY), spark.createDataFrame(cases, CASES))
    got = {(r.start, r.target, r.from_seconds, r.latest): (r.direct, r.one_transfer, r.two_transfers, r.classification, r.suspected_cause) for r in out.collect()}
    assert got == {
        ("A", "B", 1000, 4000): (1, 0, 0, "FOUND_DIRECT", "OK"),
        ("A", "C", 1000, 4000): (0, 1, 0, "FOUND_ONE_TRANSFER", "OK"),
        ("A", "D", 1000, 4000): (0, 0, 1, "FOUND_TWO_TRANSFER", "OK"),
        # nothing leaves from E; nothing to E either
        ("A", "E", 1000, 4000): (0, 0, 0, "UNKNOWN", "NO_ACTIVE_DEPARTURES_SELECTED_AREA"),
        ("E", "A", 1000, 4000): (0, 0, 0, "UNKNOWN", "NO_ACTIVE_DEPARTURES_SELECTED_AREA"),
        # the ride arrives at 1990; no other is left by then, and B has no departures
        ("A", "B", 1000, 1985): (0, 0, 0, "UNKNOWN", "NO_ACTIVE_DEPARTURES_SELECTED_AREA"),
        # from 1100 the platform is reached at 1340, after the ride has left
        ("A", "B", 1100, 4000): (0, 0, 0, "UNKNOWN", "NO_ACTIVE_DEPARTURES_SELECTED_AREA"),
    }


def test_no_cases_and_no_calls(spark):
    family = spark.createDataFrame(PLACES, FAMILY)
    assert fr.coverage(calls_of(spark, TRIPS), family, spark.createDataFrame([], CASES)).collect() == []
    out = fr.coverage(spark.createDataFrame([], CALLS), family, spark.createDataFrame([("A", "B", 1, 2, 3)], CASES)).first()
    assert (out.classification, out.start_departs) == ("UNKNOWN", False)


@pytest.mark.parametrize(
    ("facts", "cause"),
    [
        ((True, True, True, "", "", True), "OK"),
        ((True, True, True, "STOP_AREA_NAME_VARIANT", "", False), "FOUND_WITH_NAME_VARIANT"),
        ((True, True, True, "STOP_AREA_NAME_VARIANT", "STOP_AREA_FAMILY_NAME_VARIANT", False), "FOUND_WITH_FAMILY_NAME_VARIANT"),
        ((True, False, True, "STOP_AREA_FAMILY_NAME_VARIANT", "STOP_AREA_TRUE_MISMATCH", False), "FOUND_WITH_STOP_AREA_TRUE_MISMATCH"),
        ((False, True, False, "STOP_AREA_TRUE_MISMATCH", "", False), "NO_ACTIVE_DEPARTURES_SELECTED_AREA"),
        ((False, True, True, "STOP_AREA_TRUE_MISMATCH", "STOP_AREA_TRUE_MISMATCH", False), "START_STOP_AREA_MISMATCH"),
        ((False, True, True, "STOP_AREA_NAME_VARIANT", "STOP_AREA_TRUE_MISMATCH", False), "TARGET_STOP_AREA_MISMATCH"),
        ((False, True, True, "", "STOP_AREA_NAME_VARIANT", True), "STOP_AREA_NAME_VARIANT"),
        ((False, True, True, "", "", True), "STOP_AREA_AMBIGUITY"),
        ((False, True, True, "", "", False), "TRANSFER_DEPTH_OR_SEARCH_WINDOW"),
    ],
)
def test_causes(spark, facts, cause):
    assert spark.range(1).select(fr.suspected_cause(*map(F.lit, facts))).first()[0] == cause


def arrivals_brute(trips, families, starts, departure, latest, changes):
    """Every ride from every place that is reached, without any bound on what is kept."""
    out = {}
    for s in starts:
        edge = {(a, departure + 60 * m) for a, m in families[s]}
        best = {}
        for ride in range(1, changes + 2):
            met = set()
            for area, ready in edge:
                for calls in trips.values():
                    for k, (x, t) in enumerate(calls):
                        if x == area and ready <= t <= latest:
                            met |= {(y, u - 10) for y, u in calls[k + 1 :] if u - 10 <= latest}
            for y, at in met:
                best[y] = min(best.get(y, (at, ride)), (at, ride))
            edge = {(y, at + 180) for y, at in met}
        for t in starts:
            ends = [(best[b][0] + 60 * m, best[b][1]) for b, m in families[t] if b in best and best[b][0] + 60 * m <= latest]
            if s != t and ends:
                out[s, t] = min(ends)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_earliest_arrivals(spark, seed):
    rng = random.Random(seed)
    areas = [f"a{k}" for k in range(12)]
    trips = {}
    for k in range(40):
        t, calls = rng.randrange(1000, 6000), []
        for area in rng.sample(areas, rng.randrange(2, 5)):
            calls.append((area, t))
            t += rng.randrange(60, 700)
        trips[f"t{k}"] = calls
    heads = areas[:6]
    rows = [head(a) for a in heads] + [member(heads[k % 3], areas[6 + k], minutes=k % 4) for k in range(4)]
    families = {h: [(r[2], r[4]) for r in rows if r[1] == h] for h in heads}
    wanted = spark.createDataFrame([(h,) for h in heads], "area_id string")
    out = fr.earliest_arrivals(calls_of(spark, trips), spark.createDataFrame(rows, FAMILY), wanted, wanted, 1000, 7000)
    assert {(r.start, r.target): (r.arrival_seconds, r.rides) for r in out.collect()} == arrivals_brute(trips, families, heads, 1000, 7000, 2)
