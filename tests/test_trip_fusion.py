"""Trip fusion by an index of calls against looking at every two trips of a bucket in turn."""

import random

import pytest

from headway.operators import fusion
from headway.operators.fusion import is_part, joined, shared_calls

SCHEMA = f"source_id string, source_priority int, trip_id string, signature string, mode string, line_key string, journey_key string, calls {fusion.CALLS}"


def calls(text, start=0):
    return [(x, start + 3600 * k, start + 3600 * k) for k, x in enumerate(text)]


def trip(source, name, own, key="", line="l"):
    return (source, 0 if source == "A" else 1, name, "s", "3", line, key, own)


def decide(trips):
    """(trip, decision, other, stitched calls) of one bucket, pair after pair."""
    order = sorted(trips, key=lambda t: (t[1], t[0], t[2]))
    pairs = [(a, b) for k, a in enumerate(order) for b in order[k + 1 :] if a[0] != b[0] and len({x[0] for x in a[7]} & {x[0] for x in b[7]}) > 1]
    pairs.sort(key=lambda p: (-max(len(p[0][7]), len(p[1][7])), p[0][2], p[1][2]))
    gone, out = set(), []
    for a, b in pairs:
        long, short = (a, b) if len(a[7]) >= len(b[7]) else (b, a)
        if not {a[2], b[2]} & gone and is_part(short[7], long[7]):
            gone.add(short[2])
            out.append((short[2], "SUBSET_SUPPRESSED", long[2], None))
    for a, b in pairs:
        if not {a[2], b[2]} & gone and a[6].strip() and a[6] == b[6]:
            found = max(joined(a[7], b[7]), joined(b[7], a[7]), key=len)
            if found:
                gone.add(b[2])
                out.append((b[2], "STITCHED", a[2], found))
    for a, b in pairs:
        if not {a[2], b[2]} & gone and shared_calls(a[7], b[7]) >= 2:
            out.append((b[2], "AMBIGUOUS_KEPT", a[2], None))
    return out


def fused(spark, trips, **kw):
    out = fusion.fuse_trips(spark.createDataFrame(trips, SCHEMA), **kw).collect()
    return sorted(((r.trip_id, r.decision, r.other_trip_id, None if r.calls is None else [tuple(x) for x in r.calls]) for r in out), key=str)


CASES = [
    ((trip("A", "a", calls("WXYZ")), trip("B", "b", calls("XY", 3660))), [("b", "SUBSET_SUPPRESSED", "a", 0)]),
    ((trip("A", "a", calls("XY", 3660)), trip("B", "b", calls("WXYZ"))), [("a", "SUBSET_SUPPRESSED", "b", 0)]),
    ((trip("A", "a", calls("ABC"), "k"), trip("B", "b", calls("BCD", 3600), "k")), [("b", "STITCHED", "a", 4)]),
    ((trip("A", "a", calls("BCD", 3600), "k"), trip("B", "b", calls("ABC"), "k")), [("b", "STITCHED", "a", 4)]),
    ((trip("A", "a", calls("ABC")), trip("B", "b", calls("BCD", 3600))), [("b", "AMBIGUOUS_KEPT", "a", 0)]),
    ((trip("A", "a", calls("ABCX")), trip("B", "b", calls("ABCY"))), [("b", "AMBIGUOUS_KEPT", "a", 0)]),
    ((trip("A", "a", calls("AB")), trip("B", "b", calls("AB", 600))), []),
    ((trip("A", "a", calls("ABCD")), trip("A", "b", calls("BC", 3600))), []),
    ((trip("A", "a", calls("ABC")), trip("B", "b", [("B", -1, -1), ("C", -1, 7200)])), [("b", "SUBSET_SUPPRESSED", "a", 0)]),
    ((trip("A", "a", [("B", -1, -1), ("C", -1, -1)]), trip("B", "b", calls("ABC"))), [("a", "SUBSET_SUPPRESSED", "b", 0)]),
    ((trip("A", "a", [("B", None, None), ("C", 7200, None)]), trip("B", "b", calls("ABC"))), [("a", "SUBSET_SUPPRESSED", "b", 0)]),
    # one stop alone is no pair, however often it is called at
    ((trip("A", "a", [("A", 0, 0), ("A", 500, 500)]), trip("B", "b", [("A", 0, 0), ("A", 500, 500), ("A", 900, 900)])), []),
]


def test_worked_by_hand(spark):
    rows, want = [], []
    for n, (trips, found) in enumerate(CASES):
        rows += [(*t[:2], f"{t[2]}{n}", *t[3:5], f"line{n}", *t[6:]) for t in trips]
        want += [(f"{t}{n}", d, f"{o}{n}", k) for t, d, o, k in found]
    assert [(t, d, o, len(x or ())) for t, d, o, x in fused(spark, rows)] == sorted(want, key=str)


def test_large_bucket(spark):
    rows = [trip("A" if k % 2 else "B", f"t{k:04}", calls("ABCD"[k % 2 :], 3600 * (k % 2) + 1000 * (k // 2))) for k in range(1002)]
    assert {d for _, d, *_ in fused(spark, rows)} == {"BUCKET_TOO_LARGE_KEPT"}
    assert fused(spark, rows, bucket=None) == sorted(decide(rows), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_buckets(spark, seed):
    rng = random.Random(seed)
    rows, want = [], []
    for line in range(6):
        own = []
        for k in range(14):
            start, text = rng.choice([0, 3600, 7200]), "ABCDEFABG"
            i = rng.randrange(5)
            stretch = [(x, t + rng.choice([0, 30, 90, 91]), t if rng.random() < 0.9 else -1) for x, t, _ in calls(text, 0)[i : i + rng.randrange(1, 6)]]
            own.append(trip(rng.choice("ABC"), f"{line}t{k:02}", [(x, a if rng.random() < 0.9 else -1, d if d < 0 else d + start % 100) for x, a, d in stretch], rng.choice(["", "k", "j"]), f"line{line}"))
        rows += own
        want += decide(own)
    assert fused(spark, rows) == sorted(want, key=str)
    assert len({d for _, d, *_ in want}) == 3


def test_empty(spark):
    assert fused(spark, []) == []


def test_a_call_counts_once():
    assert shared_calls([("A", 0, 0), ("A", 10, 10)], [("A", 5, 5)]) == 1


def test_trips_are_made_once(spark):
    """The trips' own plan runs once, however often their buckets are looked at."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    kind = "source_id string, source_priority int, trip_id string, signature string, mode string, line_key string, journey_key string, calls array<struct<stop_key:string,arrival:int,departure:int>>"
    rows = [(s, k, f"{s}::{n}", "sig", "3", "l", n, [(x, t, t) for x, t in (("p", 100), ("q", 200), ("r", 300))[: 3 - k]]) for k, s in enumerate("AB") for n in "12"]
    trips = spark.createDataFrame(rows, kind).mapInArrow(seen, kind)
    got = fusion.fuse_trips(trips).select("trip_id", "decision").collect()
    assert sorted(map(tuple, got)) == [("B::1", "SUBSET_SUPPRESSED"), ("B::2", "SUBSET_SUPPRESSED")]
    assert made.value == len(rows)


def test_queries_decide_large_buckets(spark):
    """Trips of a bucket beyond the contract's limit are decided by the queries like any others."""
    from types import SimpleNamespace

    from headway.plans import entities

    n, days = 1200, "monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int"
    feed = SimpleNamespace(
        spark=spark,
        routes=spark.createDataFrame([("R", 3, "S 1", None)], "route_id string, route_type int, route_short_name string, route_long_name string"),
        trips=spark.range(n).selectExpr("concat('T', id) AS trip_id", "'R' AS route_id", "'W' AS service_id"),
        stop_times=spark.range(n).selectExpr("concat('T', id) AS trip_id", "CAST(1000 * id AS int) AS start", "posexplode(array('P', 'Q', 'R', 'S', 'V')) AS (k, stop_id)").selectExpr("trip_id", "k + 1 AS stop_sequence", "stop_id", "start + 150 * k AS arrival_seconds", "start + 150 * k AS departure_seconds"),
        calendar=spark.createDataFrame([("W", *[1] * 7, "20240101", "20240107")], f"service_id string, {days}, start_date string, end_date string"),
        calendar_dates=spark.createDataFrame([], "service_id string, date string, exception_type int"),
    )
    want = []
    for r in entities.two_sources(feed).filter("source_id = 'B'").collect():
        own = f"A::{r.trip_id[3:]}"
        want.append((r.trip_id, "STITCHED" if r["calls"][0].stop_key == "Q" else "SUBSET_SUPPRESSED", own))
    got = sorted((r.trip_id, r.decision, r.other_trip_id) for r in entities.gr19_fused_trips(feed).collect())
    assert got == sorted(want) and len(got) > 600 and len({d for _, d, _ in got}) == 2
    counts = dict(map(tuple, entities.gr23_fusion_counts(feed).collect()))
    assert counts["SUBSET_SUPPRESSED"] + counts["STITCHED"] == len(want)
