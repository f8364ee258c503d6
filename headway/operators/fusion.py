"""Merging feeds: namespaced ids, station identity, trip duplicates, and the merged members."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from . import graph

SOURCE = re.compile("[A-Z][A-Z0-9_]{1,31}")
# --- fixed values of the contract: which columns of which members hold ids of the feed, of stops and of trips ---
ID_COLUMNS = {
    "agency.txt": ["agency_id"], "stops.txt": ["stop_id", "parent_station", "zone_id", "level_id"], "routes.txt": ["route_id", "agency_id", "network_id"], "networks.txt": ["network_id"], "route_networks.txt": ["route_id", "network_id"],
    "trips.txt": ["route_id", "service_id", "block_id", "shape_id"], "stop_times.txt": ["stop_id", "location_group_id", "location_id", "booking_rule_id"], "calendar.txt": ["service_id"], "calendar_dates.txt": ["service_id"],
    "transfers.txt": ["from_stop_id", "to_stop_id", "from_route_id", "to_route_id"], "shapes.txt": ["shape_id"], "pathways.txt": ["pathway_id", "from_stop_id", "to_stop_id"], "levels.txt": ["level_id"],
    "location_groups.txt": ["location_group_id"], "location_group_stops.txt": ["location_group_id", "stop_id"], "booking_rules.txt": ["booking_rule_id"], "areas.txt": ["area_id"], "stop_areas.txt": ["area_id", "stop_id"],
    "fare_attributes.txt": ["fare_id", "agency_id"], "fare_rules.txt": ["fare_id", "route_id", "origin_id", "destination_id", "contains_id"], "attributions.txt": ["attribution_id", "agency_id", "route_id"],
}
STOP_COLUMNS = {
    "stops.txt": ["stop_id", "parent_station"], "stop_times.txt": ["stop_id"], "transfers.txt": ["from_stop_id", "to_stop_id"], "pathways.txt": ["from_stop_id", "to_stop_id"], "location_group_stops.txt": ["stop_id"], "stop_areas.txt": ["stop_id"],
}
TRIP_COLUMNS = ["trip_id", "from_trip_id", "to_trip_id"]
DEFAULT_AGENCY = "__DEFAULT_AGENCY"
#: Words that any station's name may have, and words before a platform.
GENERIC = ["bahnhof", "bf", "hbf", "station", "gare", "stazione", "staziun", "halt", "haltestelle"]
PLATFORM = r"\b(?:gleis|platform|plattform|quai|quay|perron)\s*[a-z0-9-]*\b"
#: Metres within which equal names, and equal codes, are one station.
NAME_METRES, CODE_METRES = 600, 2000
#: Seconds by which the same call may differ between feeds; trips of a bucket beyond which the contract's own tool decides nothing (the queries don't use it).
NEAR_SECONDS, BUCKET = 90, 1000
# --- end of fixed values ---


def namespaced(df: DataFrame, source: str, columns: list[str]) -> DataFrame:
    if not SOURCE.fullmatch(source):
        raise ValueError(f"not a source name: {source}")
    return df.withColumns({k: F.when(c.filled(F.col(k)).isNotNull(), F.concat(F.lit(f"{source}::"), F.col(k))) for k in columns if k in df.columns})


def namespaced_member(df: DataFrame, source: str, member: str) -> DataFrame:
    """A member's ids with their source before them; trips' ids, too."""
    return namespaced(df, source, [*ID_COLUMNS.get(member, []), *TRIP_COLUMNS])


def name_key(name: Column) -> Column:
    """A station's name in search form without platforms and general words."""
    bare = F.regexp_replace(c.normalised(name), PLATFORM, " ")
    return F.array_join(F.filter(F.split(bare, " +"), lambda w: (w != "") & ~w.isin(*GENERIC)), " ")


def code_key(code: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(code, F.lit(""))), "[^a-z0-9]", "")


def anchors(stops: DataFrame) -> DataFrame:
    """stop_key (source and id) and its anchor, the topmost parent in its own source, for stops (source_id, stop_id, parent_station)."""
    own = F.concat("source_id", F.lit("::"), "stop_id")
    parent = F.when(c.filled(F.col("parent_station")).isNotNull(), F.concat("source_id", F.lit("::"), "parent_station"))
    rows = stops.select(own.alias("stop_key"), parent.alias("parent"))
    return graph.roots(rows, "stop_key", "parent").withColumnRenamed("root", "anchor")


def identity_pairs(stations: DataFrame) -> DataFrame:
    """Pairs (a, b, distance_meters) of stations of different sources that are one: equal names near each other, equal codes not too far, or both where a place is unknown.

    Equi-joins on the key and a grid cell: a common name meets only its neighbourhood.
    """
    own = stations.select(F.concat("source_id", F.lit("::"), "stop_id").alias("id"), "source_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"), name_key(F.col("stop_name")).alias("name"), code_key(F.col("stop_code")).alias("code"))
    own = graph.written(own)
    placed = own.filter("lat IS NOT NULL AND lon IS NOT NULL")

    def near(key: str, metres: int, size: float) -> DataFrame:
        rows = placed.filter(F.col(key) != "").select("id", "source_id", "lat", "lon", F.col(key).alias("key"), c.cell(F.col("lat"), size).alias("cy"), c.cell(F.col("lon"), size).alias("cx"))
        steps = F.sequence(F.lit(-1), F.lit(1))
        a = rows.select(*[F.col(x).alias(f"{x}_a") for x in ("id", "source_id", "lat", "lon")], "key", F.explode(F.transform(steps, lambda d: F.col("cy") + d)).alias("cy"), "cx")
        a = a.select(*[x for x in a.columns if x != "cx"], F.explode(F.transform(steps, lambda d: F.col("cx") + d)).alias("cx"))
        b = rows.select(*[F.col(x).alias(f"{x}_b") for x in ("id", "source_id", "lat", "lon")], "key", "cy", "cx")
        d = c.metres(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
        return a.join(b, ["key", "cy", "cx"]).filter("source_id_a < source_id_b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), d.alias("distance_meters")).filter(F.col("distance_meters") <= metres)

    some = own.filter("name <> '' AND code <> ''")
    a, b = (some.select(*[F.col(x).alias(f"{x}_{s}") for x in ("id", "source_id", "lat", "lon")], "name", "code") for s in "ab")
    lost = a.join(b, ["name", "code"]).filter("source_id_a < source_id_b AND (lat_a IS NULL OR lon_a IS NULL OR lat_b IS NULL OR lon_b IS NULL)").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), F.lit(None).cast("long").alias("distance_meters"))
    # cells are wider than the reach up to 70 degrees of latitude
    return near("name", NAME_METRES, 0.02).union(near("code", CODE_METRES, 0.06)).union(lost).distinct()


def identities(stops: DataFrame) -> DataFrame:
    """stop_key, anchor and identity of every stop: C: and a hash of the anchors where sources meet, else S: and the anchor."""
    known = graph.written(anchors(stops))
    keyed = stops.withColumn("stop_key", F.concat("source_id", F.lit("::"), "stop_id"))
    tops = keyed.join(known.select(F.col("anchor").alias("stop_key")).distinct(), "stop_key", "left_semi")
    pairs = graph.written(identity_pairs(tops))
    labels = graph.components(pairs.select("a", "b"))
    own = tops.select("stop_key", "source_id").join(labels.withColumnRenamed("node", "stop_key"), "stop_key", "left").withColumn("label", F.coalesce("label", "stop_key"))
    # all anchors of one station: as many as sources have for it
    groups = own.groupBy("label").agg(F.array_sort(F.collect_list("stop_key")).alias("keys"), F.count_distinct("source_id").alias("sources"))
    hashed = F.substring(F.sha2(F.concat(F.array_join("keys", "\0"), F.lit("\0")), 256), 1, 20)
    named = groups.select("label", F.when(F.col("sources") > 1, F.concat(F.lit("C:"), hashed)).otherwise(F.concat(F.lit("S:"), F.element_at("keys", 1))).alias("identity"), "sources")
    of_anchor = own.join(named, "label").select(F.col("stop_key").alias("anchor"), "identity", "sources")
    return known.join(of_anchor, "anchor").select("stop_key", "anchor", "identity", "sources")


def stop_plan(stops: DataFrame, ids: DataFrame) -> DataFrame:
    """stop_key, output_id and suppressed: stations that sources share keep the id of the first source by priority; the others' rows go."""
    keyed = stops.select(F.concat("source_id", F.lit("::"), "stop_id").alias("stop_key"), "source_id", "stop_id", "source_priority")
    tops = ids.filter("stop_key = anchor").join(keyed, "stop_key")
    first = tops.filter("sources > 1").groupBy("identity").agg(F.min(F.struct("source_priority", "source_id", "stop_id", "stop_key")).alias("x")).select("identity", F.col("x.stop_key").alias("kept"))
    shared = tops.join(first, "identity").select("stop_key", F.col("kept").alias("output_id"))
    out = keyed.select("stop_key").join(shared, "stop_key", "left")
    return out.select("stop_key", F.coalesce("output_id", "stop_key").alias("output_id"), F.coalesce(F.col("output_id") != F.col("stop_key"), F.lit(False)).alias("suppressed"))


def stop_mappings(plan: DataFrame) -> DataFrame:
    """canonical_stop_id, source_id, source_stop_id and match_method of the stations that sources share."""
    of_two = plan.filter("suppressed").select(F.col("output_id").alias("kept")).distinct()
    rows = plan.join(of_two, F.col("output_id") == F.col("kept"))
    return rows.select(F.col("output_id").alias("canonical_stop_id"), F.substring_index("stop_key", "::", 1).alias("source_id"), F.regexp_replace("stop_key", "^[^:]*::", "").alias("source_stop_id"), F.when(F.col("suppressed"), "CROSS_SOURCE_IDENTITY").otherwise("PRIMARY").alias("match_method"))


def duplicate_trips(patterns: DataFrame) -> DataFrame:
    """Of trips with one hash and service signature, the one of the first source stays; other sources' are suppressed."""
    own = Window.partitionBy("exact_hash", "signature").orderBy("source_priority", "trip_id")
    kept = patterns.withColumn("kept_trip_id", F.first("trip_id").over(own))
    if "source_id" in patterns.columns:
        other = F.col("source_id") != F.first("source_id").over(own)
        return kept.withColumn("suppressed", other.cast("int")).withColumn("kept_trip_id", F.when(F.col("suppressed") == 1, F.col("kept_trip_id")).otherwise(F.col("trip_id")))
    return kept.withColumn("suppressed", (F.col("trip_id") != F.col("kept_trip_id")).cast("int"))


def same_call(a: tuple, b: tuple) -> bool:
    """Calls (stop, arrival, departure) at one stop whose known times are near each other."""
    return a[0] == b[0] and all(x < 0 or y < 0 or abs(x - y) <= NEAR_SECONDS for x, y in zip(a[1:], b[1:], strict=True))


def is_part(short: list[tuple], long: list[tuple]) -> bool:
    """Whether a shorter trip's calls are a stretch of a longer one's without a gap."""
    n = len(short)
    return n < len(long) and any(all(map(same_call, short, long[k : k + n])) for k in range(len(long) - n + 1))


def joined(a: list[tuple], b: list[tuple]) -> list[tuple]:
    """Calls of a trip whose end is another's beginning, two calls or more; none otherwise."""
    n = next((n for n in range(min(len(a), len(b)), 1, -1) if all(map(same_call, a[-n:], b[:n]))), 0)
    return a + b[n:] if n else []


def shared_calls(a: list[tuple], b: list[tuple]) -> int:
    """Calls of one trip that have one of their own in the other."""
    free = list(b)
    found = 0
    for x in a:
        k = next((k for k, y in enumerate(free) if same_call(x, y)), None)
        if k is not None:
            del free[k]
            found += 1
    return found


CALLS = "array<struct<stop_key: string, arrival: int, departure: int>>"
BUCKET_KEY = ["signature", "mode", "line_key"]


def timed_pairs(trips: DataFrame) -> DataFrame:
    """a, b: trips of one bucket and two sources with two calls or more that are the same; a comes first by source priority, source and id.

    An index of calls by stop and time: a known departure meets those of its own slot of
    time and the two beside it, an unknown one all of its stop.  Only calls that agree
    become rows, whatever the size of a bucket.
    """
    rank = F.struct("source_priority", "source_id", "trip_id").alias("rank")
    known = lambda t: F.coalesce(F.col(f"call.{t}"), F.lit(-1))
    index = trips.select(*BUCKET_KEY, rank, F.posexplode("calls").alias("k", "call")).select(*BUCKET_KEY, "rank", "k", "call.stop_key", known("arrival").alias("arrival"), known("departure").alias("departure"))
    index = graph.written(index.withColumn("slot", F.when(F.col("departure") >= 0, F.expr(f"departure div {NEAR_SECONDS + 1}"))))
    timed, free = index.filter("slot IS NOT NULL"), index.filter("slot IS NULL")
    side = lambda df, t: df.select(*BUCKET_KEY, "stop_key", "slot", *[F.col(x).alias(f"{x}_{t}") for x in ("rank", "k", "arrival", "departure")])
    at = [*BUCKET_KEY, "stop_key"]
    beside = side(timed, "a").withColumn("slot", F.explode(F.array(*[F.col("slot") + d for d in (-1, 0, 1)])))
    plain = lambda df, t: side(df, t).drop("slot")
    found = beside.join(side(timed, "b"), [*at, "slot"]).drop("slot").union(plain(free, "a").join(plain(index, "b"), at)).union(plain(timed, "a").join(plain(free, "b"), at))
    close = lambda t: (F.col(f"{t}_a") < 0) | (F.col(f"{t}_b") < 0) | (F.abs(F.col(f"{t}_a") - F.col(f"{t}_b")) <= NEAR_SECONDS)
    same = found.filter((F.col("rank_a") < F.col("rank_b")) & (F.col("rank_a.source_id") != F.col("rank_b.source_id")) & close("arrival") & close("departure"))
    agree = same.groupBy(F.col("rank_a.trip_id").alias("a"), F.col("rank_b.trip_id").alias("b")).agg(F.count_distinct("k_a").alias("x"), F.count_distinct("k_b").alias("y"))
    return agree.filter("x > 1 AND y > 1").select("a", "b")


def compared(trips: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per pair its turn (the longest first, then by ids), ``part`` (the trip that is a stretch of the other), ``stitched`` calls if a journey's ends meet, and ``alike`` for two calls in common."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                a, b = ([tuple(-1 if x is None and k else x for k, x in enumerate(call.values())) for call in r[side]] for side in ("a_calls", "b_calls"))
                if len({x[0] for x in a} & {x[0] for x in b}) < 2:
                    continue
                part = r["b"] if is_part(b, a) else r["a"] if is_part(a, b) else None
                stitched: list[tuple] = []
                if r["a_key"].strip() and r["a_key"] == r["b_key"]:
                    forward, back = joined(a, b), joined(b, a)
                    stitched = forward if len(forward) >= len(back) else back
                calls = [dict(zip(("stop_key", "arrival", "departure"), x, strict=True)) for x in stitched] or None
                out.append({"a": r["a"], "b": r["b"], "length": -max(len(a), len(b)), "part": part, "stitched": calls, "alike": shared_calls(a, b) >= 2})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    call = pa.struct([("stop_key", pa.string()), ("arrival", pa.int32()), ("departure", pa.int32())])
    schema = pa.schema([("a", pa.string()), ("b", pa.string()), ("length", pa.int32()), ("part", pa.string()), ("stitched", pa.list_(call)), ("alike", pa.bool_())])
    of = lambda t: trips.select(F.col("trip_id").alias(t), F.coalesce("journey_key", F.lit("")).alias(f"{t}_key"), F.col("calls").cast(CALLS).alias(f"{t}_calls"))
    rows = pairs.join(of("a"), "a").join(of("b"), "b")
    out = rows.mapInArrow(run, f"a string, b string, length int, part string, stitched {CALLS}, alike boolean")
    return out.select("a", "b", F.struct("length", "a", "b").alias("turn"), "part", "stitched", "alike")


def in_turn(pairs: DataFrame) -> DataFrame:
    """Of pairs (turn, goes, stays) those that take effect, if each in turn takes ``goes`` away unless it or ``stays`` is gone.

    Each round takes every pair that no earlier one left may spoil; the first of all that
    are left is always among them.
    """
    columns = ["turn", "goes", "stays"]
    left, out = graph.written(pairs.select(*columns)), pairs.select(*columns).limit(0)
    while not left.isEmpty():
        first = left.groupBy("goes").agg(F.min("turn").alias("first"))
        of = lambda t, name: first.select(F.col("goes").alias(t), F.col("first").alias(name))  # noqa: E731, B023
        ready = left.join(of("goes", "own"), "goes").join(of("stays", "other"), "stays", "left").filter((F.col("turn") == F.col("own")) & (F.col("other").isNull() | (F.col("other") > F.col("turn"))))
        new = graph.written(ready.select(*columns))
        out = out.union(new)
        gone = new.select(F.col("goes").alias("trip"), F.col("turn").alias("at"))
        rest = left.join(gone, (F.col("goes") == F.col("trip")) & (F.col("turn") >= F.col("at")), "left_anti").join(gone, (F.col("stays") == F.col("trip")) & (F.col("turn") >= F.col("at")), "left_anti")
        left = graph.written(rest)
    return out


DECISIONS = f"trip_id string, decision string, other_trip_id string, calls {CALLS}"


def fuse_trips(trips: DataFrame, bucket: int | None = BUCKET) -> DataFrame:
    """Decisions for trips (source_id, source_priority, trip_id, signature, mode, line_key, journey_key, calls) by bucket of signature, mode and line.

    Trips that are a stretch of another are suppressed, then ends of one journey are
    stitched, in order of length and ids, each as far as both trips are still there;
    other pairs with two calls in common are kept and named.  ``other_trip_id`` is the
    trip that stays, ``calls`` the stitched ones.  A bucket with over ``bucket`` trips
    is kept whole, as the contract says; None compares trips of any bucket, as the queries do.  Buckets with
    one source have nothing to decide.
    """
    # read three times
    trips = graph.written(trips)
    sizes = trips.groupBy(*BUCKET_KEY).agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("sources")).filter("sources > 1")
    rows = trips.join(sizes, BUCKET_KEY)
    none = F.lit(None).cast(CALLS)
    large = rows.filter(F.lit(False) if bucket is None else F.col("n") > bucket).select("trip_id", F.lit("BUCKET_TOO_LARGE_KEPT").alias("decision"), F.lit("").alias("other_trip_id"), none.alias("calls"))
    some = graph.written(rows if bucket is None else rows.filter(F.col("n") <= bucket))
    pairs = graph.written(compared(some, timed_pairs(some)))
    kept = F.when(F.col("part") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    parts = in_turn(pairs.filter("part IS NOT NULL").select("turn", F.col("part").alias("goes"), kept.alias("stays")))
    without = lambda df, gone: df.join(gone.select(F.col("goes").alias("a")), "a", "left_anti").join(gone.select(F.col("goes").alias("b")), "b", "left_anti")
    left = without(pairs, parts)
    ends = in_turn(left.filter("stitched IS NOT NULL").select("turn", F.col("b").alias("goes"), F.col("a").alias("stays")))
    stitched = ends.join(pairs.select("turn", "stitched"), "turn")
    out = parts.select(F.col("goes").alias("trip_id"), F.lit("SUBSET_SUPPRESSED").alias("decision"), F.col("stays").alias("other_trip_id"), none.alias("calls"))
    out = out.union(stitched.select("goes", F.lit("STITCHED"), "stays", "stitched"))
    return out.union(without(left, ends).filter("alike").select("b", F.lit("AMBIGUOUS_KEPT"), "a", none)).union(large)


def trip_mappings(trips: DataFrame, duplicates: DataFrame, decisions: DataFrame) -> DataFrame:
    """canonical_trip_id, trip_id and match_method of every trip (namespaced): PRIMARY, or how it was merged into another."""
    exact = duplicates.filter("suppressed = 1").select("trip_id", F.col("kept_trip_id").alias("other"), F.lit("EXACT_DUPLICATE").alias("how"))
    merged = decisions.filter("decision IN ('SUBSET_SUPPRESSED', 'STITCHED')").select("trip_id", F.col("other_trip_id").alias("other"), F.col("decision").alias("how"))
    rows = trips.select("trip_id").join(exact.union(merged), "trip_id", "left")
    return rows.select(F.coalesce("other", "trip_id").alias("canonical_trip_id"), "trip_id", F.coalesce("how", F.lit("PRIMARY")).alias("match_method"))


def fusion_counts(decisions: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Number of decisions of each kind, zero where there is none."""
    kinds = ["EXACT_DUPLICATE", "SUBSET_SUPPRESSED", "STITCHED", "AMBIGUOUS_KEPT"]
    every = decisions.select("decision").union(duplicates.filter("suppressed = 1").select(F.lit("EXACT_DUPLICATE")))
    return decisions.sparkSession.createDataFrame([(k,) for k in kinds], "decision string").join(every.groupBy("decision").agg(F.count("*").alias("n")), "decision", "left").fillna(0)


def rewritten(df: DataFrame, source: str, member: str, plan: DataFrame, trips: DataFrame, stitched: DataFrame | None = None) -> DataFrame:
    """A member of one source with the ids of the merged feed.

    Stops that another source's stand for are re-referenced, and their own rows go; so do
    rows of merged trips, while references to them follow.  ``trips`` maps trip_id to
    canonical_trip_id, both namespaced; ``stitched`` (trip_id, calls) replaces calls.
    """
    stop_columns, ids = STOP_COLUMNS.get(member, []), ID_COLUMNS.get(member, [])
    out = namespaced_member(df, source, member)
    if member in ("agency.txt", "routes.txt") and "agency_id" in out.columns:
        out = out.withColumn("agency_id", F.coalesce("agency_id", F.lit(f"{source}::{DEFAULT_AGENCY}")))
    if member == "stops.txt":
        gone = plan.filter("suppressed").select(F.col("stop_key").alias("stop_id"))
        out = out.join(gone, "stop_id", "left_anti")
    if member in ("trips.txt", "stop_times.txt", "frequencies.txt"):
        merged = trips.filter("trip_id <> canonical_trip_id").select("trip_id")
        out = out.join(merged, "trip_id", "left_anti")
    moved = plan.filter("suppressed").select("stop_key", "output_id")
    for k in (k for k in stop_columns if k in out.columns and not (member == "stops.txt" and k == "stop_id")):
        out = out.join(moved.select(F.col("stop_key").alias(k), F.col("output_id").alias("_to")), k, "left").withColumn(k, F.coalesce("_to", k)).drop("_to")
    for k in (k for k in ("from_trip_id", "to_trip_id") if k in out.columns):
        out = out.join(trips.select(F.col("trip_id").alias(k), F.col("canonical_trip_id").alias("_to")), k, "left").withColumn(k, F.coalesce("_to", k)).drop("_to")
    if stitched is not None and member == "trips.txt" and "shape_id" in out.columns:
        out = out.join(stitched.select("trip_id", F.lit(True).alias("_s")), "trip_id", "left").withColumn("shape_id", F.when(F.col("_s"), F.lit(None).cast("string")).otherwise(F.col("shape_id"))).drop("_s")
    if stitched is not None and member == "stop_times.txt":
        own = out.join(stitched.select("trip_id"), "trip_id", "left_anti")
        calls = stitched.join(out.select("trip_id").distinct(), "trip_id", "left_semi").select("trip_id", F.posexplode("calls").alias("k", "x"))
        fused = calls.select("trip_id", F.col("x.stop_key").alias("stop_id"), (F.col("k") + 1).alias("stop_sequence"), F.col("x.arrival").alias("arrival_seconds"), F.col("x.departure").alias("departure_seconds"))
        out = own.unionByName(fused.select(*[x for x in fused.columns if x in own.columns]), allowMissingColumns=True)
    return out.select(*df.columns)


def merged_member(parts: list[DataFrame], key: list[str] | None = None) -> DataFrame:
    """One member of all sources, with all their columns; of rows with one ``key`` (translations) one stays."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out if key is None else out.dropDuplicates([k for k in key if k in out.columns])
