"""Searches between station families: their members, rides of many cases at once, and earliest arrivals in rounds.

A search starts at every routing member of the start's family, later by the minutes that
it takes to get there, and ends at every one of the target's, earlier by as much.  Calls
are joined by area where a ride is boarded and by trip where it is left, so that only
rides that some search can take are ever built.  Searches that differ only in their
target share what they ride first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import graph
from .journeys import WAIT_SECONDS

# fixed values of the contract: members of a family, those that a search uses, the role of an area without a family
MEMBERS, ROUTING, ALONE = 12, 8, "RAW_STOP_AREA"
# rides of each pair, first legs, and the legs, results and waits (seconds) of rides with one and with two changes
DIRECT_LIMIT, FIRST_LIMIT, ONE_LIMIT, ONE_WAIT = 8, 60, 8, 2700
TWO_FIRST, TWO_SECOND, TWO_LIMIT, TWO_WAIT, TWO_MINUTES = 30, 10, 5, 2100, 60
# ways within a family that its graph lists
EDGES = 24
# --- end of fixed values ---
CASE = ["start", "target", "from_seconds", "to_seconds", "latest"]


def top(rows: DataFrame, key: list[str], order: list, k: int) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")


def station_families(family: DataFrame, requests: DataFrame) -> DataFrame:
    """requested, canonical_area_id, area_id, member_role, access_cost_minutes, place and routing_place of the family of each requested area.

    ``family``: canonical_area_id, primary_area_id, area_id, member_role,
    access_cost_minutes, is_primary_for_routing, is_primary_for_search.  An area's family is
    that which it is a member of, else that which it is the primary of, else itself alone;
    of several the smallest id.  A family shows MEMBERS members at most and the requested
    area besides; ``routing_place`` is null for members that searches don't use.
    """
    asked = requests.select(F.col("area_id").alias("requested")).filter("requested IS NOT NULL").distinct()
    of = lambda area, name: family.groupBy(F.col(area).alias("requested")).agg(F.min("canonical_area_id").alias(name))
    owned = asked.join(of("area_id", "member_of"), "requested", "left").join(of("primary_area_id", "head_of"), "requested", "left").select("requested", F.coalesce("member_of", "head_of").alias("canonical_area_id"))
    order = [F.desc("is_primary_for_routing"), F.desc("is_primary_for_search"), "access_cost_minutes", "member_role", "area_id"]
    minutes = F.greatest(F.coalesce("access_cost_minutes", F.lit(0)), F.lit(0)).cast("int").alias("access_cost_minutes")
    shown = top(family.select("canonical_area_id", "area_id", "member_role", minutes, "is_primary_for_routing", "is_primary_for_search").join(owned.select("canonical_area_id").distinct(), "canonical_area_id"), ["canonical_area_id"], order, MEMBERS)
    columns = ["requested", "canonical_area_id", "area_id", "member_role", "access_cost_minutes", "is_primary_for_routing", "is_primary_for_search"]
    rows = owned.join(shown, "canonical_area_id").select(*columns)
    # the requested area itself, where its family is absent or doesn't show it
    absent = owned.join(rows.filter("area_id = requested").select("requested"), "requested", "left_anti")
    lone = absent.select("requested", F.coalesce("canonical_area_id", "requested").alias("canonical_area_id"), F.col("requested").alias("area_id"), F.lit(ALONE).alias("member_role"), F.lit(0).alias("access_cost_minutes"), F.lit(1).alias("is_primary_for_routing"), F.lit(1).alias("is_primary_for_search"))
    both = rows.withColumn("_added", F.lit(0)).union(lone.withColumn("_added", F.lit(1)))
    own = Window.partitionBy("requested")
    used = (F.col("is_primary_for_routing") == 1) | (F.col("area_id") == F.col("requested"))
    both = both.withColumn("place", F.row_number().over(own.orderBy("_added", *order))).withColumn("_used", used)
    turn = F.row_number().over(own.orderBy(F.desc("_used"), F.desc("is_primary_for_routing"), "access_cost_minutes", "area_id"))
    both = both.withColumn("_turn", turn)
    return both.select(*columns[:5], "place", F.when(F.col("_used") & (F.col("_turn") <= ROUTING), F.col("_turn")).alias("routing_place"))


def active_calls(stop_times: DataFrame, members: DataFrame, trips: DataFrame, active: DataFrame) -> DataFrame:
    """trip_id, area_id, stop_sequence, arrival_seconds and departure_seconds of the calls of active services."""
    runs = trips.join(active, "service_id", "left_semi").select("trip_id")
    return stop_times.join(runs, "trip_id", "left_semi").join(members.select("stop_id", "area_id"), "stop_id").select("trip_id", "area_id", "stop_sequence", "arrival_seconds", "departure_seconds")


def rides(searches: DataFrame, calls: DataFrame, area: str, low: Column, high: Column) -> DataFrame:
    """The rides that leave ``area`` of each search from ``low`` to ``high``: the search's columns and trip, leaves, arrives, to_area, from_sequence, to_sequence.

    Calls are met by area and then by trip; a ride doesn't arrive before it leaves.
    """
    aboard = calls.select(F.col("area_id").alias(area), F.col("trip_id").alias("trip"), F.col("stop_sequence").alias("from_sequence"), F.col("departure_seconds").alias("leaves"))
    off = calls.select(F.col("trip_id").alias("trip"), F.col("area_id").alias("to_area"), F.col("stop_sequence").alias("to_sequence"), F.col("arrival_seconds").alias("arrives"))
    return searches.join(aboard, area).filter(F.col("leaves").between(low, high)).join(off, "trip").filter((F.col("to_sequence") > F.col("from_sequence")) & (F.col("arrives") >= F.col("leaves")))


def first_at_areas(found: DataFrame, key: list[str], area: str, k: int) -> DataFrame:
    """The first ride to each other area, of these the k soonest."""
    order = ["arrives", "leaves", "trip", "to_sequence", "from_sequence"]
    return top(top(found.filter(F.col("to_area") != F.col(area)), [*key, "to_area"], order, 1), key, ["arrives", "leaves", "trip", "to_area"], k)


def member_pairs(cases: DataFrame, routing: DataFrame) -> DataFrame:
    """Each case by pairs of routing members a, b: ``low``, when rides may leave a, and ``until``, when they must be at b."""
    side = lambda name, area: routing.select(F.col("requested").alias(name), F.col("area_id").alias(area), F.col("access_cost_minutes").alias(f"{area}_minutes"))
    out = cases.join(side("start", "a"), "start").join(side("target", "b"), "target")
    low = F.least("to_seconds", F.col("from_seconds") + F.col("a_minutes") * 60)
    return out.withColumns({"low": low, "until": F.col("latest") - F.col("b_minutes") * 60, "b_low": F.least("to_seconds", F.col("from_seconds") + F.col("b_minutes") * 60)}).drop("a_minutes", "b_minutes")


def suspected_cause(found: Column, start_departs: Column, target_departs: Column, start_mismatch: Column, target_mismatch: Column, ambiguous: Column) -> Column:
    """Why a case found nothing, or what is doubtful about what it found; a mismatch is empty where the areas are those that were meant."""
    any_is = lambda kind: (start_mismatch == kind) | (target_mismatch == kind)
    none = (start_mismatch == "") & (target_mismatch == "")
    doubtful = F.when(any_is("STOP_AREA_TRUE_MISMATCH"), "FOUND_WITH_STOP_AREA_TRUE_MISMATCH").when(any_is("STOP_AREA_FAMILY_NAME_VARIANT"), "FOUND_WITH_FAMILY_NAME_VARIANT").otherwise("FOUND_WITH_NAME_VARIANT")
    missed = (
        F.when(~(start_departs & target_departs), "NO_ACTIVE_DEPARTURES_SELECTED_AREA").when(start_mismatch == "STOP_AREA_TRUE_MISMATCH", "START_STOP_AREA_MISMATCH").when(target_mismatch == "STOP_AREA_TRUE_MISMATCH", "TARGET_STOP_AREA_MISMATCH")
        .when(~none, F.when(start_mismatch != "", start_mismatch).otherwise(target_mismatch)).when(ambiguous, "STOP_AREA_AMBIGUITY").otherwise("TRANSFER_DEPTH_OR_SEARCH_WINDOW")
    )
    return F.when(found, F.when(none, "OK").otherwise(doubtful)).otherwise(missed)


def dealt(left: DataFrame, right: DataFrame, meetings: int, sizes: tuple[int, int], by_left: str, by_right: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_s`` and ``_t``: left rows are dealt by ``by_left``, right ones by ``by_right``, and each part of one side meets each of the other.

    Their numbers follow from the meetings and the sizes, so that few rows are sent twice
    and no task's work grows with the input.
    """
    parts = max(1, -(-meetings // TASK_MEETINGS), -(-sum(sizes) // TASK_ROWS))
    by_start = min(parts, max(1, round((parts * sizes[0] / max(1, sizes[1])) ** 0.5)))
    by_area = -(-parts // by_start)
    of = lambda x, n: F.pmod(F.xxhash64(x), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return left.select("*", of(by_left, by_start).alias("_s")).select("*", every(by_area).alias("_t")), right.select("*", of(by_right, by_area).alias("_t")).select("*", every(by_start).alias("_s"))


def onward_rides(aboard: DataFrame, calls: DataFrame, goals: DataFrame | None = None) -> DataFrame:
    """via, to_area, trip, leaves, arrives, from_sequence and to_sequence of the rides that begin with a call of ``aboard`` and end at another area, one of ``goals`` (to_area) where these are given."""
    off = calls.select(F.col("trip_id").alias("trip"), F.col("area_id").alias("to_area"), F.col("stop_sequence").alias("to_sequence"), F.col("arrival_seconds").alias("arrives"))
    off = off if goals is None else off.join(F.broadcast(goals), "to_area", "left_semi")
    on = aboard.select(F.col("area_id").alias("via"), F.col("trip_id").alias("trip"), F.col("stop_sequence").alias("from_sequence"), F.col("departure_seconds").alias("leaves"))
    rows = on.join(off, "trip").filter((F.col("to_sequence") > F.col("from_sequence")) & (F.col("arrives") >= F.col("leaves")) & (F.col("via") != F.col("to_area")))
    return rows.select("via", "to_area", "trip", "leaves", "arrives", "from_sequence", "to_sequence")


def changes_counted(starts: DataFrame, ways: DataFrame, ends: DataFrame) -> DataFrame:
    """a, low, to_seconds, latest, b, walk and n: rides with one change of each search to each end (b, walk seconds from there), ONE_LIMIT a place of change at most.

    ``starts``: a, low, to_seconds, latest, via, a_at; ``ways``: via, to_area, leaves.
    Rides in a span of time are counted by their places in order, and none is made a row.
    """
    step, wait, longest, most = STEP_MEETINGS, WAIT_SECONDS, ONE_WAIT, ONE_LIMIT
    key = ["a", "low", "to_seconds", "latest"]

    # sent by value, as executors needn't have this package
    def count(starts: pd.DataFrame, ways: pd.DataFrame) -> pd.DataFrame:
        if starts.empty or ways.empty:
            return pd.DataFrame(columns=[*key, "b", "walk", "n"])
        own, searches = pd.factorize(pd.MultiIndex.from_frame(starts[key]))
        vias, _ = pd.factorize(pd.concat([starts["via"], ways["via"]]))
        goal, goals = pd.factorize(pd.MultiIndex.from_frame(ways[["b", "walk"]]))
        ready, latest = starts["a_at"].to_numpy("int64"), starts["latest"].to_numpy("int64")
        # rides in order of via, end and time; a pair of via and end is a stretch of them
        way = vias[len(starts) :].astype("int64") * len(goals) + goal
        leaves = ways["leaves"].to_numpy("int64")
        order = np.lexsort((leaves, way))
        way, leaves = way[order], leaves[order]
        pairs, at = np.unique(way, return_inverse=True)
        width = max(int(leaves.max(initial=0)), int((ready + longest).max(initial=0)), int(latest.max(initial=0))) + 2
        times = at.astype("int64") * width + leaves
        via_of, goal_of = pairs // len(goals), pairs % len(goals)
        walk = np.array([w for _, w in goals], "int64")
        first = np.searchsorted(via_of, vias[: len(starts)], "left")
        n = np.searchsorted(via_of, vias[: len(starts)], "right") - first
        ends = np.cumsum(n)
        total = np.zeros(len(searches) * len(goals), "int64")
        i = 0
        while i < len(n):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] - n[i] + step, "right")))
            each = n[i:j]
            row = np.repeat(np.arange(i, j), each)
            pair = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each) + first[row]
            end = goal_of[pair]
            low = ready[row] + wait
            high = np.minimum(ready[row] + longest, latest[row] - walk[end])
            good = high > low
            row, pair, end, low, high = row[good], pair[good], end[good], low[good], high[good]
            base = pair.astype("int64") * width
            hits = np.searchsorted(times, base + high, "right") - np.searchsorted(times, base + low, "left")
            np.add.at(total, own[row].astype("int64") * len(goals) + end, np.minimum(hits, most))
            i = j
        found = np.flatnonzero(total)
        who, where = (x.to_frame(index=False).take(k).reset_index(drop=True) for x, k in ((searches, found // len(goals)), (goals, found % len(goals))))
        out = pd.concat([who, where, pd.Series(total[found])], axis=1)
        out.columns = [*key, "b", "walk", "n"]
        return out

    starts = graph.written(starts)
    rides = ways.withColumnRenamed("to_area", "b").join(F.broadcast(ends), "b").select("via", "b", "walk", "leaves")
    sizes = starts.groupBy("via").agg(F.count("*").alias("l")).join(rides.groupBy("via").agg(F.count_distinct("b", "walk").alias("r"), F.count("*").alias("rows")), "via").agg(F.sum(F.col("l") * F.col("r")), F.sum("l"), F.sum("rows")).first()
    meetings, left, right = (x or 0 for x in sizes)
    one, other = dealt(starts, rides.join(starts.select("via").distinct(), "via", "left_semi"), meetings, (left, right), "a", "b")
    return one.groupBy("_s", "_t").cogroup(other.groupBy("_s", "_t")).applyInPandas(count, "a string, low int, to_seconds int, latest int, b string, walk int, n long")


def second_rides(searches: DataFrame, aboard: DataFrame, calls: DataFrame) -> DataFrame:
    """via, a_at, latest, b_trip, b_leaves, b_at and second_via: of each search (via, a_at, latest) the TWO_SECOND other areas that are reached soonest, each by its first ride.

    Of the rides that leave a via in one second only the soonest to TWO_SECOND areas can
    count, so a via's rides have a bound.  Searches and rides meet by via and a span of time,
    and rides are walked through in order of arrival until enough areas are found.
    """
    wait, longest, most, width = WAIT_SECONDS, TWO_WAIT, TWO_SECOND, SECOND_SPAN

    # sent by value, as executors needn't have this package
    def walk(searches: pd.DataFrame, rides: pd.DataFrame) -> pd.DataFrame:
        rides = rides.sort_values(["arrives", "leaves", "trip", "to_sequence", "from_sequence"])
        leaves, arrives = rides["leaves"].to_numpy(), rides["arrives"].to_numpy()
        areas, trips = rides["to_area"].to_numpy(), rides["trip"].to_numpy()
        out = []
        for via, at, latest in zip(searches["via"], searches["a_at"], searches["latest"], strict=True):
            seen = {}
            low, high = at + wait, min(at + longest, latest)
            k = int(np.searchsorted(arrives, low, "left"))
            while k < len(arrives) and len(seen) < most:
                for x in k + np.flatnonzero((leaves[k : k + 256] >= low) & (leaves[k : k + 256] <= high)):
                    if areas[x] not in seen:
                        seen[areas[x]] = x
                        if len(seen) == most:
                            break
                k += 256
            out += [(via, at, latest, trips[x], leaves[x], arrives[x], area) for area, x in seen.items()]
        return pd.DataFrame(out, columns=["via", "a_at", "latest", "b_trip", "b_leaves", "b_at", "second_via"])

    span = lambda x: F.floor(x / width).cast("int")
    asked = graph.written(searches.withColumn("span", span(F.col("a_at"))))
    spans = F.broadcast(asked.select("via", "span").distinct())
    on = aboard.join(F.broadcast(asked.select(F.col("via").alias("area_id")).distinct()), "area_id", "left_semi")
    order = ["arrives", "trip", "to_sequence", "from_sequence"]
    soonest = top(top(onward_rides(on, calls), ["via", "leaves", "to_area"], order, 1), ["via", "leaves"], order, most)
    rides = soonest.withColumn("span", F.explode(F.sequence(span(F.col("leaves") - longest), span(F.col("leaves") - wait)))).join(spans, ["via", "span"])
    return asked.groupBy("via", "span").cogroup(rides.groupBy("via", "span")).applyInPandas(walk, "via string, a_at int, latest int, b_trip string, b_leaves int, b_at int, second_via string")


#: Seconds of a span in which second rides are looked up.
SECOND_SPAN = 300
#: Pairs of searches and rides of a task, rows of it before they are dealt out again, and pairs of a step in it.
TASK_MEETINGS, TASK_ROWS, STEP_MEETINGS = 8_000_000, 200_000, 1_000_000
#: Rows of a block of searches or of rides of earliest arrivals, pairs that two blocks make, and rows that are packed together.
BLOCK_ROWS, BLOCK_MEETINGS, PACK_ROWS = 4_000_000, 32_000_000, 1_000_000
NEVER = 2**31 - 1


def coverage(calls: DataFrame, family: DataFrame, cases: DataFrame) -> DataFrame:
    """Each case (CASE) with its direct, one_transfer and two_transfers rides, classification, start_departs, target_departs and suspected_cause.

    Cases that one kind of ride answers take no part in the next.  Of a start and a
    window the soonest areas are expanded, and rides are counted up to fixed limits a
    pair of members.  ``cases`` may have start_mismatch, target_mismatch (strings) and
    ambiguous (boolean) from a search of the areas.
    """
    given = {"start_mismatch": F.lit(""), "target_mismatch": F.lit(""), "ambiguous": F.lit(False)}
    cases = graph.written(cases.withColumns({k: F.coalesce(F.col(k), v) if k in cases.columns else v for k, v in given.items()}).select(*CASE, *given).dropDuplicates(CASE))
    asked = graph.written(cases.select(F.col("start").alias("area_id")).distinct().union(cases.select("target").distinct()))
    routing = graph.written(station_families(family, asked).filter("routing_place IS NOT NULL"))
    pairs = graph.written(member_pairs(cases.select(*CASE), routing))
    calls = graph.written(calls)
    window, pair = ["a", "low", "to_seconds"], [*CASE, "a", "b"]
    first_rides = graph.written(rides(pairs.select(*window).distinct(), calls, "a", F.col("low"), F.col("to_seconds")))
    total = lambda rows, name, n: rows.groupBy(*CASE).agg(n.alias(name))
    some = lambda rows, key, k: top(rows, key, ["leaves", "arrives", "trip", "from_sequence", "to_sequence"], k)

    # rides that count don't depend on the case, but for when it must be there
    soonest = some(first_rides, [*window, "to_area"], DIRECT_LIMIT).groupBy(*window, F.col("to_area").alias("b")).agg(F.collect_list("arrives").alias("ends"))
    timely = F.size(F.filter("ends", lambda x: x <= F.col("until"))).alias("n")
    plain = pairs.filter("until > low").join(soonest, [*window, "b"]).select(*CASE, timely).filter("n > 0")
    direct = graph.written(total(plain, "direct", F.sum("n")))

    left = graph.written(pairs.join(direct, CASE, "left_anti"))
    leg = ["a_trip", "a_at", "via"]
    firsts = first_at_areas(first_rides.join(left.select(*window).distinct(), window, "left_semi"), window, "a", FIRST_LIMIT)
    turn = F.row_number().over(Window.partitionBy(*window).orderBy("arrives", "leaves", "trip", "to_area")).alias("turn")
    firsts = graph.written(firsts.select(*window, F.col("trip").alias("a_trip"), F.col("arrives").alias("a_at"), F.col("to_area").alias("via"), turn))
    # the rides that end at a target's member; nothing leaves behind the latest time to be there
    goals = left.select(F.col("b").alias("to_area")).distinct()
    since, last = (x or 0 for x in left.agg(F.min("low"), F.max("until")).first())
    soon = graph.written(calls.filter(F.col("departure_seconds").between(since, last)))
    ways = graph.written(onward_rides(soon, calls, goals))
    search = [*window, "latest"]
    starts = left.select(*search).distinct().join(firsts.select(*window, "via", "a_at"), window)
    found = changes_counted(starts, ways, left.select("b", (F.col("latest") - F.col("until")).alias("walk")).distinct())
    walk = F.col("latest") - F.col("until")
    one = graph.written(total(left.withColumn("walk", walk).join(found, [*search, "b", "walk"]), "one_transfer", F.sum("n")))

    rest = left.join(one, CASE, "left_anti").join(firsts.filter(F.col("turn") <= TWO_FIRST), window).filter("via <> b AND via <> a")
    rest = graph.written(rest.select(*pair, "until", *leg))
    seconds = second_rides(rest.select("via", "a_at", "latest").distinct(), soon, calls)
    onto = graph.written(rest.join(seconds, ["via", "a_at", "latest"]).filter("second_via NOT IN (a, b) AND b_trip <> a_trip"))
    last = F.least(F.col("b_at") + TWO_WAIT, F.col("until"))
    ends = onto.join(ways.withColumnsRenamed({"via": "second_via", "to_area": "b"}), ["second_via", "b"]).filter((F.col("leaves") >= F.col("b_at") + WAIT_SECONDS) & (last > F.col("b_at") + WAIT_SECONDS) & (F.col("leaves") <= last))
    waits = F.expr("(b_leaves - a_at) div 60 + (leaves - b_at) div 60")
    once = some(ends, [*pair, "via", "second_via"], TWO_LIMIT).filter(waits <= TWO_MINUTES).select(*pair, "a_trip", "b_trip", "trip").distinct()
    two = total(once, "two_transfers", F.count("*"))

    places = pairs.select(F.col("a").alias("area_id"), F.col("low").alias("since"), "to_seconds").union(pairs.select("b", "b_low", "to_seconds")).distinct()
    departs = graph.written(places.join(calls.select("area_id", "departure_seconds"), "area_id").filter("departure_seconds BETWEEN since AND to_seconds").select("area_id", "since", "to_seconds").distinct())
    # whether anything leaves depends on one end only
    seen = lambda end, area, since, name: pairs.select(end, "from_seconds", "to_seconds", area, since).distinct().join(departs.select(F.col("area_id").alias(area), F.col("since").alias(since), "to_seconds"), [area, since, "to_seconds"]).select(end, "from_seconds", "to_seconds").distinct().withColumn(name, F.lit(True))
    out = cases
    for rows in (direct, one, two):
        out = out.join(rows, CASE, "left")
    for rows in (seen("start", "a", "low", "start_departs"), seen("target", "b", "b_low", "target_departs")):
        out = out.join(rows, [x for x in rows.columns if x in CASE], "left")
    whole = F.col("start").isNotNull() & F.col("target").isNotNull() & F.col("latest").isNotNull()
    out = out.select(*CASE, *given, "direct", "one_transfer", "two_transfers", *[(F.col(k) & whole).alias(k) for k in ("start_departs", "target_departs")])
    out = out.fillna(0, ["direct", "one_transfer", "two_transfers"]).fillna(False, ["start_departs", "target_departs"])
    kind = F.when(F.col("direct") > 0, "FOUND_DIRECT").when(F.col("one_transfer") > 0, "FOUND_ONE_TRANSFER").when(F.col("two_transfers") > 0, "FOUND_TWO_TRANSFER").otherwise("UNKNOWN")
    out = out.withColumn("classification", kind)
    cause = suspected_cause(F.col("classification").startswith("FOUND"), *map(F.col, ("start_departs", "target_departs", "start_mismatch", "target_mismatch", "ambiguous")))
    return out.withColumn("suspected_cause", cause).drop(*given)


def useful_rides(calls: DataFrame, first: int, latest: int) -> DataFrame:
    """area_id, to_area, leaves and arrives of the rides from ``first`` to ``latest`` that none later reaches the same area as soon as."""
    aboard = calls.filter(F.col("departure_seconds").between(first, latest)).select("area_id", "trip_id", "stop_sequence", F.col("departure_seconds").alias("leaves"))
    off = calls.filter(F.col("arrival_seconds") <= latest).select("trip_id", F.col("area_id").alias("to_area"), F.col("stop_sequence").alias("to_sequence"), F.col("arrival_seconds").alias("arrives"))
    met = aboard.join(off, "trip_id").filter("to_sequence > stop_sequence").groupBy("area_id", "to_area", "leaves").agg(F.min("arrives").alias("arrives"))
    way = Window.partitionBy("area_id", "to_area")
    later = F.min("arrives").over(way.orderBy(F.desc("leaves")).rowsBetween(Window.unboundedPreceding, -1))
    return met.withColumn("_later", later).filter(F.col("_later").isNull() | (F.col("arrives") < F.col("_later"))).drop("_later")


def numbered(names: DataFrame) -> DataFrame:
    """name and id, a number from 0 on without gaps, of the different names (name); each task numbers its own."""
    own = graph.written(names.filter("name IS NOT NULL").distinct().select("name", F.monotonically_increasing_id().alias("k")))
    part, place = F.shiftright("k", 33).cast("int"), F.col("k").bitwiseAND((1 << 33) - 1)
    sizes = sorted(map(tuple, own.groupBy(part.alias("p")).agg(F.count("*")).collect()))
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    offsets = F.create_map(*[F.lit(x) for (p, _), at in zip(sizes, before, strict=False) for x in (p, at)]) if sizes else None
    return own.select("name", (place + offsets[part] if sizes else place).cast("int").alias("id"))


def in_numbers(df: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the ids of ``numbered`` in place of names."""
    for c in columns:
        df = df.join(ids.select(F.col("name").alias(c), F.col("id").alias("_id")), c).withColumn(c, F.col("_id")).drop("_id")
    return df


def in_names(df: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.join(ids.select(F.col("id").alias(c), F.col("name").alias("_name")), c).withColumn(c, F.col("_name")).drop("_name")
    return df


def packed(df: DataFrame, block: Column, columns: list[str]) -> DataFrame:
    """Rows of whole numbers as ``block`` and arrays of 32-bit numbers, one of each column for some rows of a block."""
    rows = PACK_ROWS

    # sent by value, as executors needn't have this package
    def run(batches):
        held, n = [], 0

        def flush():
            arrays = [np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in range(len(columns) + 1)]
            order = np.argsort(arrays[0], kind="stable")
            blocks, at = np.unique(arrays[0][order], return_index=True)
            ends = [*at[1:].tolist(), len(order)]
            sent = [a[order].astype("<i4") for a in arrays[1:]]
            return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), *(pa.array([a[i:j].tobytes() for i, j in zip(at.tolist(), ends, strict=True)], pa.binary()) for a in sent)], ["block", *columns])

        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    return df.select(block.cast("int").alias("block"), *columns).mapInArrow(run, "block int, " + ", ".join(f"{c} binary" for c in columns))


def ridden_by_number(edges: DataFrame, way: DataFrame) -> DataFrame:
    """start, area_id and at: where each search (start, area_id, ready) arrives first with one of ``way`` (``useful_rides``); starts and areas are 32-bit numbers.

    Searches are dealt to blocks by their start and rides to blocks by where they go, and
    each block of one meets each of the other, as packed arrays.  The sizes of blocks are
    fixed, so no task's memory grows with the input, and an arrival is decided in one task.
    """
    step, never = STEP_MEETINGS, NEVER

    # sent by value, as executors needn't have this package
    def meet(edges: pa.Table, way: pa.Table) -> pa.Table:
        read = lambda table, c: np.concatenate([np.zeros(0, "<i4"), *(np.frombuffer(x.as_buffer(), "<i4") for x in table.column(c))])
        answer = lambda *columns: pa.table([pa.array(c, pa.int32()) for c in columns], ["start", "area_id", "at"])
        starts, start = np.unique(read(edges, "start"), return_inverse=True)
        area, ready = read(edges, "area_id"), read(edges, "ready")
        tos, to = np.unique(read(way, "to_area"), return_inverse=True)
        by, leaves, arrives = read(way, "area_id").astype("int64"), read(way, "leaves"), read(way, "arrives")
        if not len(start) or not len(to):
            return answer([], [], [])
        # rides in order of area, end and time; a pair of area and end is a stretch of them
        pair = by * len(tos) + to
        order = np.lexsort((leaves, pair))
        pair, leaves, arrives = pair[order], leaves[order], arrives[order]
        pairs, at = np.unique(pair, return_inverse=True)
        floor = min(int(leaves.min()), int(ready.min()))
        width = max(int(leaves.max()), int(ready.max())) - floor + 2
        times = at.astype("int64") * width + (leaves - floor)
        area_of, to_of = pairs // len(tos), pairs % len(tos)
        last = np.searchsorted(at, np.arange(len(pairs)), "right")
        # searches of one area are looked up one behind the other
        order = np.argsort(area, kind="stable")
        start, area, ready = start[order], area[order], ready[order].astype("int64") - floor
        first = np.searchsorted(area_of, area, "left")
        n = np.searchsorted(area_of, area, "right") - first
        ends = np.cumsum(n)
        best = np.full(len(starts) * len(tos), never, "int32")
        i = 0
        while i < len(n):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] - n[i] + step, "right")))
            each = n[i:j]
            row = np.repeat(np.arange(i, j), each)
            own = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each) + first[row]
            ride = np.searchsorted(times, own * width + ready[row], "left")
            caught = ride < last[own]
            row, own, ride = row[caught], own[caught], ride[caught]
            np.minimum.at(best, start[row] * len(tos) + to_of[own], arrives[ride])
            i = j
        found = np.flatnonzero(best < never)
        return answer(starts[found // len(tos)], tos[found % len(tos)], best[found])

    edges = graph.written(edges.select("start", "area_id", "ready"))
    sizes = edges.groupBy("area_id").agg(F.count("*").alias("l")).join(way.groupBy("area_id").agg(F.count_distinct("to_area").alias("r")), "area_id").agg(F.sum(F.col("l") * F.col("r"))).first()
    blocks = lambda df: max(1, -(-df.count() // BLOCK_ROWS))
    by_area = blocks(way)
    by_start = max(blocks(edges), -(-(sizes[0] or 0) // (by_area * BLOCK_MEETINGS)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda x, n: F.pmod(F.xxhash64(x), F.lit(n))
    left = packed(edges, of("start", by_start), ["start", "area_id", "ready"]).withColumnRenamed("block", "_s").withColumn("_t", every(by_area))
    right = packed(way, of("to_area", by_area), ["area_id", "to_area", "leaves", "arrives"]).withColumnRenamed("block", "_t").withColumn("_s", every(by_start))
    deal = lambda df: df.repartition(by_start * by_area, "_s", "_t").groupBy("_s", "_t")
    return deal(left).cogroup(deal(right)).applyInArrow(meet, "start int, area_id int, at int")


def ridden(edges: DataFrame, way: DataFrame) -> DataFrame:
    """``ridden_by_number`` of starts and areas by name."""
    names = edges.select(F.col("start").alias("name")).union(edges.select("area_id")).union(way.select("area_id")).union(way.select("to_area"))
    ids = numbered(names)
    found = ridden_by_number(in_numbers(edges, ids, "start", "area_id"), in_numbers(way, ids, "area_id", "to_area"))
    return in_names(found, ids, "start", "area_id").select("start", "area_id", "at")


def earliest_arrivals(calls: DataFrame, family: DataFrame, starts: DataFrame, targets: DataFrame, departure: int, latest: int, changes: int = 2) -> DataFrame:
    """start, target, arrival_seconds and rides: when each target (area_id) is reached first from each start (area_id), and the fewest rides that do so.

    All starts go through each round together.  A round takes the soonest ride to every
    area from each area that a start has reached, and keeps arrivals that are earlier
    than any before them; only these board again, WAIT_SECONDS later.  An arrival that is
    no earlier than one with fewer rides can't lead anywhere sooner, so nothing is lost.
    The last round goes to the targets' members only.  Targets out of reach by ``latest``
    have no row.  Areas are numbers until the end.
    """
    routing = graph.written(station_families(family, starts.select("area_id").union(targets.select("area_id"))).filter("routing_place IS NOT NULL"))
    calls = graph.written(calls)
    ids = numbered(calls.select(F.col("area_id").alias("name")).union(routing.select("area_id")).union(routing.select("requested")))
    side = lambda name, wanted: in_numbers(routing.join(wanted.select(F.col("area_id").alias("requested")).distinct(), "requested").select(F.col("requested").alias(name), "area_id", (F.col("access_cost_minutes") * 60).alias("walk")), ids, name, "area_id")
    goal = graph.written(side("target", targets).select("target", "area_id", "walk"))
    goals = goal.select("area_id").distinct()
    way = graph.written(useful_rides(in_numbers(calls, ids, "area_id"), departure, latest))
    edge = side("start", starts).select("start", "area_id", (F.lit(departure) + F.col("walk")).alias("ready"))
    best = None
    for ride in range(1, changes + 2):
        if ride > changes:
            way = graph.written(way.join(goals.withColumnRenamed("area_id", "to_area"), "to_area", "left_semi"))
            best = None if best is None else best.join(goals, "area_id", "left_semi")
        new = ridden_by_number(edge.filter(F.col("ready") <= latest), way).withColumn("ride", F.lit(ride))
        if best is None:
            best = new = graph.written(new)
        else:
            # one row an area: that of the earliest arrival, then of the fewest rides
            kept = best.select("start", "area_id", "at", "ride").union(new).groupBy("start", "area_id").agg(F.min(F.struct("at", "ride")).alias("x"))
            best = graph.written(kept.select("start", "area_id", "x.at", "x.ride"))
            new = best.filter(F.col("ride") == ride)
        if ride <= changes and new.isEmpty():
            break
        edge = new.select("start", "area_id", (F.col("at") + WAIT_SECONDS).alias("ready"))
    ends = best.join(goal, "area_id").withColumn("at", F.col("at") + F.col("walk")).filter((F.col("at") <= latest) & (F.col("start") != F.col("target")))
    found = ends.groupBy("start", "target").agg(F.min(F.struct("at", "ride")).alias("x")).select("start", "target", F.col("x.at").alias("arrival_seconds"), F.col("x.ride").alias("rides"))
    return in_names(found, ids, "start", "target").select("start", "target", "arrival_seconds", "rides")


def family_graph(family: DataFrame, ways: DataFrame, areas: DataFrame, profiles: DataFrame, calls: DataFrame, requests: DataFrame, low: int, high: int) -> DataFrame:
    """What each requested area (area_id) belongs to: requested, canonical_area_id, part (member or way) and place, area_id, other_area_id, role, minutes, profile_class and departures.

    Members come in the order of what they are for, with their departures from ``low`` to
    ``high``; of the ways (canonical_area_id, from_area_id, to_area_id, access_minutes,
    source) the first EDGES by their ends.  An area without a family has no rows.  Each
    family is looked at once, however many areas of it are requested.
    """
    asked = requests.select(F.col("area_id").alias("requested")).distinct()
    owned = graph.written(asked.join(family.groupBy(F.col("area_id").alias("requested")).agg(F.min("canonical_area_id").alias("canonical_area_id")), "requested"))
    wanted = owned.select("canonical_area_id").distinct()
    leaves = calls.filter(F.col("departure_seconds").between(low, high)).groupBy("area_id").agg(F.count("*").alias("departures"))
    own = Window.partitionBy("canonical_area_id")
    rows = family.join(wanted, "canonical_area_id").join(areas.select("area_id", "area_name"), "area_id").join(profiles.select("area_id", "profile_class"), "area_id", "left").join(leaves, "area_id", "left")
    order = [F.desc("is_primary_for_search"), F.desc("is_primary_for_routing"), F.desc("is_visible_suggestion"), "access_cost_minutes", "member_role", "area_name", "area_id"]
    none = F.lit(None).cast("string")
    members = rows.select(
        "canonical_area_id", F.lit("member").alias("part"), F.row_number().over(own.orderBy(*order)).alias("place"), "area_id", none.alias("other_area_id"), F.col("member_role").alias("role"), F.col("access_cost_minutes").cast("int").alias("minutes"),
        F.coalesce("profile_class", F.lit("")).alias("profile_class"), F.coalesce("departures", F.lit(0)).alias("departures"),
    )
    listed = top(ways.join(wanted, "canonical_area_id"), ["canonical_area_id"], ["from_area_id", "to_area_id"], EDGES)
    turn = F.row_number().over(own.orderBy("from_area_id", "to_area_id"))
    edges = listed.select("canonical_area_id", F.lit("way"), turn, "from_area_id", "to_area_id", "source", F.col("access_minutes").cast("int"), none, F.lit(None).cast("long"))
    return owned.join(members.union(edges), "canonical_area_id")
