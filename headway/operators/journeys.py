"""Departures, rides and searches over a feed's tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c

# fixed values of searches with changes: first legs, areas to change at, second legs of each area, results; waits in seconds
FIRST_LEGS, TRANSFER_AREAS, SECOND_LEGS, RESULTS = 500, 25, 20, 10
WAIT_SECONDS, LONGEST_WAIT = 180, 2700
#: The same of the search that expands direct rides: areas reached, how long behind the window second legs may leave, results.
NEXT_LEGS, ONWARD_SECONDS, HYBRID_RESULTS = 40, 7200, 20


def departures(stop_times: DataFrame, members: DataFrame, trips: DataFrame, active: DataFrame, area: str, start: int, stop: int, limit: int) -> DataFrame:
    if start > stop or limit <= 0:
        raise ValueError("the window is empty")
    rows = stop_times.filter(F.col("departure_seconds").between(start, stop)).join(members.filter(F.col("area_id") == area), "stop_id").join(trips, "trip_id").join(active, "service_id")
    return rows.orderBy("departure_seconds", "trip_id", "stop_sequence").limit(limit)


def earliest(legs: DataFrame, key: str, latest: bool = False) -> DataFrame:
    """The leg that arrives first by ``key``; ``latest``: of those, the one that departs last."""
    departure = F.desc("departure_seconds") if latest else F.asc("departure_seconds")
    rest = ["from_sequence", "to_sequence"] if latest else ["to_sequence", "from_sequence"]
    order = Window.partitionBy(key).orderBy("arrival_seconds", departure, "trip_id", *rest)
    return legs.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def service_status(services: DataFrame, calendar: DataFrame, dates: DataFrame, date: str) -> DataFrame:
    """Why each service runs on a date or not: removal before addition before calendar."""
    day = datetime.strptime(date, "%Y%m%d").strftime("%A").lower()
    of_day = dates.filter(F.col("date") == date).groupBy("service_id").agg(F.max(F.col("exception_type") == 2).alias("removed"), F.max(F.col("exception_type") == 1).alias("added"))
    base = calendar.select("service_id", ((F.col("start_date") <= date) & (F.col("end_date") >= date) & (F.col(day) == 1)).alias("base"))
    rows = services.join(of_day, "service_id", "left").join(base, "service_id", "left").fillna(False)
    return rows.select("service_id", F.when(F.col("removed"), "removal").when(F.col("added"), "addition").when(F.col("base"), "calendar").otherwise("inactive").alias("reason"))


def day_reasons(services: DataFrame, summary: DataFrame, dates: DataFrame, days: list[str]) -> DataFrame:
    """Whether each service of ``services`` runs on each of some days, and why: exceptions decide before the calendar."""
    changes = dates.groupBy("service_id", F.col("date").alias("day")).agg(F.min("exception_type").alias("exception_type"), F.lit(True).alias("excepted"))
    known = summary.select("service_id", "has_calendar", "weekday_mask", "start_date", "end_date", F.lit(True).alias("known"))
    rows = services.select("service_id").withColumn("day", F.explode(F.array(*map(F.lit, days)))).join(known, "service_id", "left").join(changes, ["service_id", "day"], "left")
    bit = F.get(F.array(*[F.lit(1 << k) for k in range(7)]), F.weekday(F.to_date("day", "yyyyMMdd")))
    outside = F.col("start_date").isNull() | F.col("end_date").isNull() | (F.col("day") < F.col("start_date")) | (F.col("day") > F.col("end_date"))
    reason = (
        F.when(F.col("known").isNull(), "UNKNOWN_SERVICE").when(F.col("exception_type") == 1, "CALENDAR_DATES_ADDITION").when(F.col("exception_type") == 2, "CALENDAR_DATES_REMOVAL").when(F.col("excepted"), "INVALID_EXCEPTION_TYPE")
        .when(F.col("has_calendar") == 0, "EXCEPTIONS_ONLY_NO_ADDITION").when(outside, "OUTSIDE_CALENDAR_RANGE").when(F.col("weekday_mask").bitwiseAND(bit) != 0, "CALENDAR_WEEKDAY_ACTIVE").otherwise("CALENDAR_WEEKDAY_INACTIVE")
    )
    out = rows.select("service_id", "day", reason.alias("reason"))
    return out.withColumn("active", F.col("reason").isin("CALENDAR_DATES_ADDITION", "CALENDAR_WEEKDAY_ACTIVE"))


def one_transfer(first: DataFrame, second: DataFrame, areas: DataFrame, start: str, target: str, low: int, high: int, limit: int = RESULTS) -> DataFrame:
    """Rides with one change: of the first legs the best of each area, of these areas the soonest reached, from each the next second legs; equal rides once, in order of departure."""
    in_order = F.col("arrival_seconds") >= F.col("departure_seconds")
    early = first.filter(~F.col("to_area").isin(start, target) & F.col("departure_seconds").between(low, high) & in_order)
    early = early.orderBy("arrival_seconds", "departure_seconds", "to_area", "trip_id", "from_sequence", "to_sequence").limit(FIRST_LEGS)
    names = areas.select(F.col("area_id").alias("to_area"), "area_name")
    soonest = earliest(early, "to_area", latest=True).join(names, "to_area").orderBy("arrival_seconds", "departure_seconds", "area_name", "to_area").limit(TRANSFER_AREAS)
    best = soonest.select(F.col("to_area").alias("transfer_area"), F.col("area_name").alias("transfer_name"), F.col("trip_id").alias("first_trip"), "departure_seconds", F.col("arrival_seconds").alias("_at"))
    onward = second.filter((F.col("to_area") == target) & in_order).select(F.col("from_area").alias("transfer_area"), F.col("trip_id").alias("second_trip"), F.col("departure_seconds").alias("_leaves"), "arrival_seconds", "from_sequence", "to_sequence")
    both = best.join(onward, "transfer_area").filter(F.col("_leaves").between(F.col("_at") + WAIT_SECONDS, F.col("_at") + LONGEST_WAIT))
    order = Window.partitionBy("transfer_area").orderBy("_leaves", "arrival_seconds", "second_trip", "from_sequence", "to_sequence")
    few = both.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= SECOND_LEGS)
    wait = F.expr("(_leaves - _at) div 60").alias("wait_minutes")
    hits = few.select("transfer_area", "transfer_name", "first_trip", "second_trip", "departure_seconds", "arrival_seconds", wait)
    once = hits.groupBy("transfer_area", "transfer_name", "first_trip", "second_trip", "departure_seconds", "arrival_seconds").agg(F.min("wait_minutes").alias("wait_minutes"))
    return once.orderBy("departure_seconds", "arrival_seconds", "wait_minutes", "transfer_name", "transfer_area", "first_trip", "second_trip").limit(limit)


def hybrid(direct: DataFrame, first: DataFrame, second: DataFrame, start: str, target: str, low: int, high: int, enough: int = 1, limit: int = HYBRID_RESULTS) -> DataFrame:
    """Direct rides; where there are fewer than ``enough``, also rides over the NEXT_LEGS areas that are reached soonest; in order of departure, arrival and trips.

    A second leg leaves within the longest wait, and not over ONWARD_SECONDS behind the window.
    """
    none, span = F.lit(None).cast("string"), F.col("departure_seconds").between(low, high)
    own = direct.filter(span)
    rows = own.select(none.alias("transfer_area"), F.col("trip_id").alias("first_trip"), none.alias("second_trip"), "departure_seconds", "arrival_seconds")
    if len(own.take(enough)) < enough:
        reached = earliest(first.filter(~F.col("to_area").isin(start, target) & span & (F.col("arrival_seconds") >= F.col("departure_seconds"))), "to_area")
        few = reached.orderBy("arrival_seconds", "departure_seconds", "trip_id", "to_area").limit(NEXT_LEGS).select(F.col("to_area").alias("transfer_area"), F.col("trip_id").alias("first_trip"), "departure_seconds", F.col("arrival_seconds").alias("_at"))
        onward = second.filter(F.col("to_area") == target).select(F.col("from_area").alias("transfer_area"), F.col("trip_id").alias("second_trip"), F.col("departure_seconds").alias("_leaves"), "arrival_seconds")
        until = F.least(F.lit(high + ONWARD_SECONDS), F.col("_at") + LONGEST_WAIT)
        met = few.join(onward, "transfer_area").filter(F.col("_leaves").between(F.col("_at") + WAIT_SECONDS, until))
        rows = rows.union(met.select("transfer_area", "first_trip", "second_trip", "departure_seconds", "arrival_seconds").distinct())
    return rows.orderBy("departure_seconds", "arrival_seconds", "first_trip", F.asc_nulls_first("second_trip"), F.asc_nulls_first("transfer_area")).limit(limit)


#: Words that say station in a search and nothing about which.
GENERIC = ("hbf", "hauptbahnhof", "bf", "bahnhof", "u", "ubahn", "s", "sbahn")
def query_intents(normal: Column) -> dict[str, Column]:
    """What a query in search form is after: a station, a place with rail (one or two words of its own), a station of one side, or any station."""
    station = normal.contains("hbf") | normal.contains("bahnhof") | normal.endswith(" bf") | normal.contains("suedkreuz")
    own = F.size(F.array_distinct(F.filter(F.split(normal, " "), lambda w: (F.length(w) >= 2) & ~w.isin(*GENERIC))))
    sides = ("ostbahnhof", "westbahnhof", "nordbahnhof", "suedbahnhof", "sudbahnhof")
    return {"station": station, "rail_place": ~station & own.between(1, 2), "directional": normal.rlike(f"(?:^| )(?:{'|'.join(sides)})$"), "generic": normal.isin("bahnhof", "hbf", "hauptbahnhof", *sides)}


def search(tokens: DataFrame, areas: DataFrame, queries: DataFrame, limit: int = 20) -> DataFrame:
    """The best areas of each query (``query``), all queries in one plan.

    A whole name or word, a beginning, and area names score; so do names that equal,
    begin with or hold the query; query words that an area lacks cost, and some points
    come from its size.
    """
    from .derive import SYNONYMS

    table = F.create_map(*[F.lit(x) for pair in SYNONYMS.items() for x in pair])
    q = queries.select("query", c.normalised(F.col("query")).alias("whole")).filter("whole <> ''").distinct()
    q = q.withColumn("words", F.array_distinct(F.split("whole", " ")))
    q = q.withColumn("specific", F.exists("words", lambda w: ~w.isin(*GENERIC)) & (F.size("words") > 1))
    more = F.array_distinct(F.flatten(F.transform("words", lambda w: F.array_compact(F.array(w, table[w])))))
    asked = F.filter(more, lambda w: ~(F.col("specific") & w.isin(*GENERIC)))
    each = q.select("query", F.explode(F.array_distinct(F.concat(F.array("whole"), asked))).alias("word"), "whole", asked.alias("asked")).withColumn("by_word", F.array_contains("asked", F.col("word")))
    own = tokens.select("area_id", "token", "token_type", "source").distinct()
    # whole words by an equi-join; beginnings of three letters or more by an equi-join on the first three
    exact = own.join(F.broadcast(each.select("query", "word")), own["token"] == F.col("word")).select("query", "word", "area_id", "token", "token_type", "source", F.lit(True).alias("whole_word"))
    starts = each.filter("by_word AND length(word) >= 3").select("query", "word", F.substring("word", 1, 3).alias("head"))
    begun = own.withColumn("head", F.substring("token", 1, 3)).join(F.broadcast(starts), "head").filter(F.col("token").startswith(F.col("word"))).select("query", "word", "area_id", "token", "token_type", "source", F.lit(False).alias("whole_word"))
    hits = exact.union(begun)
    # fixed values of the scores
    per_word = hits.groupBy("query", "area_id", "word").agg(
        F.max(F.when(F.col("whole_word"), F.when(F.col("token_type") == "NORMALIZED", 1600).otherwise(1000))).alias("exact"), F.max(F.when(~F.col("whole_word"), 420)).alias("begun"),
        (180 * F.count_distinct(F.when(F.col("source") == "AREA_NAME", F.col("token")))).alias("named"),
    )
    summed = per_word.groupBy("query", "area_id").agg(F.sum(F.coalesce("exact", F.lit(0)) + F.coalesce("begun", F.lit(0)) + F.col("named")).alias("points"), F.collect_set("word").alias("found"))
    named = areas.select("area_id", "area_name", "stop_count", c.normalised(F.col("area_name")).alias("name"))
    rows = summed.join(named, "area_id").join(F.broadcast(q.select("query", "whole", "words")), "query")
    name = F.col("name")
    fit = F.when(name == F.col("whole"), 8000).when(name.startswith(F.col("whole")), 3000).when(F.contains(name, F.col("whole")), 1200).otherwise(0)
    missing = F.size(F.array_except(F.array_except("words", "found"), F.split(name, " ")))
    score = F.col("points") + fit + F.when(missing == 0, 4000).otherwise(missing * -4000) + F.least(F.lit(120), F.col("stop_count") * 4)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "area_name", "area_id")
    ranked = rows.select("query", "area_id", "area_name", score.cast("long").alias("score")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= limit)


def family_search(heads: DataFrame, aliases: DataFrame, tokens: DataFrame, profiles: DataFrame, queries: DataFrame) -> DataFrame:
    """query, area_id and score: families' names (heads: area_id, display_name), aliases and words that equal or begin with each query, each hit with its area's own score."""
    q = queries.select("query", c.normalised(F.col("query")).alias("whole")).filter("whole <> ''").distinct()
    head = lambda x: F.substring(x, 1, 1)
    asked = F.broadcast(q.withColumn("_h", head(F.col("whole"))))
    # fixed values of the scores; beginnings by an equi-join on the first letter
    named = heads.select("area_id", c.normalised(F.col("display_name")).alias("n")).withColumn("_h", head(F.col("n"))).join(asked, "_h").filter(F.col("n").startswith(F.col("whole")))
    by_name = named.select("query", "area_id", F.when(F.col("n") == F.col("whole"), 45000).otherwise(18000).alias("p"))
    other = aliases.select("area_id", F.col("alias_normalized").alias("n"), "priority").withColumn("_h", head(F.col("n"))).join(asked, "_h").filter(F.col("n").startswith(F.col("whole")))
    by_alias = other.select("query", "area_id", (F.when(F.col("n") == F.col("whole"), 20000).otherwise(8000) + F.col("priority") * 100).alias("p"))
    words = F.broadcast(q.select("query", F.explode(F.array_distinct(F.split("whole", " "))).alias("token")))
    by_word = tokens.select("area_id", "token").distinct().join(words, "token").groupBy("query", "area_id").agg((F.count("*") * 2000).cast("int").alias("p"))
    hits = by_name.union(by_alias).union(by_word).join(profiles.select("area_id", "search_priority_score"), "area_id", "left")
    return hits.groupBy("query", "area_id").agg(F.sum(F.col("p") + F.coalesce("search_priority_score", F.lit(0))).cast("long").alias("score"))


def leg_failures(claims: DataFrame, stop_times: DataFrame, active: DataFrame) -> DataFrame:
    """Claimed legs (trip_id, stops, sequences, times, service_id) with what is wrong with each."""
    call = lambda side, time: stop_times.select("trip_id", F.col("stop_id").alias(f"{side}_stop_id"), F.col("stop_sequence").alias(f"{side}_sequence"), F.col(time).alias(f"_{side}"))
    rows = claims.join(call("from", "departure_seconds"), ["trip_id", "from_stop_id", "from_sequence"], "left").join(call("to", "arrival_seconds"), ["trip_id", "to_stop_id", "to_sequence"], "left")
    rows = rows.join(F.broadcast(active.select("service_id", F.lit(True).alias("_runs"))), "service_id", "left")
    tests = {
        "CALL_NOT_FOUND": F.col("_from").isNull() | F.col("_to").isNull(), "TIME_MISMATCH": (F.col("_from") != F.col("departure_seconds")) | (F.col("_to") != F.col("arrival_seconds")), "ARRIVES_BEFORE_DEPARTURE": F.col("arrival_seconds") < F.col("departure_seconds"),
        "WRONG_ORDER": F.col("to_sequence") <= F.col("from_sequence"), "SERVICE_INACTIVE": F.col("_runs").isNull(),
    }
    return rows.withColumn("failures", F.array_compact(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]))).drop("_from", "_to", "_runs")


def scenario_audit(scenarios: DataFrame, summary: DataFrame, dates: DataFrame, trips: DataFrame, stop_times: DataFrame, members: DataFrame) -> DataFrame:
    """Services, trips, departures, areas, late times and exceptions of each scenario (name, day, lo, hi), in one plan."""
    days = F.broadcast(scenarios.select("day").distinct())
    changes = dates.select("service_id", F.col("date").alias("day"), "exception_type")
    bit = F.get(F.array(*[F.lit(1 << k) for k in range(7)]), F.weekday(F.to_date("day", "yyyyMMdd")))
    base = (F.col("has_calendar") == 1) & F.col("day").between(F.col("start_date"), F.col("end_date")) & (F.col("weekday_mask").bitwiseAND(bit) != 0)
    kind = F.col("exception_type")
    rows = summary.crossJoin(days).join(changes, ["service_id", "day"], "left").filter(F.when(kind == 1, True).when(kind == 2, False).otherwise(base)).select("day", "service_id")
    services = rows.groupBy("day").agg(F.count("*").alias("services"))
    excepted = changes.join(days, "day").groupBy("day").agg(F.count_if(kind == 1).alias("additions"), F.count_if(kind == 2).alias("removals"))
    runs = trips.join(rows, "service_id").select("day", "trip_id")
    calls = stop_times.join(runs, "trip_id").join(members.select("stop_id", "area_id"), "stop_id", "left").join(F.broadcast(scenarios), "day").filter(F.col("departure_seconds").between(F.col("lo"), F.col("hi")))
    counts = calls.groupBy("name").agg(F.count_distinct("trip_id").alias("trips"), F.count("*").alias("departures"), F.count_distinct("area_id").alias("areas"), F.count_if(F.col("departure_seconds") >= 86_400).alias("overflow"))
    out = scenarios.join(counts, "name", "left").join(services, "day", "left").join(excepted, "day", "left").fillna(0)
    return out.select("name", "day", "services", "trips", "departures", "areas", "overflow", "additions", "removals")
