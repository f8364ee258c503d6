"""Quality audits: counters in one row each, pass rules, and comparisons of two feeds."""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import derive

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
#: Seconds of a day; times beyond belong to the service day before midnight.
DAY_SECONDS = 86_400
# --- fixed values of the contract: percent by which a table or a counter may drift between feeds ---
ROW_DRIFT = {
    "stops": 5.0, "stop_areas": 5.0, "stop_area_members": 5.0, "routes": 10.0, "trips": 25.0, "stop_times": 25.0, "transfers": 30.0, "calendar": 50.0, "calendar_dates": 50.0, "feed_agencies": 10.0, "service_calendar_summary": 50.0,
    "stop_search_tokens": 10.0, "stop_area_display_names": 5.0, "display_name_quality_findings": 30.0,
}
SERVICE_DRIFT = {"services": 50.0, "trip_services": 25.0, "base_calendar_services": 50.0, "exception_services": 50.0, "exception_only_services": 100.0, "overflow_stop_times": 30.0, "maximum_service_day_seconds": 10.0}
#: Tables whose row counts must be those of the baseline.
STABLE = ["stops", "stop_areas", "stop_area_members", "routes", "trips", "stop_times", "transfers", "calendar", "calendar_dates", "stop_search_tokens", "stop_area_display_names"]
#: Tables and columns that routing needs.
ROUTING_TABLES = ["stop_areas", "stop_area_members", "stop_search_tokens", "hub_profiles", "route_axes", "transfer_rules", "stop_footpaths", "service_calendar_summary"]
ROUTING_COLUMNS = {
    "stop_times": ["stop_id", "arrival_seconds", "departure_seconds"], "trips": ["service_id"], "calendar": ["service_id"], "calendar_dates": ["service_id", "date", "exception_type", "exception_action"], "service_calendar_summary": ["service_timezone"],
}
# --- end of fixed values ---


def beside(*rows: DataFrame) -> DataFrame:
    """One-row tables as one row."""
    out = rows[0]
    for r in rows[1:]:
        out = out.crossJoin(F.broadcast(r))
    return out


def service_day_model(summary: DataFrame, calendar: DataFrame, dates: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Counters of services, wrong flags, ranges, dates and types, timezones and late times, and whether the model is sound."""
    zone, runs = F.col("service_timezone"), F.col("trip_count") > 0
    known = F.broadcast(summary.sparkSession.createDataFrame([(z,) for z in sorted(available_timezones())], "service_timezone string").withColumn("iana", F.lit(True)))
    own = summary.join(known, "service_timezone", "left").agg(
        F.count("*").alias("services"), F.count_if(runs).alias("trip_services"), F.count_if(F.col("has_calendar") == 1).alias("base_calendar_services"), F.count_if(F.col("addition_count") + F.col("removal_count") > 0).alias("exception_services"),
        F.count_if(F.col("status") == "EXCEPTIONS_ONLY").alias("exception_only_services"), F.count_if(F.col("status") == "UNRESOLVED").alias("unresolved_trip_services"),
        F.count_if(runs & F.col("iana").isNull() & ~zone.isin("UNKNOWN", "MULTIPLE")).alias("invalid_iana_timezone_services"), F.count_if(runs & (zone == "UNKNOWN")).alias("unknown_timezone_trip_services"), F.count_if(runs & (zone == "MULTIPLE")).alias("multiple_timezone_trip_services"),
    )
    wrong = lambda test: ~F.coalesce(test, F.lit(False))
    day = lambda x: F.col(x).rlike("^[0-9]{8}$")
    flags = F.lit(True)
    for d in DAYS:
        flags = flags & F.col(d).isin(0, 1)
    bases = calendar.agg(F.count_if(wrong(flags)).alias("invalid_weekday_flags"), F.count_if(wrong(day("start_date") & day("end_date") & (F.col("start_date") <= F.col("end_date")))).alias("invalid_calendar_ranges"))
    changes = dates.agg(F.count_if(wrong(day("date"))).alias("invalid_exception_dates"), F.count_if(wrong(F.col("exception_type").isin(1, 2))).alias("invalid_exception_types"))
    late = F.greatest("arrival_seconds", "departure_seconds")
    times = stop_times.agg(F.count_if(late >= DAY_SECONDS).alias("overflow_stop_times"), F.coalesce(F.max(late), F.lit(0)).cast("long").alias("maximum_service_day_seconds"))
    out = beside(own, bases, changes, times)
    sound = [F.col(x) == 0 for x in ("unresolved_trip_services", "invalid_weekday_flags", "invalid_calendar_ranges", "invalid_exception_dates", "invalid_exception_types", "invalid_iana_timezone_services", "unknown_timezone_trip_services", "multiple_timezone_trip_services")]
    whole = sound[0]
    for x in sound[1:]:
        whole = whole & x
    return out.withColumn("pass", whole)


def transfer_audit(stops: DataFrame, transfers: DataFrame, edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Counters over transfers, edges and footpaths, and whether nothing but proven ways is traversable.

    ``paths``: ``derive.footpaths``, or ``derive.footpath_places``, whose ``pairs`` say how many footpaths a row stands for.
    """
    scoped = F.lit(False)
    for k in ("from_route_id", "to_route_id", "from_trip_id", "to_trip_id", "service_id"):
        if k in transfers.columns:
            scoped = scoped | F.col(k).isNotNull()
    raw = transfers.agg(F.count("*").alias("raw_transfers"), F.count_if(scoped).alias("scoped_transfers"))
    walk = F.col("is_traversable") == 1
    facts = transfers.select(F.col("transfer_id").cast("long").alias("raw_transfer_id"), F.col("transfer_type").isin(3, 4, 5).alias("_other"), scoped.alias("_scoped"))
    of_edges = edges.join(facts, "raw_transfer_id", "left").agg(
        F.count("*").alias("transfer_edges"), F.count_if(walk).alias("traversable_edges"), F.count_if(F.coalesce("_other", F.lit(False))).alias("non_pedestrian_edges"), F.count_if(F.coalesce("_scoped", F.lit(False))).alias("scoped_edges"),
        F.count_if(walk & (F.col("edge_kind") == "NEARBY_AREA_CANDIDATE")).alias("traversable_nearby"), F.count_if(walk & (F.col("edge_kind") == "AREA_MEMBERSHIP_CANDIDATE")).alias("traversable_membership"),
    )
    d, s = F.col("distance_meters"), F.col("min_transfer_seconds")
    each = F.col("pairs") if "pairs" in paths.columns else F.lit(1).cast("long")
    count = lambda test: F.coalesce(F.sum(F.when(test, each)), F.lit(0).cast("long"))
    of_paths = paths.agg(
        count(F.lit(True)).alias("footpaths"), count(walk).alias("traversable_footpaths"), count(~walk).alias("unknown_footpaths"), count(walk & (d > 400)).alias("too_far"), count(walk & (s.isNull() | (s < 120))).alias("too_fast"),
        F.count_distinct(F.when(d > 400, F.col("area_id"))).alias("oversized_areas"), F.count_distinct(F.when(d > 700, F.col("area_id"))).alias("extreme_areas"), F.max(d).alias("longest"),
    )
    several = derive.stop_area_members(derive.boarding_stops(stops)).groupBy("area_id").agg(F.count_distinct("stop_id").alias("n")).filter("n > 1")
    walked = paths.select("area_id", F.lit(True).alias("_w")).distinct()
    of_areas = several.join(walked, "area_id", "left").agg(F.count("*").alias("multi_stop_areas"), F.count_if(F.col("_w").isNull()).alias("areas_without_footpaths"))
    out = beside(raw, of_edges, of_paths, of_areas)
    zero = [F.col(x) == 0 for x in ("non_pedestrian_edges", "scoped_edges", "traversable_nearby", "traversable_membership", "too_far", "too_fast", "areas_without_footpaths")]
    whole = zero[0]
    for x in zero[1:]:
        whole = whole & x
    return out.withColumn("pass", whole)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """name and rows of each table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("rows"))
        out = row if out is None else out.union(row)
    return out


def drift(baseline: DataFrame, candidate: DataFrame, limits: dict[str, float], value: str = "rows") -> DataFrame:
    """name, baseline, candidate, delta, percent and classification of each limited metric (name, value) of two feeds; one that a side lacks is MISSING."""
    spark = baseline.sparkSession
    wanted = F.broadcast(spark.createDataFrame(list(limits.items()), "name string, threshold double"))
    a, b = baseline.select("name", F.col(value).cast("long").alias("baseline")), candidate.select("name", F.col(value).cast("long").alias("candidate"))
    rows = wanted.join(a, "name", "left").join(b, "name", "left").withColumn("delta", F.col("candidate") - F.col("baseline"))
    percent = F.abs("delta") * 100.0 / F.greatest(F.lit(1), F.abs("baseline"))
    kind = F.when(F.col("delta").isNull(), "MISSING").when(F.col("delta") == 0, "UNCHANGED").when(percent <= F.col("threshold"), "EXPECTED_FEED_DRIFT").otherwise("REVIEW_REQUIRED")
    return rows.select("name", "baseline", "candidate", "delta", F.round(percent, 6).alias("percent"), "threshold", kind.alias("classification"))


def equal_counts(baseline: DataFrame, candidate: DataFrame, names: list[str], value: str = "rows") -> DataFrame:
    """name, expected, actual and status of metrics that must be those of the baseline; what is missing on both sides is equal."""
    spark = baseline.sparkSession
    a, b = baseline.select("name", F.col(value).cast("long").alias("expected")), candidate.select("name", F.col(value).cast("long").alias("actual"))
    rows = F.broadcast(spark.createDataFrame([(n,) for n in names], "name string")).join(a, "name", "left").join(b, "name", "left")
    return rows.withColumn("status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS").otherwise("FAIL"))


def long_form(row: DataFrame) -> DataFrame:
    """A row of counters as (name, rows); what is no number is left out."""
    numbers = [k for k, kind in row.dtypes if kind in ("bigint", "int", "double")]
    return row.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, numbers)), F.array(*[F.col(k).cast("long") for k in numbers]))).alias("name", "rows"))


def spot_checks(summary: DataFrame, dates: DataFrame, days: list[str]) -> DataFrame:
    """Active services and trips, services of the calendar alone, additions and removals of each day."""
    rows = summary.withColumn("day", F.explode(F.array(*map(F.lit, days))))
    changes = dates.select("service_id", F.col("date").alias("day"), "exception_type")
    bit = F.get(F.array(*[F.lit(1 << k) for k in range(7)]), F.weekday(F.to_date("day", "yyyyMMdd")))
    base = F.coalesce((F.col("has_calendar") == 1) & F.col("day").between(F.col("start_date"), F.col("end_date")) & (F.col("weekday_mask").bitwiseAND(bit) != 0), F.lit(False))
    kind = F.col("exception_type")
    active = F.when(kind == 1, True).when(kind == 2, False).otherwise(base)
    return rows.join(changes, ["service_id", "day"], "left").groupBy("day").agg(
        F.count_if(active).alias("active_services"), F.coalesce(F.sum(F.when(active, F.col("trip_count"))), F.lit(0)).alias("active_trips"), F.count_if(base).alias("base_services"), F.count_if(F.coalesce(kind == 1, F.lit(False))).alias("additions"),
        F.count_if(F.coalesce(kind == 2, F.lit(False))).alias("removals"),
    )


def routing_compatibility(tables: dict[str, DataFrame], model: DataFrame, transfers: DataFrame) -> DataFrame:
    """check and status (PASS, WARN or INFO): tables and columns that routing needs, and what the audits and row counts say."""
    spark = model.sparkSession
    fixed = [(f"table_{t}", "PASS" if t in tables else "WARN") for t in ROUTING_TABLES]
    fixed += [(f"column_{t}.{k}", "PASS" if t in tables and k in tables[t].columns else "WARN") for t, columns in ROUTING_COLUMNS.items() for k in columns]
    rows = spark.createDataFrame(fixed, "check string, status string")
    counts = row_counts({t: tables[t] for t in ("trips", "stop_times", "calendar", "calendar_dates") if t in tables}).groupBy().pivot("name", ["trips", "stop_times", "calendar", "calendar_dates"]).agg(F.first("rows")).fillna(0)
    facts = beside(counts, model.select(F.col("pass").alias("model"), "maximum_service_day_seconds"), transfers.select(F.col("pass").alias("ways")))
    word = lambda test, no: F.when(test, "PASS").otherwise(no)
    told = {
        "service_day_model": word(F.col("model"), "WARN"), "concrete_trip_validation": word((F.col("trips") > 0) & (F.col("stop_times") > 0), "WARN"), "gtfs_over_24h_times": word(F.col("maximum_service_day_seconds") > DAY_SECONDS, "INFO"),
        "calendar_service_binding": word(F.col("calendar") > 0, "WARN"), "calendar_dates_service_exceptions": word(F.col("calendar_dates") > 0, "INFO"), "transfer_footpath_semantics": word(F.col("ways"), "WARN"),
    }
    return rows.union(facts.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, told)), F.array(*told.values()))).alias("check", "status")))


def feed_gate(checks: DataFrame, changed_sources: Column | None = None) -> DataFrame:
    """One row: failures of a comparison, and whether the candidate may be looked at; ``changed_sources`` says that any input is new."""
    bad = F.col("classification").isin("REVIEW_REQUIRED", "MISSING")
    rows = checks.agg(F.count_if(bad).alias("failures"), F.array_sort(F.collect_list(F.when(bad, F.col("name")))).alias("failed"))
    new = F.lit(True) if changed_sources is None else changed_sources
    ok = (F.col("failures") == 0) & new
    return rows.withColumns({"pass": ok, "decision": F.when(ok, "ELIGIBLE_FOR_MANUAL_REVIEW").otherwise("BLOCKED")})


def import_warnings(stops: DataFrame, trips: DataFrame, routes: DataFrame, areas: DataFrame, tokens: DataFrame, hubs: DataFrame, axes: DataFrame, stop_times: DataFrame, transfers: DataFrame) -> DataFrame:
    """One row of counters of what an import warns of."""
    lat, lon = F.col("stop_lat"), F.col("stop_lon")
    placed = F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))
    blank = F.trim(F.coalesce("stop_name", F.lit(""))) == ""
    own = stops.agg(F.count_if(blank).alias("empty_stop_names"), F.count_if(~placed).alias("invalid_coordinates"))
    lost = trips.join(routes.select("route_id"), "route_id", "left_anti").agg(F.count("*").alias("unknown_route_references"))
    large = areas.agg(F.count_if(F.col("stop_count") >= 50).alias("stop_areas_too_large"))
    named = stops.select("stop_id").join(tokens.filter("stop_id IS NOT NULL").select("stop_id").distinct(), "stop_id", "left_anti").agg(F.count("*").alias("names_without_tokens"))
    odd = hubs.agg(F.count_if((F.col("stop_count") >= 10) & (F.col("route_count") == 0)).alias("hubs_without_routes"))
    short = axes.agg(F.count_if(F.col("stop_count") < 2).alias("route_axes_too_short"))
    idle = trips.join(stop_times.select("trip_id").distinct(), "trip_id", "left_anti").agg(F.count("*").alias("trips_without_stop_times"))
    moves = derive.transfer_counts(transfers, derive.stop_area_members(stops)).select(F.col("unmapped").alias("unmapped_transfers"), "negative_times", "very_long_times")
    return beside(own, lost, large, named, odd, short, idle, moves)
