"""The gate of a published feed: counters measured while its tables are written, flags, and what warns against its use."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import graph

# --- fixed values of the contract ---
CORE = ["stops", "stop_areas", "stop_area_members", "routes", "trips", "stop_times", "calendar", "calendar_dates"]
#: Tables that must have rows, and those that must be there.
FILLED = ["stop_search_tokens", "area_route_service_summary", "stop_area_cities", "stop_area_profiles", "canonical_stop_areas", "canonical_stop_area_members", "canonical_stop_area_names", "stop_area_display_names", "service_calendar_summary", "canonical_stop_area_transfer_edges", "stop_area_aliases", "transfer_edges"]
PRESENT = ["display_name_quality_findings", "stop_footpaths"]
#: Flags whose names are not their tables'.
FLAG_NAMES = {"service_calendar_summary": "service_day_model", "display_name_quality_findings": "display_name_quality_baseline"}
_LABELS, _COLOUR, _PLATFORM = ("trim(coalesce({}, '')) <> ''".format(x) for x in ("line_labels", "route_color", "platform_code"))
#: Counters by table: name and which rows count.
COUNTERS = {
    "stop_search_tokens": {"stop_search_tokens_count": "true"},
    "area_route_service_summary": {"area_route_service_summary_count": "true"},
    "stop_area_cities": {"stop_area_cities_count": "true", "stop_area_cities_official_boundary_count": "quality = 'OFFICIAL_BOUNDARY'", "stop_area_cities_unresolved_count": "quality = 'UNRESOLVED'"},
    "stop_area_profiles": {"stop_area_profiles_count": "true", "stop_area_profiles_nonempty_line_labels": _LABELS, "rail_stop_area_profiles_count": "has_rail_service <> 0", "rail_stop_area_profiles_with_line_labels": f"has_rail_service <> 0 AND {_LABELS}"},
    "stop_area_aliases": {"stop_area_aliases_count": "true"},
    "canonical_stop_areas": {"canonical_stop_areas_count": "true", "canonical_stop_area_multi_member_count": "member_count > 1", "canonical_stop_area_technical_display_names": "display_quality = 'TECHNICAL'"},
    "canonical_stop_area_members": {"canonical_stop_area_members_count": "true", "canonical_stop_area_visible_suggestions": "is_visible_suggestion <> 0", "canonical_stop_area_routing_members": "is_primary_for_routing <> 0", "canonical_stop_area_bus_feeder_members": "member_role = 'BUS_FEEDER'"},
    "canonical_stop_area_names": {"canonical_stop_area_names_count": "true", "canonical_stop_area_good_display_names": "display_quality = 'GOOD'"},
    "stop_area_display_names": {"stop_area_display_names_count": "true", "public_stop_area_good_display_names": "display_quality = 'GOOD'"},
    "canonical_stop_area_transfer_edges": {"canonical_stop_area_transfer_edges_count": "true"},
    "transfer_edges": {"transfer_edges_count": "true"},
    "stop_footpaths": {"stop_footpaths_count": "true", "stop_footpaths_traversable_count": "is_traversable = 1", "stop_footpaths_unknown_count": "is_traversable = 0"},
    "routes": {"routes_with_color_count": _COLOUR},
    "stops": {"platform_codes_count": _PLATFORM},
    "calendar": {"calendar_rows_count": "true"},
    "calendar_dates": {"calendar_dates_rows_count": "true"},
    "service_calendar_summary": {"service_calendar_summary_count": "true"},
    "display_name_quality_findings": {"display_name_quality_finding_count": "true", "display_name_quality_prefix_count": "finding_type = 'UPPERCASE_PREFIX'", "display_name_quality_municipality_only_count": "finding_type = 'MUNICIPALITY_ONLY'", "display_name_quality_destructive_action_count": "action <> 'PRESERVE'"},
}
#: Counters that come from other audits' rows: their names and the audits' columns.
MODEL = {"service_count": "services", **{x: x for x in ("unresolved_trip_services", "invalid_weekday_flags", "invalid_calendar_ranges", "invalid_exception_dates", "invalid_exception_types", "invalid_iana_timezone_services", "unknown_timezone_trip_services", "multiple_timezone_trip_services", "overflow_stop_times")}}
NAMES = {"audit_scanned_count": "scanned", "format_mismatch_count": "format_mismatches", "municipality_only_count": "municipality_only", "duplicate_city_prefix_count": "duplicate_city", "matching_city_code_prefix_count": "city_codes", "matching_city_qualifier_count": "city_qualifiers", "suspicious_unknown_prefix_count": "unknown_prefixes"}
NAME_FAULTS = ["format_mismatches", "duplicate_city", "city_codes", "city_qualifiers", "invalid_rules"]
# --- end of fixed values ---


def measured(tables: dict[str, DataFrame], weights: dict[str, str] | None = None) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The tables, written, and the COUNTERS observed on the way: one job and one pass a table.

    A column that a table lacks counts nothing, as does a table that is absent.  Of a table
    in ``weights`` each row counts as often as the column named there says.
    """
    out, found = {}, {}
    for name, df in tables.items():
        wanted = {k: test for k, test in COUNTERS.get(name, {}).items()}
        if not wanted:
            out[name] = df
            continue
        each = F.col(weights[name]) if name in (weights or {}) else None
        count = lambda test: F.count_if(test) if each is None else F.coalesce(F.sum(F.when(test, each)), F.lit(0).cast("long"))  # noqa: B023, E731
        # expressions over columns that are absent can't be analysed
        tests = {}
        for k, test in wanted.items():
            try:
                df.select(F.expr(test))
            except Exception as e:  # noqa: BLE001
                if "UNRESOLVED_COLUMN" not in str(e):
                    raise
                found[k] = 0
            else:
                tests[k] = count(F.expr(test)).alias(k)
        seen = Observation(name)
        out[name] = graph.written(df.observe(seen, count(F.lit(True)).alias("_rows"), *tests.values()))
        found |= {k: v for k, v in seen.get.items() if k != "_rows"} | {f"rows of {name}": seen.get["_rows"]}
    return out, found


def gate(spark: SparkSession, present: list[str], found: dict[str, int], model: DataFrame, names: DataFrame, gaps: int) -> DataFrame:
    """kind (flag, check, warning), name and value: what is there, all counters, and what warns; without a warning the feed may be used.

    ``found`` is what ``measured`` counted; ``model`` and ``names`` are the one-row
    audits of service days and of names, ``gaps`` the findings on names that aren't told.
    """
    days, shown = model.first(), names.first()
    rows = lambda name: found.get(f"rows of {name}", 0)
    flags = {"core_tables": set(CORE) <= set(present)}
    flags |= {FLAG_NAMES.get(x, x): rows(x) > 0 for x in FILLED} | {FLAG_NAMES.get(x, x): x in present for x in PRESENT}
    needed = dict(flags)
    flags |= {"route_colors": found.get("routes_with_color_count", 0) > 0, "platform_codes": found.get("platform_codes_count", 0) > 0}
    checks = {k: found.get(k, 0) for tests in COUNTERS.values() for k in tests}
    del checks["service_calendar_summary_count"]
    checks |= {f"service_day_model_{k}": days[v] for k, v in MODEL.items()} | {f"display_name_{k}": shown[v] for k, v in NAMES.items()} | {"display_name_quality_coverage_gap_count": gaps}
    faults = {
        "line_labels": checks["stop_area_profiles_nonempty_line_labels"] == 0,
        "rail_line_labels": checks["rail_stop_area_profiles_count"] > 0 and checks["rail_stop_area_profiles_with_line_labels"] == 0,
        "routing_members": checks["canonical_stop_area_routing_members"] == 0,
        "display_names": any(shown[x] for x in NAME_FAULTS),
        "display_name_findings": gaps > 0 or checks["display_name_quality_destructive_action_count"] > 0,
        "service_days": not days["pass"],
    }
    warnings = {k: 1 for k, there in needed.items() if not there} | {k: 1 for k, wrong in faults.items() if wrong}
    out = [(kind, k, int(v)) for kind, values in (("flag", flags), ("check", checks), ("warning", warnings)) for k, v in values.items()]
    return spark.createDataFrame(out, "kind string, name string, value long")
