"""The gate's flags, counters and warnings on tables that are there, empty, lacking columns or absent."""

from pyspark.sql import functions as F

from headway.operators import appready


def gate(spark, tables, gaps=0, sound=True, faults=0):
    written, found = appready.measured(tables)
    assert {k: df.count() for k, df in written.items()} == {k: df.count() for k, df in tables.items()}
    model = spark.range(1).select(*[F.lit(3).alias(x) for x in appready.MODEL.values()], F.lit(sound).alias("pass"))
    shown = spark.range(1).select(*[F.lit(faults).alias(x) for x in {*appready.NAMES.values(), *appready.NAME_FAULTS}])
    out = {}
    for r in appready.gate(spark, list(tables), found, model, shown, gaps).collect():
        out.setdefault(r.kind, {})[r.name] = r.value
    return out


def full(spark):
    one = spark.range(2)
    tables = {x: one for x in [*appready.CORE, *appready.FILLED, *appready.PRESENT]}
    tables["routes"] = spark.createDataFrame([("r", " "), ("s", None), ("t", "AABBCC")], "route_id string, route_color string")
    tables["stop_area_profiles"] = spark.createDataFrame([(1, "S1"), (0, None)], "has_rail_service int, line_labels string")
    tables["canonical_stop_area_members"] = spark.createDataFrame([(1, "PRIMARY_RAIL", 1), (0, "BUS_FEEDER", 0)], "is_primary_for_routing int, member_role string, is_visible_suggestion int")
    tables["display_name_quality_findings"] = spark.createDataFrame([("UPPERCASE_PREFIX", "PRESERVE")], "finding_type string, action string")
    return tables


def test_ready(spark):
    got = gate(spark, full(spark))
    assert "warning" not in got and len(got["flag"]) == 17 and len(got["check"]) == 52
    # stops have no platform_code here, which counts nothing and warns of nothing
    assert [k for k, v in got["flag"].items() if not v] == ["platform_codes"]
    want = {"routes_with_color_count": 1, "stop_area_profiles_count": 2, "rail_stop_area_profiles_with_line_labels": 1, "canonical_stop_area_bus_feeder_members": 1, "stop_search_tokens_count": 2, "service_day_model_service_count": 3, "display_name_quality_prefix_count": 1}
    assert {k: got["check"][k] for k in want} == want


def test_warnings(spark):
    tables = full(spark)
    del tables["stop_area_aliases"], tables["stop_footpaths"], tables["trips"]
    tables["stop_area_profiles"] = spark.createDataFrame([(1, " ")], "has_rail_service int, line_labels string")
    tables["canonical_stop_area_members"] = tables["canonical_stop_area_members"].limit(0)
    tables["display_name_quality_findings"] = spark.createDataFrame([("UPPERCASE_PREFIX", "RENAME")], "finding_type string, action string")
    got = gate(spark, tables, gaps=2, sound=False, faults=1)
    assert set(got["warning"]) == {"core_tables", "stop_area_aliases", "stop_footpaths", "canonical_stop_area_members", "line_labels", "rail_line_labels", "routing_members", "display_names", "display_name_findings", "service_days"}
    assert got["check"]["stop_area_aliases_count"] == 0 and got["check"]["display_name_quality_coverage_gap_count"] == 2
