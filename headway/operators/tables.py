"""Enrichment from catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c

def enrich_colours(routes: DataFrame, catalogue: DataFrame, agency: DataFrame) -> DataFrame:
    """Colours of a catalogue (line_label, route_color, route_text_color, operator) where a route has none; a line takes only its operator's colours.

    Labels are compared in capitals without spaces, operators in search form.  A line that
    the catalogue has several times for one operator takes its smallest colours.
    """
    line = lambda x: F.upper(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s", ""))
    colours = catalogue.select(line(F.col("line_label")).alias("_line"), c.normalised(F.col("operator")).alias("_operator"), F.struct(F.col("route_color").alias("a"), F.col("route_text_color").alias("b")).alias("_pair"))
    colours = colours.groupBy("_line", "_operator").agg(F.min("_pair").alias("_pair"))
    operators = agency.filter(c.filled(F.col("agency_id")).isNotNull()).select("agency_id", c.normalised(F.col("agency_name")).alias("_operator"))
    rows = routes.withColumn("_line", line(F.col("route_short_name"))).join(operators, "agency_id", "left").join(colours, ["_line", "_operator"], "left")
    missing = c.filled(F.col("route_color")).isNull() & F.col("_pair").isNotNull()
    text = F.col("route_text_color") if "route_text_color" in routes.columns else F.lit(None).cast("string")
    out = rows.withColumns({"route_color": F.when(missing, F.col("_pair.a")).otherwise(F.col("route_color")), "route_text_color": F.when(missing, F.col("_pair.b")).otherwise(text)})
    return out.select(*routes.columns, *[x for x in ("route_text_color",) if x not in routes.columns])
