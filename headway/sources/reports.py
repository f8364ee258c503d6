"""Reports: metadata, summaries of numbers, JSON, Markdown and CSV."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import graph
from .gtfs import csv_field

# --- fixed values of the contract ---
POLICIES = {"time_model": "seconds_since_service_day_start", "stop_id_policy": "original_gtfs_stop_id", "area_id_policy": "parent_station_or_stop_id", "search_tokens_policy": "search_only_not_routing", "source_format": "GTFS", "feed_region": "unknown"}
COUNTS = {"stops": "stop_count", "stop_areas": "stop_area_count", "trips": "trip_count", "stop_times": "stop_time_count", "shapes": "shape_point_count", "calendar": "calendar_count", "calendar_dates": "calendar_dates_count", "routes": "route_count"}
# --- end of fixed values ---


def metadata(tables: dict[str, DataFrame], agency: DataFrame, feed_name: str | None = None, **more: str) -> DataFrame:
    """key and value of what a published feed says of itself: policies, row counts, timezones, name, and more of the caller's."""
    spark = agency.sparkSession
    fixed = POLICIES | {"feed_name": feed_name or "unknown"} | more
    out = spark.createDataFrame(list(fixed.items()), "key string, value string")
    for name, df in tables.items():
        out = out.union(df.agg(F.lit(COUNTS[name]).alias("key"), F.count("*").cast("string").alias("value")))
    zones = agency.select(c.filled(F.col("agency_timezone")).alias("z")).filter("z IS NOT NULL")
    return out.union(zones.agg(F.lit("feed_timezones"), F.array_join(F.array_sort(F.collect_set("z")), ",")))


#: Ranges that a search for a rank is cut into at each step, and the share of numbers below it in hundredths.
CUTS, P95 = 1024, 95


def nearest_rank(counts: DataFrame, least: int, most: int, rank: int) -> int:
    """The ``rank``-th smallest of whole numbers from ``least`` to ``most``, given as v and k, how often each occurs.

    Each step counts CUTS ranges and goes on in the one that has the rank, so that only
    their counts are ever in one place: three steps reach any number of 30 bits.
    """
    before = 0
    while least < most:
        width = -(-(most - least + 1) // CUTS)
        cut = F.expr(f"(v - {least}) div {width}").alias("cut")
        for r in counts.filter(F.col("v").between(least, most)).groupBy(cut).agg(F.sum("k").alias("k")).orderBy("cut").collect():
            if before + r["k"] >= rank:
                least = least + r["cut"] * width
                most = min(most, least + width - 1)
                break
            before += r["k"]
    return least


def latency_summary(rows: DataFrame, value: str, budget: int) -> DataFrame:
    """least, mean (whole), p95 (nearest rank), most and n of whole numbers, and whether all are within a budget; no row if there are none."""
    counts = graph.written(rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("k")))
    whole = counts.agg(F.min("v").alias("least"), F.max("v").alias("most"), F.sum("k").alias("n"), F.sum(F.col("v") * F.col("k")).alias("s"))
    found = whole.first()
    p95 = None if found["n"] is None else nearest_rank(counts, found["least"], found["most"], max(1, -(-found["n"] * P95 // 100)))
    kind = counts.schema["v"].dataType
    return whole.filter("n > 0").select("least", F.expr("s div n").alias("mean"), F.lit(p95).cast(kind).alias("p95"), "most", "n", (F.col("most") <= budget).alias("within"))


def changes(stored: DataFrame, fresh: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key and state (NEW, GONE, CHANGED, SAME) of a table that is to be written anew."""
    a, b = (df.select(key, F.struct(*columns).alias(tag)) for df, tag in ((stored, "_old"), (fresh, "_new")))
    rows = a.join(b, key, "full")
    state = F.when(F.col("_old").isNull(), "NEW").when(F.col("_new").isNull(), "GONE").when(F.col("_old").eqNullSafe(F.col("_new")), "SAME").otherwise("CHANGED")
    return rows.select(key, state.alias("state"))


def report_json(rows: dict[str, DataFrame]) -> str:
    """A contract report: one-row tables as objects, tables of name and rows or key and value as maps, others as lists of objects."""
    out = {}
    for name, df in rows.items():
        found = [r.asDict(recursive=True) for r in df.collect()]
        if set(df.columns) in ({"name", "rows"}, {"key", "value"}):
            out[name] = {r[df.columns[0]]: r[df.columns[1]] for r in found}
        else:
            out[name] = found[0] if len(found) == 1 else found
    return json.dumps(out, indent=1, sort_keys=True, default=str)


def markdown_table(df: DataFrame) -> str:
    """A small table as Markdown; bars are escaped, line ends are spaces."""
    text = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ").replace("\r", " ")
    lines = [df.columns, ["---"] * len(df.columns), *[[text(v) for v in row] for row in df.collect()]]
    return "".join(f"| {' | '.join(x)} |\n" for x in lines)


def csv_text(df: DataFrame) -> str:
    """A small table as CSV."""
    rows = df.select(F.concat_ws(",", *[csv_field(F.col(x)) for x in df.columns]).alias("line")).collect()
    return "".join(f"{x}\n" for x in (",".join(df.columns), *[r["line"] for r in rows]))
