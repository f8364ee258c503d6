"""Feed files: ZIP or folder of CSV members into typed tables, and back."""

from __future__ import annotations

import csv
import hashlib
import json
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import derive
from . import feedsource, zipsink
from .testfeed import WEEK, Feed

#: Columns by member: name, type, whether a blank aborts the read.
MEMBERS = {
    "stops": [("stop_id", "string", True), ("stop_code", "string", False), ("stop_name", "string", False), ("stop_lat", "double", False), ("stop_lon", "double", False), ("parent_station", "string", False), ("location_type", "int", False), ("platform_code", "string", False)],
    "routes": [("route_id", "string", True), ("agency_id", "string", False), ("route_short_name", "string", False), ("route_long_name", "string", False), ("route_type", "int", False), ("route_color", "string", False), ("route_text_color", "string", False)],
    "trips": [("trip_id", "string", True), ("route_id", "string", True), ("service_id", "string", True), ("trip_short_name", "string", False), ("trip_headsign", "string", False), ("direction_id", "string", False), ("block_id", "string", False), ("shape_id", "string", False)],
    "stop_times": [("trip_id", "string", True), ("arrival_time", "time", True), ("departure_time", "time", True), ("stop_id", "string", True), ("stop_sequence", "int", True), ("pickup_type", "int", False), ("drop_off_type", "int", False), ("shape_dist_traveled", "double", False)],
    "agency": [("agency_id", "string", False), ("agency_name", "string", True), ("agency_timezone", "string", False)],
    "calendar": [("service_id", "string", True), *[(d, "int", False) for d in WEEK], ("start_date", "string", False), ("end_date", "string", False)],
    "calendar_dates": [("service_id", "string", True), ("date", "string", True), ("exception_type", "int", False)],
    "transfers": [("from_stop_id", "string", True), ("to_stop_id", "string", True), *[(x, "string", False) for x in ("from_route_id", "to_route_id", "from_trip_id", "to_trip_id")], ("transfer_type", "int", False), ("min_transfer_time", "int", False), ("service_id", "string", False)],
    "shapes": [("shape_id", "string", True), ("shape_pt_sequence", "int", True), ("shape_pt_lat", "double", True), ("shape_pt_lon", "double", True), ("shape_dist_traveled", "double", False)],
    "feed_info": [("feed_id", "string", False), ("feed_publisher_name", "string", False), ("feed_version", "string", False)],
}
REQUIRED = ("stops", "routes", "trips", "stop_times")


def headers(path: str, member: str | None = None) -> list[str]:
    """The columns that a member's first line names."""
    found = feedsource.members(path)[member or feedsource.member_name(path)]
    return [h.strip() for h in next(csv.reader([feedsource.first_line(found)]), [])]


def fields(line: Column) -> Column:
    """Fields of a line: quotes switch quoting on and off wherever they stand, a doubled one inside is a quote; an open one ends with the line."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(',((?:[^",]|"[^"]*(?:"|$))*)'), F.lit(1))

    def bare(field: Column) -> Column:
        parts = F.split(field, '"')
        return F.array_join(F.transform(parts, lambda x, k: F.when((k % 2 == 0) & (k > 0) & (k < F.size(parts) - 1) & (x == ""), '"').otherwise(x)), "")

    return F.when(line.contains('"'), F.transform(raw, bare)).otherwise(F.split(line, ","))


def read_rows(spark: SparkSession, path: str, names: list[str], member: str | None = None) -> DataFrame:
    """A member's lines as text columns by header, ``_row`` in file order; only empty lines are no rows, and short ones lack their last fields.

    ``_real`` is true; what raises an error must ask it, as Spark may look at an expression before it has left out the header and empty lines.  Their fields are null.
    """
    lines = feedsource.feed_lines(spark, path, member or feedsource.member_name(path))
    lines = lines.withColumn("_real", (F.col("_row") > 0) & (F.col("value") != "")).filter("_real")
    split = lines.select("_row", "_real", F.when(F.col("_real"), fields(F.col("value"))).alias("_f"))
    return split.select("_row", "_real", *[F.get("_f", F.lit(names.index(n))).alias(n) for n in dict.fromkeys(names)])


def numbered(rows: DataFrame, name: str, start: int = 0) -> DataFrame:
    """``rows`` with their place in the file in ``name``: counts of the file's parts, which the driver sums, then places inside."""
    part, inner = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = F.row_number().over(Window.partitionBy("_part").orderBy("_row"))
    rows = rows.withColumn("_part", part.cast("int")).withColumn("_in", inner)
    counts = sorted((r["_part"], r["n"]) for r in rows.groupBy("_part").agg(F.count("*").alias("n")).collect())
    before, total = [], start
    for p, n in counts:
        before.append((p, total))
        total += n
    shift = F.broadcast(rows.sparkSession.createDataFrame(before or [(0, start)], "_part int, _before long"))
    return rows.withColumn(name, ranked).join(shift, "_part").withColumn(name, (F.col(name) - 1 + F.col("_before")).cast("long")).drop("_part", "_in", "_before")


#: Members whose rows are numbered in file order, and from what.
NUMBERED = {"transfers": ("transfer_id", 1), "agency": ("ordinal", 0)}


def read_member(spark: SparkSession, path: str, name: str, names: list[str] | None = None) -> DataFrame:
    """A member's typed table: columns by header, blanks null, a blank required value or a bad number raises; transfers and agencies carry their place in the file."""
    names = headers(path, name) if names is None else names
    raw = read_rows(spark, path, names, name)
    out = []
    if name in NUMBERED:
        raw = numbered(raw, *NUMBERED[name])
        out.append(F.col(NUMBERED[name][0]))
    for column, kind, required in MEMBERS[name]:
        value = F.nullif(F.col(column), F.lit("")) if column in names else F.lit(None).cast("string")
        if required:
            value = F.coalesce(value, F.when(F.col("_real"), F.raise_error(F.lit(f"{name}: blank {column}")).cast("string")))
        if kind == "time":
            out.append(c.seconds(value).alias(column.replace("_time", "_seconds")))
        else:
            out.append((value if kind == "string" else F.trim(value)).cast(kind).alias(column))
    return raw.select(*out)


def unknown_stops(stop_times: DataFrame, stops: DataFrame, samples: int = 5) -> DataFrame:
    """One row: how many stop times name stops that aren't there, and the first few such stops."""
    lost = stop_times.join(stops.select("stop_id"), "stop_id", "left_anti").groupBy("stop_id").agg(F.count("*").alias("n"))
    few = lost.orderBy("stop_id").limit(samples).agg(F.array_sort(F.collect_list("stop_id")).alias("samples"))
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unknown")).crossJoin(F.broadcast(few))


def read_feed(spark: SparkSession, path: str) -> Feed:
    """A feed from a ZIP or a folder of members; the driver reads its directory and the members' first lines."""
    members = feedsource.members(path)
    for name in REQUIRED:
        if name not in members:
            raise FileNotFoundError(f"{path}: no {name}.txt")
    tables = {name: read_member(spark, path, name) if name in members else _empty(spark, name) for name in MEMBERS}
    return Feed(spark, **tables)


def _empty(spark: SparkSession, name: str) -> DataFrame:
    place = f"{NUMBERED[name][0]} long, " if name in NUMBERED else ""
    kinds = place + ", ".join(f"{n.replace('_time', '_seconds') if k == 'time' else n} {'int' if k == 'time' else k}" for n, k, _ in MEMBERS[name])
    return spark.createDataFrame([], kinds)


def feed_identity(feed_info: DataFrame) -> str | None:
    """feed_id of the first row, else its publisher."""
    row = feed_info.select(c.first_filled(F.col("feed_id"), F.col("feed_publisher_name")).alias("x")).first()
    return row and row["x"]


def require_unique(df: DataFrame, key: list[str]) -> None:
    if not df.groupBy(*key).count().filter("count > 1").isEmpty():
        raise ValueError(f"repeated keys in {key}")


def key_counts(feed: Feed, keys: dict[str, list[str]]) -> DataFrame:
    out = None
    for name, key in keys.items():
        rows = getattr(feed, name).agg(F.lit(name).alias("name"), F.count("*").alias("n"), (F.count("*") - F.count_distinct(*key)).alias("repeated"))
        out = rows if out is None else out.union(rows)
    return out


def corridor(feed: Feed, areas: list[str]) -> dict[str, DataFrame]:
    """The part of a feed that trips through some areas need, searchable, with counts made anew.

    The trips' stops, their parents, and all members of the areas these are in.
    """
    members = derive.stop_area_members(feed.stops)
    seeds = feed.stop_times.join(members.filter(F.col("area_id").isin(areas)), "stop_id", "left_semi").select("trip_id").distinct()
    calls, trips = feed.stop_times.join(seeds, "trip_id", "left_semi"), feed.trips.join(seeds, "trip_id", "left_semi")
    called = calls.select("stop_id").distinct()
    parents = feed.stops.join(called, "stop_id", "left_semi").select(c.filled(F.col("parent_station")).alias("stop_id")).filter("stop_id IS NOT NULL")
    first = called.union(parents).distinct()
    in_areas = members.join(first, "stop_id", "left_semi").select("area_id").distinct()
    picked = first.union(members.join(in_areas, "area_id", "left_semi").select("stop_id")).distinct()
    stops = feed.stops.join(picked, "stop_id", "left_semi")
    services = trips.select("service_id").distinct()
    calendar, dates = (df.join(services, "service_id", "left_semi") for df in (feed.calendar, feed.calendar_dates))
    tokens = derive.search_tokens(stops)
    return {
        "stops": stops, "stop_area_members": derive.stop_area_members(stops), "stop_areas": derive.stop_areas(stops), "trips": trips, "routes": feed.routes.join(trips, "route_id", "left_semi"), "stop_times": calls,
        "calendar": calendar, "calendar_dates": dates, "service_calendar_summary": derive.calendar_summary(calendar, dates, trips), "stop_search_tokens": tokens,
    }


def package_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: whether a package has trips and calls, and counters of what contradicts itself or points nowhere."""
    t = tables
    areas = t["stop_areas"].select("area_id", "stop_count").join(t["stop_area_members"].groupBy("area_id").agg(F.count("*").alias("n")), "area_id", "full")
    services = t["service_calendar_summary"].select("service_id", "trip_count").join(t["trips"].groupBy("service_id").agg(F.count("*").alias("n")), "service_id", "full")
    wrong = lambda a: F.count_if(~F.coalesce(F.col(a), F.lit(0)).eqNullSafe(F.coalesce("n", F.lit(0))))
    lost = lambda df, other, key, name: df.join(other.select(key), key, "left_anti").agg(F.count("*").alias(name))
    rows = [
        t["trips"].agg((F.count("*") > 0).alias("has_trips")), t["stop_times"].agg((F.count("*") > 1).alias("has_calls")), areas.agg(wrong("stop_count").alias("wrong_area_counts")), services.agg(wrong("trip_count").alias("wrong_trip_counts")),
        lost(t["stop_search_tokens"], t["stop_areas"], "area_id", "dangling_token_areas"), lost(t["stop_search_tokens"].filter("stop_id IS NOT NULL"), t["stops"], "stop_id", "dangling_token_stops"), lost(t["stop_times"], t["stops"], "stop_id", "dangling_calls"),
        t["stop_area_members"].agg(F.count("*").alias("members")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.crossJoin(F.broadcast(r))
    return out


def content_identity(tables: dict[str, DataFrame]) -> DataFrame:
    """name, rows and content (a sum of row hashes over all columns) of each table."""
    out = None
    for name, df in sorted(tables.items()):
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("content"))
        out = row if out is None else out.union(row)
    return out


MANIFEST = "manifest.json"


def publish(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write tables as Parquet into ``folder`` and then its manifest, which publishes them at once; returns row counts.

    Each attempt writes under a name of its own, so what a lost one left is never read;
    the manifest is one small file, which any store replaces whole.  A folder that has
    one is an error.  The manifest's identity hashes every table's schema and content.
    """
    system, place = feedsource.opened(folder)
    if system.get_file_info(f"{place}/{MANIFEST}").type != fs.FileType.NotFound:
        raise FileExistsError(folder)
    data = f"data-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{data}/{name}")
    written = {name: df.sparkSession.read.parquet(f"{folder}/{data}/{name}") for name, df in tables.items()}
    rows = content_identity(written).collect() if written else []
    counts = {r["name"]: r["rows"] for r in rows}
    told = {r["name"]: [written[r["name"]].schema.simpleString(), r["rows"], r["content"]] for r in rows}
    system.create_dir(place, recursive=True)
    with system.open_output_stream(f"{place}/{MANIFEST}") as f:
        f.write(json.dumps({"data": data, "rows": counts, "identity": hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()}, indent=1, sort_keys=True).encode())
    return {name: counts.get(name, 0) for name in tables}


def manifest(folder: str) -> dict:
    """What ``publish`` wrote last; a folder without it isn't published."""
    system, place = feedsource.opened(folder)
    with system.open_input_file(f"{place}/{MANIFEST}") as f:
        return json.loads(f.read())


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a published folder."""
    told = manifest(folder)
    return {name: spark.read.parquet(f"{folder}/{told['data']}/{name}") for name in told["rows"]}


def csv_field(value: Column) -> Column:
    """A CSV field, quoted where it holds a comma, a quote or a line's end."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def member_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws(",", *[csv_field(F.col(x)) for x in df.columns]).alias("value"))


def write_zip(tables: dict[str, DataFrame], path: str) -> None:
    """A ZIP of CSV members, deflated by executors and put one behind the other by one task, in order of partitions."""
    zipsink.write(path, {f"{name}.txt": (",".join(df.columns) + "\n", member_lines(df)) for name, df in tables.items()})


def write_member(df: DataFrame, path: str) -> None:
    """One CSV file, as ``write_zip`` writes its members."""
    zipsink.write_plain(path, ",".join(df.columns) + "\n", member_lines(df))
